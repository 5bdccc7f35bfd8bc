"""Batch telemetry analytics for BI content, built from Spark DataFrame operators."""
