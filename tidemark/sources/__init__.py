"""Readers of landed JSON, configuration, stored tables and CSV history."""
