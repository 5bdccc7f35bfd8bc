"""Incremental loading of landed files with Structured Streaming."""
