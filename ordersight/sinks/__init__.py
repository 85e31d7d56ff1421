"""Sinks: parquet and CSV writers."""
