"""Readers: parquet, JSON, message logs, synthetic streams."""
