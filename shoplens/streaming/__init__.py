"""Structured Streaming ingest and aggregations (STR1-STR5)."""
