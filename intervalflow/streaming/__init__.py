"""Incremental loads: high-water state, resume windows, Structured Streaming ingestion,
backfills and late data."""
