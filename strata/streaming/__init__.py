"""Incremental Bronze ingestion with Structured Streaming."""
