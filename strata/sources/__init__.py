"""Scans, sinks, catalog tables, ingestion and the test-table adapter."""
