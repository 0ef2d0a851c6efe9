"""Incremental ingest with Structured Streaming (and its batch twin)."""
