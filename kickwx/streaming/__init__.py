"""Incremental ingest with Structured Streaming (file source, exactly-once file sink)."""
