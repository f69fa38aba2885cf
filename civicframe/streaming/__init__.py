"""Incremental ingest and event-time aggregates by Structured Streaming."""
