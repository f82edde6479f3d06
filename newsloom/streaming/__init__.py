"""Incremental ingest of a landing folder with Structured Streaming."""
