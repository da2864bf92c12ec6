"""Structured Streaming forms of monitoring and ingest."""
