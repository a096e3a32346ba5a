"""Structured Streaming ingest of trip rows."""
