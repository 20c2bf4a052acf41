"""Streaming ingest of request logs and keyed tables."""
