"""Structured Streaming jobs: incremental ingest and continuous upsert."""
