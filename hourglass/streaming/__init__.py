"""Structured Streaming jobs: ingest and speed layer."""
