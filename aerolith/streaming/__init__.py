"""Structured Streaming jobs: Bronze ingest (file sink) and the hot path."""
