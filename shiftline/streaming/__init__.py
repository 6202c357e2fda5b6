"""Incremental (Structured Streaming) form of the validated ingest."""
