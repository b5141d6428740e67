"""Structured Streaming ingest: JSON messages -> typed rows -> quarantine split -> idempotent merge."""
