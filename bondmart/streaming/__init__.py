"""Structured Streaming entry points (incremental nightly run)."""
