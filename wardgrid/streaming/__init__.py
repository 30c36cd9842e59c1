"""Incremental ingest of large event tables."""
