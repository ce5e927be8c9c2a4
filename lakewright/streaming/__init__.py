"""Streaming ingest, cleaning, deduplication and windowed features."""
