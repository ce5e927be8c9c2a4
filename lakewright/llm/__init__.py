"""Operators of a training-data pipeline: scoring, deduplication, decontamination, tokenizing, sharding and filters."""
