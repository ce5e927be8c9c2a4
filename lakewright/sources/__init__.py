"""Readers: delimited files, tables, message streams, seeds and relational tables."""
