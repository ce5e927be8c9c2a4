"""Registered queries over the driver's tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from lakewright.catalog.base import ENTRIES, Entry

# importing a module registers its queries
from lakewright.catalog import (  # noqa: F401  isort: skip
    aggregates,
    filters,
    functions,
    history,
    joins,
    models,
    projections,
    quality,
    sinks,
    sources,
    streams,
    windows,
)

__all__ = ["ENTRIES", "Entry"]
