"""Names and text columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Pattern a listed price must match.
PRICE_PATTERN = r"^\$[0-9][0-9\.]+$"


def clean_name(name: str) -> str:
    """Column name reduced to letters, digits and single inner underscores."""
    return re.sub(r"_+", "_", re.sub(r"[^A-Za-z0-9_]", "_", name)).strip("_")


def trimmed(columns: Sequence[str]) -> dict[str, Column]:
    return {name: F.trim(F.col(name)) for name in columns}


def matches(text: Column, pattern: str) -> Column:
    return text.rlike(pattern)


def decoded(value: Column) -> Column:
    """Message bytes as text."""
    return value.cast("string")


def parsed(value: Column, schema: StructType) -> Column:
    """JSON text as a struct; a malformed document or field gives NULLs."""
    return F.from_json(value, schema)
