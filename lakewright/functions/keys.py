"""Hashed surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARKER = "_null_"
LONG_TEXT = 64


def compact(text: Column) -> Column:
    """Text to group by: itself up to 64 characters, beyond that ``#`` and its SHA-256.

    Equal texts stay equal and unequal ones unequal, but a long text does not
    travel through the shuffle.
    """
    return F.when(F.length(text) > LONG_TEXT, F.concat(F.lit("#"), F.sha2(text, 256))).otherwise(text)


def hash_key(columns: Sequence[Column | str], algorithm: str = "sha256", sep: str = "|", plain: bool = False) -> Column:
    """Hash of the columns' text joined by ``sep``.

    A NULL part becomes a marker, so (NULL, 'a') and ('a', NULL) differ. Within a part
    a backslash, the separator and a text equal to the marker are escaped, so different
    parts never give one key. ``plain`` leaves them as they are, for keys that must equal
    those of a system that joins without escaping.
    """

    def part(column: Column) -> Column:
        text = column.cast("string")
        if not plain:
            text = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(sep), F.lit("\\" + sep))
            text = F.when(text == NULL_MARKER, F.lit("\\" + NULL_MARKER)).otherwise(text)
        return F.coalesce(text, F.lit(NULL_MARKER))

    parts = [part(F.col(c) if isinstance(c, str) else c) for c in columns]
    joined = F.concat_ws(sep, *parts)
    if algorithm == "sha256":
        return F.sha2(joined, 256)
    if algorithm == "md5":
        return F.md5(joined)
    raise ValueError(f"unknown algorithm '{algorithm}'")
