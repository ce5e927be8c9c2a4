"""Sorts and top-k reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_rows(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """First ``n`` rows of a total order: each task keeps ``n``, one merges them."""
    return df.orderBy(*order).limit(n)


def top_by_score(df: DataFrame, score: str, tie_breakers: Sequence[str], k: int) -> DataFrame:
    """``k`` best rows; a NULL score sorts first, as the reference database does."""
    return df.orderBy(F.col(score).desc_nulls_first(), *[F.col(c).asc() for c in tie_breakers]).limit(k)


def sorted_output(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*order)
