"""Row predicates built from column lists, and routing of rejected rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

REJECT_REASON = "_reject_reason"


def equals_all(values: Mapping[str, object]) -> Column:
    """Every column equals its value."""
    return reduce(lambda a, b: a & b, [F.col(name) == value for name, value in values.items()])


def not_flagged(flag: str) -> Column:
    """The flag is false or NULL."""
    return ~F.coalesce(F.col(flag), F.lit(False))


def has_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key columns are all present."""
    return df.na.drop(subset=list(keys))


def outside(column: str, low: object, high: object) -> Column:
    return ~F.col(column).between(low, high)


def no_empty_strings(df: DataFrame) -> Column:
    """Every string column is filled; TRUE for a frame without string columns."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() & (F.col(c) != "") for c in texts], F.lit(True))


def positive(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) > 0)


def tag_rejects(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add the name of the first rule a row breaks, NULL if it breaks none.

    A rule is the condition a good row meets; an unknown condition counts as broken.
    """
    reason = None
    for name, rule in rules.items():
        broken = ~F.coalesce(rule, F.lit(False))
        reason = F.when(broken, F.lit(name)) if reason is None else reason.when(broken, F.lit(name))
    return df.withColumn(REJECT_REASON, F.lit(None).cast("string") if reason is None else reason)


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reason)."""
    tagged = tag_rejects(df, rules)
    return (
        tagged.filter(F.col(REJECT_REASON).isNull()).drop(REJECT_REASON),
        tagged.filter(F.col(REJECT_REASON).isNotNull()),
    )
