"""Column selection, renaming and derived audit columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.functions.dates import moment, month_part, year_part
from lakewright.functions.text import clean_name


class ContractError(ValueError):
    """A frame does not offer the columns its contract names."""


def drop_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop the listed columns that exist."""
    return df.drop(*[name for name in columns if name in df.columns])


def sanitize_names(df: DataFrame) -> DataFrame:
    """Clean every column name; two names that clean to the same one are an error."""
    names = [clean_name(name) for name in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ContractError(f"names collide after cleaning: {clashes}")
    return df.toDF(*names)


def rename_contract(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select and rename in the mapping's order; missing columns are an error."""
    missing = [name for name in mapping if name not in df.columns]
    if missing:
        raise ContractError(f"missing columns {missing}; available {df.columns}")
    return df.select([F.col(f"`{old}`").alias(new) for old, new in mapping.items()])


def add_load_audit(df: DataFrame, source: str | Column, loaded_at: datetime | Column | None = None) -> DataFrame:
    """Load time in whole seconds and the source file."""
    if loaded_at is None:
        at = F.current_timestamp()
    else:
        at = loaded_at if isinstance(loaded_at, Column) else moment(loaded_at)
    return df.withColumns(
        {
            "_ingested_at": F.date_trunc("second", at),
            "_source_file": F.lit(source) if isinstance(source, str) else source,
        }
    )


def add_period_columns(df: DataFrame, at: str, prefix: str) -> DataFrame:
    """``<prefix>_year`` and ``<prefix>_month`` text columns to partition by."""
    return df.withColumns(
        {f"{prefix}_year": year_part(F.col(at)), f"{prefix}_month": month_part(F.col(at))}
    )


def flatten_struct(df: DataFrame, struct: str, keep: Mapping[str, str] | None = None) -> DataFrame:
    """The struct's fields as columns plus the kept columns under new names."""
    return df.select(f"{struct}.*", *[F.col(old).alias(new) for old, new in (keep or {}).items()])


def sample_of(df: DataFrame, wanted: Sequence[str], n: int) -> DataFrame:
    """``n`` rows, in order, of those wanted columns that exist."""
    present = [name for name in wanted if name in df.columns]
    return df.select(*present).orderBy(*present).limit(n)
