"""Joins: enrichment, point in time, change detection, anti joins, date flags and keyed updates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.operators.asof import chunked_join, sweep_join
from lakewright.operators.skew import planned_bytes, BROADCAST_LIMIT_BYTES, salted_join, small
from lakewright.session import stored


def all_equal(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}") == F.col(f"{right}.{k}") for k in keys])


def all_same(left: str, right: str, keys: Sequence[str]) -> Column:
    """As ``all_equal``, with NULL a key like others."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def any_differs(left: str, right: str, columns: Sequence[str]) -> Column:
    """Some column differs, where NULL and a value differ and two NULLs do not."""
    return reduce(
        lambda a, b: a | b,
        [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns],
    )


def enrich(fact: DataFrame, dim: DataFrame, on: Mapping[str, str], take: Mapping[str, str]) -> DataFrame:
    """Left join that adds dimension columns to every fact row.

    ``on`` maps fact columns to dimension columns, ``take`` dimension columns to
    their new names. The dimension is broadcast while it is small.
    """
    f, d = fact.alias("f"), small(dim.select(*{*on.values(), *take})).alias("d")
    cond = reduce(lambda a, b: a & b, [F.col(f"f.{a}") == F.col(f"d.{b}") for a, b in on.items()])
    return f.join(d, cond, "left").select("f.*", *[F.col(f"d.{old}").alias(new) for old, new in take.items()])


def _valid_at(at: str, start: str, end: str, current: str, end_inclusive: bool, l: str, r: str) -> Column:
    when = F.col(f"{l}.{at}")
    until = F.col(f"{r}.{end}")
    before_end = when <= until if end_inclusive else when < until
    return (when >= F.col(f"{r}.{start}")) & (F.col(f"{r}.{current}") | before_end)


def _listed_join(
    fact: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, take: Mapping[str, str], start: str, end: str, current: str, end_inclusive: bool
) -> DataFrame:
    """Left join of facts to the list of their key's versions in their year, with a row for each version that is valid.

    No version starts after ``final``, so what is valid later is listed there, and the
    facts need not be read for the last of their dates.
    """
    final = F.lit(versions.agg(F.max(F.year(start)).alias("y")).scalar()).cast("int")
    first, last = F.year(start), F.when(F.col(current), final).otherwise(F.least(F.year(end), final))
    version = F.struct(*dict.fromkeys([start, end, current, *take]))
    listed = (
        versions.select(*keys, version.alias("_version"), F.explode(F.when(first <= last, F.sequence(first, last))).alias("_year"))
        .groupBy(*keys, "_year")
        .agg(F.collect_list("_version").alias("_versions"))
    )
    dated = fact.withColumn("_year", F.least(F.year(at), final))
    when = F.col(f"l.{at}")

    def valid(v: Column) -> Column:
        return (when >= v[start]) & (v[current] | (when <= v[end] if end_inclusive else when < v[end]))

    joined = dated.alias("l").join(listed.alias("r"), all_equal("l", "r", [*keys, "_year"]), "left")
    found = joined.select(*[F.col(f"l.{c}") for c in fact.columns], F.explode_outer(F.filter("r._versions", valid)).alias("_found"))
    return found.select(*fact.columns, *[F.col("_found")[old].alias(new) for old, new in take.items()])


def pit_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    at: str,
    take: Mapping[str, str],
    start: str = "effective_date",
    end: str = "end_date",
    current: str = "is_current",
    end_inclusive: bool = True,
    method: str = "auto",
) -> DataFrame:
    """Left join of each fact to the dimension version valid on its date.

    The keys are an equality, the validity interval a residual condition.
    ``method`` chooses the physical form; all give the same rows:

    - ``plain``: an ordinary join, which Spark broadcasts while the versions' size,
      measured at run time, is under its own threshold;
    - ``broadcast``: the same with a hint, if the planned size is under the limit;
    - ``salted``: shuffled on the keys, with the facts of crowded keys spread;
    - ``monthly``: versions are listed per year they cover and joined on key and
      year, so a key with very many versions compares only those of a year. The
      versions are stored, the facts are read once and moved once;
    - ``sweep``: facts and version starts in one order, with work for their sum
      (see ``asof.sweep_join``, which wants versions that do not overlap);
    - ``chunked``: a key's versions in about as many lists as each list is long, so a
      fact compares twice the root of their number (see ``asof.chunked_join``; no
      overlaps either). The facts are moved once and nothing is counted first;
    - ``auto``: plain while the versions are planned to be small, otherwise chunked.
    """
    columns = [*keys, start, end, current, *take]
    versions = dim.select(*dict.fromkeys(columns))
    out = [F.col(f"r.{old}").alias(new) for old, new in take.items()]

    def valid(l: str, r: str) -> Column:
        return _valid_at(at, start, end, current, end_inclusive, l, r)

    if method == "auto":
        method = "plain" if planned_bytes(versions) <= BROADCAST_LIMIT_BYTES else "chunked"
    if method == "chunked":
        return chunked_join(fact, versions, keys, at, take, start, end, current, end_inclusive)
    if method == "sweep":
        return sweep_join(fact, versions, keys, at, take, start, end, current, end_inclusive)
    if method in ("plain", "broadcast"):
        side = small(versions) if method == "broadcast" else versions
        joined = fact.alias("l").join(side.alias("r"), all_equal("l", "r", keys) & valid("l", "r"), "left")
    elif method == "salted":
        joined = salted_join(fact, versions, keys, "left", valid)
    elif method == "monthly":
        return _listed_join(fact, stored(versions, "versions"), keys, at, take, start, end, current, end_inclusive)
    else:
        raise ValueError(f"unknown method '{method}'")
    return joined.select(*[F.col(f"l.{c}") for c in fact.columns], *out)


def match_counts(joined: DataFrame, column: str) -> DataFrame:
    """How many rows found a partner and how many did not, in one pass."""
    return joined.agg(
        F.count_if(F.col(column).isNotNull()).alias("matched"),
        F.count_if(F.col(column).isNull()).alias("unmatched"),
    )


def changed_rows(incoming: DataFrame, current: DataFrame, keys: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Incoming rows whose tracked columns differ from the current row of their key."""
    return (
        incoming.alias("n")
        .join(current.select(*keys, *tracked).alias("o"), all_equal("n", "o", keys) & any_differs("n", "o", tracked))
        .select("n.*")
    )


def absent_rows(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key the existing frame lacks."""
    return incoming.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct child values the parent lacks."""
    values = child.select(F.col(column)).filter(F.col(column).isNotNull()).distinct()
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    return values.join(known, column, "left_anti")


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """The child rows whose value the parent lacks; NULL is no orphan.

    The values that are missing are found on distinct keys. Their list, not the parent, is
    then joined with the child rows, so a sound child table moves no row.
    """
    missing = orphans(child, column, parent, parent_column).withColumnRenamed(column, "_missing")
    return child.join(missing, F.col(column) == F.col("_missing"), "left_semi")


def flag_dates(
    df: DataFrame,
    at: str,
    calendar: DataFrame,
    day: str,
    flag: str,
    yes: object = True,
    no: object = False,
    shift_days: int = 0,
) -> DataFrame:
    """Label rows whose date, moved back by ``shift_days``, is in a calendar table.

    The calendar has a handful of days per year, so its size follows the time
    span and not the data.
    """
    days = small(calendar.select(F.date_add(F.col(day), shift_days).alias("_day")).distinct())
    return (
        df.withColumn("_at", F.to_date(at))
        .join(days, F.col("_at") == F.col("_day"), "left")
        .withColumn(flag, F.when(F.col("_day").isNull(), F.lit(no)).otherwise(F.lit(yes)))
        .drop("_at", "_day")
    )


def update_matched(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    when: Column,
    values: Mapping[str, Column],
) -> DataFrame:
    """Target rows with ``values`` set where the key is matched and ``when`` holds.

    Columns of the target are written ``t.x`` and of the incoming frame ``s.x``.
    ``incoming`` has one row per key.
    """
    marked = incoming.withColumn("_hit", F.lit(True))
    joined = target.alias("t").join(marked.alias("s"), all_equal("t", "s", keys), "left")
    hit = F.coalesce(F.col("s._hit") & when, F.lit(False))
    return joined.select(
        *[
            (F.when(hit, values[c]).otherwise(F.col(f"t.{c}")) if c in values else F.col(f"t.{c}")).alias(c)
            for c in target.columns
        ]
    )
