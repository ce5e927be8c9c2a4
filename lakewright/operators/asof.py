"""Point-in-time joins beyond broadcasts: a sweep over facts and version starts, or lists of versions that follow each other."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewright.session import stored

GRAINS = ("year", "month", "day", "hour")


def _cell(at: Column, grain: str) -> Column:
    return F.date_trunc(grain, at.cast("timestamp"))


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def fact_cells(
    fact: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, start: str, grain: str, share: float, total: int
) -> DataFrame:
    """(keys, _cell, _carried, _salts): every cell of a key that holds facts, with the version that starts last before it.

    Facts are counted and version starts cut to the last of a cell before the shuffle, so
    a key has one row per cell however many facts and versions it has. Cells with more
    than ``share`` of all ``total`` facts, of which there are at most ``1 / share``, get several salts.
    """
    payload = F.struct(*[F.col(c) for c in versions.columns])
    opened = versions.groupBy(*keys, _cell(F.col(start), grain).alias("_cell")).agg(F.max_by(payload, F.col(start)).alias("_last"))
    counted = fact.groupBy(*keys, _cell(F.col(at), grain).alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    cells = (
        counted.withColumn("_last", F.lit(None).cast(opened.schema["_last"].dataType))
        .unionByName(opened.withColumn("_n", F.lit(0).cast("long")))
        .groupBy(*keys, "_cell")
        .agg(F.sum("_n").alias("_n"), F.first("_last", ignorenulls=True).alias("_last"))
    )
    earlier = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = cells.withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier)).filter("_n > 0")
    salts = F.greatest(F.lit(1), F.ceil(F.col("_n") / (total * F.lit(share)))).cast("int")
    return carried.select(*keys, "_cell", "_carried", salts.alias("_salts"))


def busy_keys(fact: DataFrame, versions: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """The keys with more than ``share`` of all facts and versions; there are at most ``1 / share``."""
    counted = fact.select(*keys).unionByName(versions.select(*keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = fact.count() + versions.count()
    return counted.filter(F.col("_n") > total * F.lit(share)).select(*keys, F.lit(True).alias("_busy"))


def swept_rows(fact: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, start: str, grain: str, share: float) -> DataFrame:
    """Facts, version starts and carried versions, dealt into groups (keys, _cell, _salt) of bounded size.

    A key that is not busy is one group and moves once, without being cut into cells.
    Salts come from the hash of the whole fact, so a task that runs again deals its rows
    as before; facts that are equal in every column share one. ``_fact`` and ``_version``
    hold all columns but the keys.
    """
    on = [*keys, "_cell"]
    # at most 1 / share rows, whatever the tables hold
    busy = F.broadcast(busy_keys(fact, versions, keys, share))
    cells = fact_cells(fact.join(busy, [*keys], "left_semi"), versions.join(busy, [*keys], "left_semi"), keys, at, start, grain, share, fact.count())
    crowded = F.broadcast(cells.filter("_salts > 1").select(*on, "_salts"))
    each_salt = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)).alias("_salt")

    def packed(df: DataFrame, time: str, name: str) -> DataFrame:
        rows = df.select(*keys, F.col(time).cast("timestamp").alias("_at"), F.struct(*[F.col(c) for c in df.columns if c not in keys]).alias(name))
        cell = F.when(F.col("_busy"), _cell(F.col("_at"), grain)).alias("_cell")
        return rows.join(busy, [*keys], "left").select(*keys, cell, "_at", name).join(crowded, on, "left")

    facts = packed(fact, at, "_fact")
    facts = facts.withColumn("_salt", F.when(F.col("_salts") > 1, F.pmod(F.xxhash64(*keys, "_fact"), F.col("_salts"))).otherwise(0).cast("int"))
    starts = packed(versions, start, "_version").select(*on, "_at", "_version", each_salt)
    carried = F.struct(*[F.col("_carried")[c].alias(c) for c in versions.columns if c not in keys])
    edges = cells.filter("_carried IS NOT NULL").select(*on, F.lit(None).cast("timestamp").alias("_at"), carried.alias("_version"), each_salt)
    no_fact = F.lit(None).cast(facts.schema["_fact"].dataType)
    no_version = F.lit(None).cast(starts.schema["_version"].dataType)
    return (
        facts.select(*on, "_salt", "_at", F.lit(1).alias("_kind"), "_fact", no_version.alias("_version"))
        .unionByName(starts.withColumns({"_kind": F.lit(0), "_fact": no_fact}))
        .unionByName(edges.withColumns({"_kind": F.lit(0), "_fact": no_fact}))
    )


def sweep_join(
    fact: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    take: Mapping[str, str],
    start: str = "effective_date",
    end: str = "end_date",
    current: str = "is_current",
    end_inclusive: bool = True,
    grain: str = "month",
    share: float = 0.001,
) -> DataFrame:
    """Left join of each fact to the version valid on its date, with work for facts plus versions.

    The time of a key with more than ``share`` of all rows is cut into cells of a ``grain``.
    Each cell starts from the version that is open at its edge, so the cells of one key are
    swept apart, and a cell with more than ``share`` of all facts is dealt into several
    groups; any other key is a group of its own. In a group the version that
    started last is carried forward to the facts that follow, and counts if it has not
    ended by then. Versions of a key may not overlap, as in any history of this library;
    of versions with one start, one is taken. Facts with a null key or date find nothing
    and are not shuffled. Facts and versions are read several times, so both are stored
    first.
    """
    if grain not in GRAINS:
        raise ValueError(f"unknown grain '{grain}'")
    nothing, fact = _any_null([*keys, at]), stored(fact, "sweep-facts")
    dated, undated = fact.filter(~nothing), fact.filter(nothing)
    known = stored(versions.select(*dict.fromkeys([*keys, start, end, current, *take])).filter(~_any_null([*keys, start])), "sweep-versions")
    rows = swept_rows(dated, known, keys, at, start, grain, share)
    # carried versions have no time and come first; a start comes before the facts of its moment
    order = Window.partitionBy(*keys, "_cell", "_salt").orderBy(F.col("_at").asc_nulls_first(), "_kind")
    latest = F.last("_version", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = rows.withColumn("_found", latest).filter("_kind = 1")

    def of(side: str, name: str) -> Column:
        return F.col(name) if name in keys else F.col(side)[name]

    when, until = of("_fact", at), of("_found", end)
    valid = of("_found", current) | (when <= until if end_inclusive else when < until)
    taken = [F.when(valid, of("_found", old)).alias(new) for old, new in take.items()]
    found = found.select(*[of("_fact", c).alias(c) for c in fact.columns], *taken)
    blank = [F.lit(None).cast(versions.schema[old].dataType).alias(new) for old, new in take.items()]
    return found.unionByName(undated.select(*fact.columns, *blank))


def chunked_join(
    fact: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    at: str,
    take: Mapping[str, str],
    start: str = "effective_date",
    end: str = "end_date",
    current: str = "is_current",
    end_inclusive: bool = True,
) -> DataFrame:
    """Left join of each fact to the version valid on its date, moving facts and versions once.

    The n versions of a key are cut by their starts into lists of about the root of n.
    A fact is joined to the one list whose time it falls into and takes the last version
    in it that has started, which counts if it has not ended. So a fact compares twice
    the root of n and comes out once; the fact side is an ordinary shuffled side, which
    AQE splits where a key is crowded. Versions of a key may not overlap, and of versions
    with one start, one is taken, as in ``sweep_join``.
    """
    by_key = Window.partitionBy(*keys)
    names = [*dict.fromkeys([start, end, current, *take])]
    known = versions.filter(~_any_null([*keys, start])).select(*keys, F.col(start).alias("_from"), F.struct(*names).alias("_version"))
    numbered = known.select(
        *keys, "_from", "_version", F.row_number().over(by_key.orderBy("_from")).alias("_row"), F.count(F.lit(1)).over(by_key).alias("_n")
    )
    entry = F.struct("_row", "_version")
    lists = (
        numbered.withColumn("_list", F.floor((F.col("_row") - 1) / F.ceil(F.sqrt("_n"))))
        .groupBy(*keys, "_list")
        .agg(F.min("_from").alias("_from"), F.array_sort(F.collect_list(entry), lambda a, b: a["_row"] - b["_row"]).alias("_entries"))
        .withColumn("_until", F.lead("_from").over(by_key.orderBy("_list")))
    )
    when = F.col(f"l.{at}")
    on = reduce(lambda a, b: a & b, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys])
    on = on & (when >= F.col("r._from")) & (F.col("r._until").isNull() | (when < F.col("r._until")))
    started = F.size(F.filter("r._entries", lambda e: e["_version"][start] <= when))
    picked = F.get("r._entries", started - 1)["_version"].alias("_found")
    found = fact.alias("l").join(lists.alias("r"), on, "left").select(*[F.col(f"l.{c}") for c in fact.columns], picked)
    until = F.col("_found")[end]
    valid = F.col("_found")[current] | (F.col(at) <= until if end_inclusive else F.col(at) < until)
    return found.select(*fact.columns, *[F.when(valid, F.col("_found")[old]).alias(new) for old, new in take.items()])
