"""A reproducible shuffle of a table into shards: a Feistel permutation of global row numbers.

Rows are numbered without gaps in key order. Numbers below ``n`` are read as pairs
(l, r) of Z_a x Z_b with a = ceil(sqrt(n)) and b = ceil(n / a); alternate rounds add
a keyed hash of one half to the other, so the network is a permutation of a x b.
The fewer than ``a`` pairs at or beyond ``n`` are left by cycle walking: the network
is applied again until the number is below ``n``. Shard and slot of a row follow
from its permuted number alone: ``p % shards`` and ``p // shards``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakewright.llm.tables import settled, unused

ROUNDS = 8
# Two primes just below 2^31: products of two numbers below them fit a long.
P1, P2 = 2147483647, 2147483629
PLACE_BITS = 33


def round_keys(seed: int) -> list[tuple[int, int, int, int]]:
    """Two multipliers and two shifts per round, from a linear congruence on the seed."""
    keys, state = [], seed % P1
    for _ in range(ROUNDS):
        drawn = []
        for _ in range(4):
            state = (state * 48271 + 11) % P1
            drawn.append(state % (P2 - 2) + 1)
        keys.append(tuple(drawn))
    return keys


def _div(p: Column, b: int) -> Column:
    return ((p - p % b) / F.lit(b)).cast("long")


def sides(n: int) -> tuple[int, int]:
    a = math.isqrt(max(n, 1) - 1) + 1
    return a, -(-max(n, 1) // a)


def _network(p: Column, a: int, b: int, seed: int) -> Column:
    """The image of ``p``, folded over the keys of two rounds at a time."""
    keys = round_keys(seed)
    pairs = F.array(*[F.array(*[F.lit(x).cast("long") for x in (*keys[i], *keys[i + 1])]) for i in range(0, ROUNDS, 2)])

    def mixed(half: Column, k: Column, at: int) -> Column:
        return (((half * k[at] + k[at + 1]) % P1) * k[at + 2] + k[at + 3]) % P2

    def two_rounds(pair: Column, k: Column) -> Column:
        left = (pair["l"] + mixed(pair["r"], k, 0)) % a
        return F.struct(left.alias("l"), ((pair["r"] + mixed(left, k, 4)) % b).alias("r"))

    # bound by a lambda, so that ``p`` is evaluated once
    start = F.transform(F.array(p), lambda q: F.struct(_div(q, b).alias("l"), (q % b).alias("r")))[0]
    return F.aggregate(pairs, start, two_rounds, lambda pair: pair["l"] * b + pair["r"])


def walk_length(spark: SparkSession, n: int, seed: int) -> int:
    """How often the network must be applied at most so that every number below ``n`` comes back below it.

    Only the fewer than sqrt(n) + 1 numbers beyond ``n`` can prolong a walk, so only those are followed.
    They lie on paths that come from below ``n`` and lead back, each of which loses one number at every
    step until it is over, and on closed cycles, which no walk from below ``n`` ever enters. So once a
    step loses none, only cycles are left.
    """
    a, b = sides(n)
    outside, before, steps = spark.range(n, a * b).select(F.col("id").alias("p")), a * b - n, 1
    while before:
        outside = settled(outside.select(_network(F.col("p"), a, b, seed).alias("p")).filter(F.col("p") >= n), "walks")
        left = outside.count()
        if left == before:
            break
        before, steps = left, steps + 1
    return steps


def permuted(row: Column, n: int, seed: int, steps: int) -> Column:
    """The place in the shuffle of the number ``row`` (0 to ``n`` - 1)."""
    a, b = sides(n)
    first = _network(row, a, b, seed)
    if steps == 1:
        return first
    again = F.array_repeat(F.lit(0), steps - 1)
    return F.aggregate(again, first, lambda p, _: F.when(p < n, p).otherwise(_network(p, a, b, seed)))


def numbered(df: DataFrame, keys: list[str], name: str) -> tuple[DataFrame, int]:
    """``df`` with the column ``name``, gapless from 0 in the order of ``keys``, and the number of rows.

    Rows that agree in all keys are told apart by their place in the input, so that any
    number of them is spread over ranges; which of them gets which number may differ
    from run to run.
    """
    tie, place, part, start = unused([*df.columns, name], "_tie", "_place", "_range", "_start")
    ordered = df.withColumn(tie, F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange(*keys, tie).sortWithinPartitions(*keys, tie).drop(tie)
    placed = settled(ordered.withColumn(place, F.monotonically_increasing_id()), "row-numbers")
    placed = placed.withColumn(part, F.shiftright(place, PLACE_BITS))
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(start))
    n = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    # one row per range of the shuffle, whatever the table holds
    joined = placed.join(F.broadcast(starts), part)
    row = F.col(start) + F.col(place).bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return joined.withColumn(name, row).drop(place, part, start), n


def feistel_shards(df: DataFrame, keys: list[str], shards: int, seed: int = 20240229) -> DataFrame:
    """``df`` with ``shard`` (int, 0 to ``shards`` - 1) and ``slot`` (long, gapless from 0 in each shard).

    Shard sizes differ by one row at most. The result depends on the rows' order by
    ``keys``, the number of rows and the seed only, not on partitions. Null keys sort
    first. Rows alike in all keys are each placed; an empty table gives no rows.
    Columns named ``shard`` or ``slot`` are replaced, all others stay.
    """
    kept = df.drop("shard", "slot")
    row_no, p = unused([*kept.columns, "shard", "slot"], "_row_no", "_p")
    rows, n = numbered(kept, keys, row_no)
    placed = rows.withColumn(p, permuted(F.col(row_no), n, seed, walk_length(df.sparkSession, n, seed)))
    return placed.withColumns({"shard": (F.col(p) % shards).cast("int"), "slot": F.expr(f"{p} div {shards}")}).drop(p, row_no)
