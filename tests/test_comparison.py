"""Table comparison by checksums, and orphans as rows."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakewright.operators.joins import orphan_rows
from lakewright.operators.quality import Check, failing_rows
from lakewright.operators.sets import bucket_sums, table_difference

SCHEMA = "i int, s string, d double, a array<int>"


def random_rows(rng, n):
    return [
        (rng.choice([None, 1, 2, 3]), rng.choice([None, "x", "y"]), rng.choice([None, 0.0, -0.0, 1.5, float("nan")]), rng.choice([None, [1, None], [None, 1], []]))
        for _ in range(n)
    ]


def key(row):
    return tuple("nan" if x != x else x + 0.0 if isinstance(x, float) else tuple(x) if isinstance(x, list) else x for x in row)


@pytest.mark.parametrize("buckets", [1, 7, 1024])
def test_differences_equal_counting(spark, buckets):
    rng = random.Random(buckets)
    left = random_rows(rng, 300)
    right = rng.sample(left, 300)
    for k in range(0, 300, 60):
        right[k] = random_rows(rng, 1)[0]
    frames = [spark.createDataFrame(x, SCHEMA) for x in (left, right)]
    a, b = (Counter(map(key, x)) for x in (left, right))
    got = {key(tuple(r)[:4]): (r.expected_rows, r.actual_rows) for r in table_difference(*frames, buckets=buckets).collect()}
    assert got == {k: (a[k], b[k]) for k in a.keys() | b.keys() if a[k] != b[k]}
    assert table_difference(frames[0], frames[0].orderBy(F.rand(3)).repartition(3), buckets=buckets).count() == 0


def test_equal_tables_meet_in_buckets_only(spark):
    df = spark.range(20_000).select("id", F.lit("text").alias("t"))
    sides = df.withColumns({"_e": F.lit(1), "_a": F.lit(0)}).unionByName(df.withColumns({"_e": F.lit(0), "_a": F.lit(1)}))
    sums = bucket_sums(sides, ["id", "t"], 64)
    assert sums.count() == 64 and sums.filter("_n <> 0 OR _s1 <> 0 OR _s2 <> 0").count() == 0
    moved = df.withColumn("t", F.when(F.col("id") == 5, "other").otherwise(F.col("t")))
    assert table_difference(df, moved).count() == 2
    # NULLs that change places are told apart
    swapped = [spark.createDataFrame([r], "a string, b string") for r in ((None, "x"), ("x", None))]
    assert table_difference(*swapped).count() == 2


def test_orphans_as_rows(spark):
    child = spark.createDataFrame([(1, 5), (2, 6), (3, 6), (4, None)], "id int, parent int")
    parent = spark.createDataFrame([(5,), (None,), (5,)], "id int")
    found = orphan_rows(child, "parent", parent, "id")
    assert sorted(r.id for r in found.collect()) == [2, 3]
    check = Check("child", "known", "relationship", "parent", args={"parent": "parent", "parent_column": "id"})
    rows = failing_rows(child, check, {"parent": parent}).collect()
    assert sorted((r.id, r.reason) for r in rows) == [(2, "known"), (3, "known")]
    assert orphan_rows(child, "parent", parent.filter("false"), "id").count() == 3
    with pytest.raises(ValueError):
        failing_rows(child, check)
