"""Most frequent values by sketch and exact count, where the sketch decides and where it cannot."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lakewright.operators import aggregates
from lakewright.operators.aggregates import top_values


def expected(values, n):
    return sorted(Counter(values).items(), key=lambda x: (-x[1], x[0] is not None, x[0]))[:n]


@pytest.mark.parametrize("kind", ["hot", "flat", "few", "ties", "empty"])
@pytest.mark.parametrize("tracked", [64, 10_000])
def test_equals_the_full_count(spark, kind, tracked):
    rng = random.Random(8)
    values = {
        "hot": [rng.choice(["a", "b", "c", None]) if rng.random() < 0.5 else str(rng.randrange(5000)) for _ in range(6000)],
        "flat": [str(k % 3000) for k in range(6000)],
        "few": ["x", "y", "x", None],
        "ties": [str(k % 20) for k in range(400)],
        "empty": [],
    }[kind]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(3)
    assert [(r.v, r.n_rows) for r in top_values(df, "v", 3, tracked).collect()] == expected(values, 3)


def test_only_candidates_are_counted_where_the_bound_decides(spark, monkeypatch):
    counted = []
    own = aggregates.group_counts

    def watched(df, keys):
        result = own(df, keys)
        counted.append(result)
        return result

    monkeypatch.setattr(aggregates, "group_counts", watched)
    hot = spark.range(60_000).select(F.when(F.col("id") % 4 < 3, F.col("id") % 4).otherwise(F.col("id")).alias("v"))
    assert {r.v: r.n_rows for r in top_values(hot, "v", 3).collect()} == {0: 15_000, 1: 15_000, 2: 15_000}
    assert counted[1].count() <= 30 and counted[0].count() == 15_003
    arrays = spark.createDataFrame([([1],), ([1],), ([2],)], "v array<int>")
    assert top_values(arrays, "v", 1).first()["n_rows"] == 2
