"""Late batches of a slowly changing dimension, against the history of the whole log."""

from __future__ import annotations

import itertools
import random
from datetime import date, datetime, timedelta

import pytest

from lakewright.operators.history import (
    SEEN,
    prepare_versions,
    scd2_apply,
    scd2_from_log,
    scd2_invariants,
    scd2_open,
    scd2_plan,
    scd2_repair,
    scd2_statistics,
)
from lakewright.operators.sets import table_difference

LOG = "k string, state string, at timestamp, id int"
ARGS = (["k"], ["state"], "at", ["id"])


def random_log(rng, n):
    t0 = datetime(2025, 1, 1)
    rows = [(rng.choice(["a", "b", "c", None]), rng.choice(["x", "y", None]), t0 + timedelta(hours=rng.randrange(24 * 30)), i) for i in range(n)]
    # ties in time, told apart by the id
    return rows + [(k, "z", at, i + 1000) for k, _, at, i in rows[:5]]


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_batches_in_any_order_give_the_history_of_the_log(spark, order):
    rng = random.Random(6)
    log = random_log(rng, 90)
    parts = [[r for r in log if r[3] % 3 == k] for k in order]
    dim = scd2_open(spark.createDataFrame(parts[0], LOG), *ARGS)
    for part in [*parts[1:], parts[1]]:
        dim = spark.createDataFrame(scd2_repair(dim, spark.createDataFrame(part, LOG), *ARGS).collect(), dim.schema)
    whole = scd2_from_log(spark.createDataFrame(log, LOG), *ARGS)
    assert table_difference(whole, dim.drop(SEEN)).count() == 0
    assert set(scd2_invariants(dim, ["k"]).first()) == {0}


def test_a_late_change_splits_and_melts(spark):
    def log(*rows):
        return spark.createDataFrame([(k, s, datetime(2025, 1, d), d) for k, s, d in rows], LOG)

    dim = scd2_open(log(("a", "x", 1), ("a", "x", 10), ("b", "x", 1)), *ARGS)
    split = scd2_repair(dim, log(("a", "y", 5)), *ARGS)
    told = sorted((r.k, r.state, r.effective_date.day, r.end_date and r.end_date.day, r.is_current) for r in split.collect())
    assert told == [("a", "x", 1, 4, False), ("a", "x", 10, None, True), ("a", "y", 5, 9, False), ("b", "x", 1, None, True)]
    melted = scd2_repair(split, spark.createDataFrame([("a", "x", datetime(2025, 1, 5, 9), 0)], LOG), *ARGS)
    assert sorted((r.k, r.effective_date.day) for r in melted.collect()) == [("a", 1), ("b", 1)]
    assert scd2_repair(dim, spark.createDataFrame([], LOG), *ARGS).count() == dim.count()
    assert scd2_repair(dim.filter("false"), log(("q", "x", 3)), *ARGS).count() == 1


def test_a_null_key_keeps_one_open_version(spark):
    def batch(value, day):
        return prepare_versions(spark.createDataFrame([(None, value)], "k string, v int"), ["k"], day)

    dim = batch(1, date(2025, 1, 1))
    for value, day in ((1, date(2025, 2, 1)), (2, date(2025, 3, 1)), (2, date(2025, 4, 1))):
        dim = spark.createDataFrame(scd2_apply(dim, batch(value, day), ["k"], ["v"], day).collect(), dim.schema)
    assert sorted((r.v, r.is_current) for r in dim.collect()) == [(1, False), (2, True)]


def test_a_late_batch_is_refused_whatever_is_read(spark):
    def batch(value, day):
        return prepare_versions(spark.createDataFrame([("a", value)], "k string, v int"), ["k"], day)

    dim, day = batch(1, date(2025, 6, 1)), date(2025, 1, 1)
    plan = scd2_plan(dim, batch(2, day), ["k"], ["v"], day)
    for read in (scd2_statistics(plan), plan.select("k"), plan.groupBy().count()):
        with pytest.raises(Exception, match="late batch"):
            read.collect()
