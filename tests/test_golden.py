"""Small tables with known answers."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from lakewright.functions.classify import SUPPRESSION_CODES, at_least_one, in_codes, unless
from lakewright.functions.dates import floor_to_minutes, month_start_from_text, tumbling
from lakewright.functions.keys import compact, hash_key
from lakewright.functions.numbers import engagement_score, money, to_number, virality
from lakewright.functions.text import clean_name
from lakewright.operators.filters import no_empty_strings
from lakewright.operators.history import prepare_versions, scd2_apply, scd2_plan, snapshot, snapshot_start
from lakewright.operators.incremental import append_new, insert_if_absent, lookback_start
from lakewright.operators.joins import pit_join
from lakewright.operators.ranks import average_rank
from lakewright.operators.windows import keep_latest, trend_metrics
from lakewright.plans.labour import PROVINCE_NAMES, clean_layer, raw_layer
from lakewright.plans.rentals import full_moon_reviews, hosts_cleansed, listings_cleansed, listings_with_hosts


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_clean_name():
    assert clean_name("North American Industry Classification System (NAICS)") == "North_American_Industry_Classification_System_NAICS"


def test_month_text(spark):
    df = spark.createDataFrame([("1976-01",), ("nonsense",), (None,)], "m string")
    assert rows(df.select(month_start_from_text(F.col("m")))) == [(date(1976, 1, 1),), (None,), (None,)]


def test_suppression(spark):
    df = spark.createDataFrame([(1, ".."), (2, "x"), (3, None), (4, "E")], "i int, status string")
    flag = in_codes(F.col("status"), SUPPRESSION_CODES)
    out = df.select("i", unless(flag, to_number(F.lit("5"))), flag)
    assert rows(out, "i") == [(1, None, True), (2, None, True), (3, 5.0, False), (4, 5.0, False)]


def test_keep_latest(spark):
    df = spark.createDataFrame(
        [("a", datetime(2026, 1, 1, 10), 1), ("a", datetime(2026, 1, 1, 11), 2), ("b", None, 3), ("b", datetime(2026, 1, 1, 9), 4), ("b", datetime(2026, 1, 1, 9), 5)],
        "k string, t timestamp, v int",
    )
    assert rows(keep_latest(df, ["k"], "t", ["v"]).select("k", "v"), "k") == [("a", 2), ("b", 5)]


def test_trend(spark):
    df = spark.createDataFrame(
        [("a", date(2026, 1, 1), 100.0), ("a", date(2026, 2, 1), 110.0), ("a", date(2026, 3, 1), 99.0), ("z", date(2026, 1, 1), 0.0), ("z", date(2026, 2, 1), 5.0)],
        "k string, m date, v double",
    )
    out = trend_metrics(df, ["k"], "m", "v", {"mom": 1}).select("k", "mom_change", "mom_change_pct", "rolling_3_avg", "m")
    assert [r[:4] for r in rows(out, "k", "m")] == [
        ("a", None, None, 100.0),
        ("a", 10.0, 10.0, 105.0),
        ("a", -11.0, -10.0, 103.0),
        ("z", None, None, 0.0),
        ("z", 5.0, None, 2.5),
    ]


def test_trend_calendar_skips_gaps(spark):
    df = spark.createDataFrame([("a", date(2025, 1, 1), 1.0), ("a", date(2026, 1, 1), 3.0), ("a", date(2026, 2, 1), 9.0)], "k string, m date, v double")
    lags = {"mom": 1, "yoy": 12}
    out = trend_metrics(df, ["k"], "m", "v", lags, mode="calendar").select("m", "mom_change", "yoy_change", "rolling_3_avg")
    assert [r[1:] for r in rows(out, "m")] == [(None, None, 1.0), (None, 2.0, 3.0), (6.0, None, 6.0)]
    by_rows = trend_metrics(df, ["k"], "m", "v", lags).select("m", "mom_change")
    assert [r[1] for r in rows(by_rows, "m")] == [None, 2.0, 6.0]


def test_feature_formulas(spark):
    df = spark.createDataFrame([(2, 1, 1, 4), (2, 0, 0, 0)], "l bigint, s bigint, c bigint, i bigint")
    out = df.select(engagement_score(F.col("l"), F.col("s"), F.col("c"), F.col("i")), virality(F.col("s"), F.col("i")))
    assert rows(out) == [(Decimal("3.7500"), Decimal("0.2500")), (Decimal("0.0000"), None)]


def test_window_edges(spark):
    df = spark.createDataFrame([(datetime(2026, 1, 1, 12, 4, 59, 999000),), (datetime(2026, 1, 1, 12, 5),)], "t timestamp")
    out = df.select(tumbling(F.col("t")).getField("start"), floor_to_minutes(F.col("t")))
    assert rows(out) == [(datetime(2026, 1, 1, 12), datetime(2026, 1, 1, 12)), (datetime(2026, 1, 1, 12, 5), datetime(2026, 1, 1, 12, 5))]


def test_money_and_nights(spark):
    df = spark.createDataFrame([("$120.00", 0), ("$1,200.00", 1), ("free", 30)], "p string, n int")
    out = df.select(money(F.col("p")), money(F.col("p"), True), at_least_one(F.col("n")))
    assert rows(out) == [(Decimal("120.00"), Decimal("120.00"), 1), (None, Decimal("1200.00"), 1), (None, None, 30)]


def test_full_moon(spark):
    reviews = spark.createDataFrame([(datetime(2025, 1, d),) for d in (13, 14, 15)], "review_date timestamp")
    moons = spark.createDataFrame([(date(2025, 1, 14),)], "full_moon_date date")
    out = full_moon_reviews(reviews, moons).orderBy("review_date")
    assert [r["is_full_moon"] for r in out.collect()] == ["not full moon", "not full moon", "full moon"]


def test_listing_without_host(spark):
    at = datetime(2026, 1, 1)
    listing = "id int, listing_url string, name string, room_type string, minimum_nights int, host_id int, price string, created_at timestamp, updated_at timestamp"
    raw = spark.createDataFrame([(1, "u", "n", "Hotel room", 0, 7, "$50.00", at, at), (2, "u", "m", "Hotel room", 3, 8, "$60.00", at, at)], listing)
    hosts = spark.createDataFrame([(8, None, "t", at, datetime(2026, 2, 1))], "id int, name string, is_superhost string, created_at timestamp, updated_at timestamp")
    out = listings_with_hosts(listings_cleansed(raw), hosts_cleansed(hosts)).select("listing_id", "minimum_nights", "host_name", "updated_at")
    assert rows(out, "listing_id") == [(1, 1, None, None), (2, 3, "Anonymous", datetime(2026, 2, 1))]


def dimension(spark, data, as_of):
    return prepare_versions(spark.createDataFrame(data, "k string, v double, s string"), ["k"], as_of)


def state(df):
    return rows(df.select("k", "v", "s", "effective_date", "end_date", "is_current"), "k", "effective_date")


def test_scd2(spark):
    first, second = date(2026, 1, 1), date(2026, 5, 10)
    dim = dimension(spark, [("same", 1.0, None), ("changed", 5.4, None), ("nulled", 2.0, None), ("absent", 3.0, None)], first)
    batch = dimension(spark, [("same", 1.0, None), ("changed", 7.2, None), ("nulled", 2.0, "x"), ("new", 9.0, None)], second)
    plan = scd2_plan(dim, batch, ["k"], ["v", "s"], second)
    assert dict(rows(plan.groupBy("_action").count())) == {"kept": 2, "expired": 2, "new_version": 2, "new_entity": 1}
    assert state(plan) == [
        ("absent", 3.0, None, first, None, True),
        ("changed", 5.4, None, first, date(2026, 5, 9), False),
        ("changed", 7.2, None, second, None, True),
        ("new", 9.0, None, second, None, True),
        ("nulled", 2.0, None, first, date(2026, 5, 9), False),
        ("nulled", 2.0, "x", second, None, True),
        ("same", 1.0, None, first, None, True),
    ]


def test_scd2_same_day_replaces(spark):
    day = date(2026, 1, 1)
    dim = dimension(spark, [("a", 1.0, None)], day)
    out = scd2_apply(dim, dimension(spark, [("a", 2.0, None)], day), ["k"], ["v", "s"], day)
    assert state(out) == [("a", 2.0, None, day, None, True)]


def test_scd2_reopens_a_closed_key(spark):
    dim = dimension(spark, [("a", 1.0, None)], date(2026, 1, 1)).withColumns({"end_date": F.lit(date(2026, 2, 1)), "is_current": F.lit(False)})
    plan = scd2_plan(dim, dimension(spark, [("a", 1.0, None)], date(2026, 3, 1)), ["k"], ["v", "s"], date(2026, 3, 1))
    assert sorted(r["_action"] for r in plan.collect()) == ["history", "new_version"]


def test_point_in_time(spark):
    dim = spark.createDataFrame(
        [("a", "v1", date(2026, 1, 1), date(2026, 1, 31), False), ("a", "v2", date(2026, 2, 1), None, True)],
        "k string, ver string, effective_date date, end_date date, is_current boolean",
    )
    facts = spark.createDataFrame([("a", date(2026, 1, 31)), ("a", date(2026, 2, 1)), ("a", date(2025, 12, 31)), (None, date(2026, 2, 1))], "k string, d date")
    expected = [(None, date(2026, 2, 1), None), ("a", date(2025, 12, 31), None), ("a", date(2026, 1, 31), "v1"), ("a", date(2026, 2, 1), "v2")]
    for method in ("auto", "broadcast", "salted", "monthly"):
        assert rows(pit_join(facts, dim, ["k"], "d", {"ver": "ver"}, method=method), "k", "d") == expected, method
    half_open = pit_join(facts, dim, ["k"], "d", {"ver": "ver"}, end_inclusive=False)
    assert dict((r["d"], r["ver"]) for r in half_open.filter("k = 'a'").collect())[date(2026, 1, 31)] is None


def test_snapshot(spark):
    schema = "id int, v string, updated_at timestamp"
    t1, t2, end = datetime(2026, 1, 1), datetime(2026, 2, 1), datetime(2026, 3, 1)
    start = snapshot_start(spark.createDataFrame([(1, "a", t1), (2, "b", t1), (3, "c", t1)], schema), "id", "updated_at")
    source = spark.createDataFrame([(1, "a", t1), (2, "B", t2), (4, "d", t2)], schema)
    out = snapshot(start, source, "id", "updated_at", end).select("id", "v", "valid_from", "valid_to")
    assert rows(out, "id", "valid_from") == [(1, "a", t1, None), (2, "b", t1, t2), (2, "B", t2, None), (3, "c", t1, end), (4, "d", t2, None)]
    kept = snapshot(start, source, "id", "updated_at", end, "ignore").filter("id = 3")
    assert kept.first()["valid_to"] is None


def test_snapshot_again_changes_nothing(spark):
    schema = "id int, v string, updated_at timestamp"
    source = spark.createDataFrame([(1, "a", datetime(2026, 1, 1))], schema)
    once = snapshot(snapshot_start(source, "id", "updated_at"), source, "id", "updated_at", datetime(2026, 2, 1))
    assert rows(once) == rows(snapshot_start(source, "id", "updated_at"))


def test_upsert_duplicates(spark):
    stored = spark.createDataFrame([("e1", 1)], "event_id string, v int")
    batch = spark.createDataFrame([("e1", 9), ("e2", 2), ("e2", 2)], "event_id string, v int")
    once = insert_if_absent(stored, batch, ["event_id"], "v", ["event_id"])
    assert rows(once, "event_id") == [("e1", 1), ("e2", 2)]
    assert rows(insert_if_absent(once, batch, ["event_id"], "v", ["event_id"]), "event_id") == rows(once, "event_id")


def test_high_water_mark(spark):
    target = spark.createDataFrame([(1, date(2026, 1, 1))], "i int, d date")
    source = spark.createDataFrame([(2, date(2026, 1, 1)), (3, date(2026, 1, 2))], "i int, d date")
    assert rows(append_new(target, source, "d").select("i"), "i") == [(1,), (3,)]
    assert rows(append_new(target, source, "d", inclusive=True, keys=["i"]).select("i"), "i") == [(1,), (2,), (3,)]
    assert append_new(target.limit(0), source, "d").count() == 2


def test_average_rank(spark):
    df = spark.createDataFrame([(1, 9.0), (2, 7.0), (3, 7.0), (4, 5.0), (5, None)], "i int, s double")
    assert rows(average_rank(df, "s").select("i", "avg_rank"), "i") == [(1, 1.0), (2, 2.5), (3, 2.5), (4, 4.0), (5, None)]


def test_lookback_is_aligned():
    from datetime import timedelta

    assert lookback_start(datetime(2026, 1, 1, 13, 37, 21), timedelta(hours=2), timedelta(minutes=5)) == datetime(2026, 1, 1, 11, 35)


def test_null_parts_of_keys(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None)], "x string, y string")
    assert df.select(hash_key(["x", "y"])).distinct().count() == 2


def test_compact_keeps_texts_apart(spark):
    texts = ["", "a", "x" * 64, "x" * 65, "x" * 66, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("c", compact(F.col("t")))
    assert df.select("c").distinct().count() == len(texts)
    assert all(r["c"] is None or len(r["c"]) <= 65 for r in df.collect())


def test_empty_string_predicate(spark):
    df = spark.createDataFrame([("a", "b", 1), ("", "b", 1), (None, "b", 1)], "x string, y string, n int")
    assert df.filter(no_empty_strings(df)).count() == 1
    numbers = df.select("n")
    assert numbers.filter(no_empty_strings(numbers)).count() == 3


def test_raw_to_clean(spark):
    names = list(PROVINCE_NAMES)[:-2]
    header = [{"Labour_force_characteristics": "Labour force characteristics", "Age_group": "Age group", "Data_type": "Data type"}.get(n, n) for n in names]
    base = {n: "t" for n in header} | {"REF_DATE": "1976-01", "GEO": "Ontario", "VALUE": "10.5", "STATUS": None}
    early = spark.createDataFrame([tuple(base[n] for n in header)], ", ".join(f"`{n}` string" for n in header))
    late = spark.createDataFrame([tuple((base | {"VALUE": "11.5"})[n] for n in header)], early.schema)
    raw = raw_layer(early, ["SYMBOL"], "f.csv", datetime(2026, 1, 1, 10)).unionByName(raw_layer(late, ["SYMBOL"], "f.csv", datetime(2026, 1, 1, 11)))
    key = ["ref_date", "geo", "labour_force_characteristic", "gender", "age_group", "statistic_type", "data_type"]
    row = clean_layer(raw, PROVINCE_NAMES, key).collect()
    assert len(row) == 1
    assert (row[0]["value"], row[0]["ref_date"], row[0]["ref_year"], row[0]["ref_month"], row[0]["is_suppressed"]) == (11.5, date(1976, 1, 1), "1976", "01", False)
