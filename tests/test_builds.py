"""Whole builds on the small tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakewright.catalog import standins
from lakewright.operators.history import scd2_invariants
from lakewright.operators.quality import DataQualityError
from lakewright.operators.sets import table_difference
from lakewright.plans.builds import build_features, build_labour, build_rentals, start_clean_events, start_engagement
from lakewright.plans.labour import DIMENSION_KEY
from lakewright.sources.files import read_table
from lakewright.sources.seeds import full_moons
from lakewright.sources.streams import table_stream
from lakewright.streaming.features import user_features
from lakewright.streaming.ingest import run_available
from tests.conftest import SMALL


def to_csv(df, path):
    df.write.mode("overwrite").option("header", True).option("nullValue", "").csv(str(path))
    return str(path)


def test_labour_build_twice(spark, tmp_path):
    province = standins.province_arrival(spark, SMALL)
    files = to_csv(province, tmp_path / "p"), to_csv(standins.industry_arrival(spark, SMALL), tmp_path / "i")
    root = str(tmp_path / "lake")
    first = build_labour(spark, *files, root, date(2001, 9, 1), datetime(2001, 9, 1, 10))
    assert {r["status"] for r in first} <= {"PASS", "WARN"}
    mart = spark.read.parquet(f"{root}/gold/mart")
    assert mart.count() > 0 and mart.filter("geo_key is null or dim_employment_sk is null").count() == 0
    size = spark.table("dim_employment").count()
    build_labour(spark, *files, root, date(2001, 10, 1), datetime(2001, 10, 1, 10))
    assert spark.table("dim_employment").count() == size
    raised = province.withColumn("VALUE", (F.col("VALUE").cast("decimal(18,1)") + 1).cast("decimal(18,1)").cast("string"))
    build_labour(spark, to_csv(raised, tmp_path / "p2"), files[1], root, date(2001, 11, 1), datetime(2001, 11, 1, 10))
    dim = spark.table("dim_employment")
    assert dim.count() == 2 * size
    assert set(scd2_invariants(dim.withColumn("is_current", F.col("is_current").cast("boolean")), DIMENSION_KEY).first()) == {0}


def test_labour_gate_stops_the_build(spark, tmp_path):
    broken = standins.province_arrival(spark, SMALL).withColumn("VALUE", F.lit("-1"))
    files = to_csv(broken, tmp_path / "p"), to_csv(standins.industry_arrival(spark, SMALL), tmp_path / "i")
    with pytest.raises(DataQualityError, match="value_range"):
        build_labour(spark, *files, str(tmp_path / "lake"), date(2001, 9, 1))
    assert not (tmp_path / "lake" / "gold").exists()


def test_engagement_streams(spark, tmp_path):
    log, root = str(tmp_path / "log"), str(tmp_path / "lake")
    messages = standins.engagement_messages(spark, SMALL)
    messages.write.parquet(log)
    query, raw_path = start_engagement(spark, table_stream(spark, log, messages.schema), root, every=None)
    run_available(query)
    raw = read_table(spark, raw_path)
    assert raw.count() == messages.count()
    query, clean_path = start_clean_events(table_stream(spark, raw_path, raw.schema), root, every=None)
    run_available(query)
    clean = read_table(spark, clean_path)
    assert clean.count() == clean.select("event_id").distinct().count() > 0
    stored = read_table(spark, build_features(spark, root))
    assert table_difference(user_features(clean), stored).count() == 0


def test_rentals_build_twice(spark, tmp_path):
    raw = {
        "listings": standins.raw_listings(spark, SMALL),
        "hosts": standins.raw_hosts(spark, SMALL),
        "reviews": standins.raw_reviews(spark, SMALL),
    }
    moons = full_moons(spark, date(1995, 1, 1), date(2001, 12, 31))
    with pytest.raises(DataQualityError, match="host_known"):
        build_rentals(spark, raw, moons, str(tmp_path / "broken"))
    known = raw["hosts"].select(F.col("id").alias("host_id"))
    raw["listings"] = raw["listings"].join(known, "host_id", "left_semi").select(*raw["listings"].columns).withColumn("price", F.lit("$120.00"))
    root = str(tmp_path / "lake")
    early = raw | {"reviews": raw["reviews"].filter(F.col("date") < F.lit(datetime(1999, 1, 1)))}
    build_rentals(spark, early, moons, root)
    results = build_rentals(spark, raw, moons, root)
    assert {r["status"] for r in results} == {"PASS", "WARN"}
    reviews = read_table(spark, f"{root}/fact_reviews")
    assert reviews.count() == raw["reviews"].filter("comments is not null").count()
    mart = read_table(spark, f"{root}/mart_full_moon")
    day_after = {r[0] + timedelta(days=1) for r in moons.collect()}
    flagged = {r[0] for r in mart.filter("is_full_moon = 'full moon'").select(F.to_date("review_date")).distinct().collect()}
    assert flagged and flagged <= day_after
