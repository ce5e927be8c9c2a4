"""Incremental loading, slowly changing dimensions and snapshots."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.catalog import standins as s
from lakewright.catalog.base import query, table
from lakewright.catalog.joins import CUTS, HISTORY, TRACKED, at_first, at_second, customer_history
from lakewright.catalog.sources import FEATURES, NAMES
from lakewright.functions.dates import moment
from lakewright.operators.history import (
    SEEN,
    prepare_versions,
    scd2_apply,
    scd2_invariants,
    scd2_open,
    scd2_plan,
    scd2_repair,
    scd2_statistics,
    snapshot,
    snapshot_start,
)
from lakewright.operators.incremental import append_new, batch_ranges, in_range, insert_if_absent
from lakewright.operators.windows import keep_latest
from lakewright.plans.engagement import refresh_features
from lakewright.plans.rentals import FULL_MOON, full_moon_reviews, review_fact
from lakewright.session import scratch_path
from lakewright.sinks.tables import append_table, overwrite_partitions
from lakewright.sources.files import read_table, table_exists
from lakewright.sources.seeds import full_moons
from lakewright.streaming.features import user_features

FIRST_DAY, SECOND_DAY, THIRD_DAY = date(1999, 1, 1), date(2001, 9, 1), date(2001, 10, 1)


@query(
    "inc_01_high_water_mark",
    """SELECT o_orderkey, o_orderdate, CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'first' ELSE 'second' END AS load
       FROM orders""",
)
def high_water_mark(spark: SparkSession, sf: str) -> DataFrame:
    """A target filled up to a day, then the whole source: only later rows are added."""
    path = scratch_path(spark, "mark")
    source = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.lit("second").alias("load"))
    early = source.filter(F.col("o_orderdate") < moment(date(2000, 1, 1), "timestamp_ntz")).withColumn("load", F.lit("first"))
    append_table(early, path)
    return append_new(read_table(spark, path), source, "o_orderdate")


@query(
    "inc_01_inclusive_mark",
    """SELECT o_orderkey, o_orderdate FROM orders""",
)
def inclusive_mark(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that share the newest time of the target are still added, by key."""
    path = scratch_path(spark, "inclusive")
    source = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    limit = moment(date(2000, 1, 1), "timestamp_ntz")
    status = table(spark, sf, "orders").filter(
        (F.col("o_orderdate") < limit) | ((F.col("o_orderdate") == limit) & (F.col("o_orderstatus") == "F"))
    )
    append_table(status.select("o_orderkey", "o_orderdate"), path)
    return append_new(read_table(spark, path), source, "o_orderdate", inclusive=True, keys=["o_orderkey"])


REFRESH_AT = datetime(2024, 1, 20, 13, 37, 21)


@query(
    "inc_02_lookback_merge",
    f"""WITH {FEATURES.format(width='5 minutes')}
        SELECT user_id, window_start, window_end, total_likes, total_shares, total_comments, total_impressions, engagement_score, content_virality
        FROM scored WHERE window_start < TIMESTAMP '2024-01-20 11:35:00'
        UNION ALL
        SELECT user_id, window_start, window_end, total_likes, total_shares, total_comments, total_impressions, engagement_score, content_virality
        FROM scored WHERE window_start >= TIMESTAMP '2024-01-20 11:35:00'""",
)
def lookback_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Features up to a time, then the last two hours and everything newer again: equal to a full rebuild."""
    events = table(spark, sf, "events")
    stored = user_features(events.filter(F.col("ts") < moment(REFRESH_AT, "timestamp_ntz")), "ts", names=NAMES)
    return refresh_features(stored, events, REFRESH_AT, at="ts", names=NAMES)


@query(
    "inc_03_time_batches",
    f"""WITH {s.REVIEWS},{s.MOONS}
        SELECT year(review_date)::integer AS review_year, count(*) AS reviews, count(full_moon_date) AS full_moon_reviews
        FROM reviews LEFT JOIN moons ON review_date::date = full_moon_date + 1 GROUP BY 1""",
)
def time_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The mart rebuilt year by year, each batch replacing its own partition."""
    path = scratch_path(spark, "batches")
    reviews = review_fact(s.raw_reviews(spark, sf))
    span = reviews.agg(F.to_date(F.min("review_date")).alias("a"), F.to_date(F.max("review_date")).alias("b")).first()
    moons = full_moons(spark, span["a"] - timedelta(days=1), span["b"])
    for start, stop in batch_ranges(span["a"], span["b"], "year"):
        batch = full_moon_reviews(in_range(reviews, "review_date", start, stop), moons)
        overwrite_partitions(batch.withColumn("review_year", F.year("review_date")), path, ["review_year"])
    return read_table(spark, path).groupBy("review_year").agg(
        F.count(F.lit(1)).alias("reviews"), F.count_if(F.col("is_full_moon") == FULL_MOON).alias("full_moon_reviews")
    )


@query(
    "inc_04_insert_if_absent",
    """WITH stored AS (SELECT event_id, user_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-15')
       SELECT * FROM stored UNION ALL
       SELECT event_id, user_id, 'late ' || event_type FROM events WHERE event_id NOT IN (SELECT event_id FROM stored)""",
)
def absent_inserted(spark: SparkSession, sf: str) -> DataFrame:
    """A batch that repeats everything, twice over, adds each missing event once."""
    events = table(spark, sf, "events")
    columns = ["event_id", "user_id", "event_type"]
    stored = events.filter(F.col("ts") < moment(date(2024, 1, 15), "timestamp_ntz")).select(*columns)
    batch = events.select("event_id", "user_id", F.concat(F.lit("late "), F.col("event_type")).alias("event_type"))
    return insert_if_absent(stored, batch.unionByName(batch), ["event_id"], "user_id", ["event_type"])


# A customer row is as of the last order. The second look is at all orders; a customer whose last order is finished has left by then.
SNAPSHOT_SQL = """
first_look AS (
  SELECT o_custkey, o_orderpriority, o_orderdate AS updated_at FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
),
second_look AS (
  SELECT o_custkey, o_orderpriority, updated_at FROM (
    SELECT o_custkey, o_orderpriority, o_orderstatus, o_orderdate AS updated_at FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
  ) WHERE o_orderstatus <> 'F'
),
versions AS (
  SELECT o.o_custkey, o.o_orderpriority, o.updated_at, o.updated_at AS valid_from,
         CASE WHEN n.updated_at > o.updated_at THEN n.updated_at WHEN n.o_custkey IS NULL AND {invalidate} THEN TIMESTAMP '2002-01-01' END AS valid_to
  FROM first_look o LEFT JOIN second_look n ON o.o_custkey = n.o_custkey
  UNION ALL
  SELECT n.o_custkey, n.o_orderpriority, n.updated_at, n.updated_at, NULL
  FROM second_look n LEFT JOIN first_look o ON o.o_custkey = n.o_custkey WHERE o.o_custkey IS NULL OR n.updated_at > o.updated_at
)"""


def _looks(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf, "orders")
    columns = ["o_custkey", "o_orderpriority", F.col("o_orderdate").alias("updated_at")]

    def newest(rows: DataFrame) -> DataFrame:
        return keep_latest(rows, ["o_custkey"], "o_orderdate", ["o_orderkey"])

    first = newest(orders.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")))
    second = newest(orders).filter(F.col("o_orderstatus") != "F")
    return first.select(*columns), second.select(*columns)


def _snapshot(spark: SparkSession, sf: str, hard_deletes: str) -> DataFrame:
    first, second = _looks(spark, sf)
    start = snapshot_start(first, "o_custkey", "updated_at")
    return snapshot(start, second, "o_custkey", "updated_at", datetime(2002, 1, 1), hard_deletes)


SNAPSHOT_KEY = "md5(concat_ws('|', o_custkey::varchar, strftime(updated_at, '%Y-%m-%d %H:%M:%S'))) AS version_key"


@query("inc_05_snapshot", f"WITH {SNAPSHOT_SQL.format(invalidate='true')} SELECT *, {SNAPSHOT_KEY} FROM versions")
def snapshot_with_deletes(spark: SparkSession, sf: str) -> DataFrame:
    return _snapshot(spark, sf, "invalidate")


@query("inc_05_snapshot_keeping_deleted", f"WITH {SNAPSHOT_SQL.format(invalidate='false')} SELECT *, {SNAPSHOT_KEY} FROM versions")
def snapshot_without_deletes(spark: SparkSession, sf: str) -> DataFrame:
    return _snapshot(spark, sf, "ignore")


SCD2_SQL = f"""{CUTS},
result AS (
  SELECT o.o_custkey, o.o_orderkey, o.o_orderpriority, o.o_orderstatus, DATE '1999-01-01' AS effective_date,
         CASE WHEN n.o_custkey IS NOT NULL AND (n.o_orderpriority IS DISTINCT FROM o.o_orderpriority OR n.o_orderstatus IS DISTINCT FROM o.o_orderstatus)
              THEN DATE '2001-08-31' END AS end_date
  FROM at_first o LEFT JOIN at_second n ON o.o_custkey = n.o_custkey
  UNION ALL
  SELECT n.o_custkey, n.o_orderkey, n.o_orderpriority, n.o_orderstatus, DATE '2001-09-01', NULL
  FROM at_second n LEFT JOIN at_first o ON o.o_custkey = n.o_custkey
  WHERE o.o_custkey IS NULL OR n.o_orderpriority IS DISTINCT FROM o.o_orderpriority OR n.o_orderstatus IS DISTINCT FROM o.o_orderstatus
)"""


def _dimension(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return (
        prepare_versions(at_first(spark, sf), ["o_custkey"], FIRST_DAY),
        prepare_versions(at_second(spark, sf), ["o_custkey"], SECOND_DAY),
    )


@query(
    "inc_06_scd2_apply",
    f"""WITH {SCD2_SQL} SELECT sha256(concat_ws('|', o_custkey::varchar, effective_date::varchar)) AS version_key, o_custkey, o_orderkey, o_orderpriority,
          o_orderstatus, effective_date::varchar AS effective_date, end_date::varchar AS end_date, end_date IS NULL AS is_current FROM result""",
)
def scd2(spark: SparkSession, sf: str) -> DataFrame:
    dim, batch = _dimension(spark, sf)
    return scd2_apply(dim, batch, ["o_custkey"], TRACKED, SECOND_DAY)


@query(
    "inc_06_scd2_statistics",
    f"""WITH {SCD2_SQL}, b AS (SELECT count(*) AS n FROM at_first)
        SELECT any_value(b.n) AS "before", count(*) AS "after", count(*) FILTER (WHERE end_date IS NULL) AS current_records,
               count(end_date) AS historical_records, count(*) - any_value(b.n) AS net_change, count(end_date) AS changed_keys,
               (SELECT count(*) FROM at_second WHERE o_custkey NOT IN (SELECT o_custkey FROM at_first)) AS new_entities
        FROM result, b""",
)
def scd2_counts(spark: SparkSession, sf: str) -> DataFrame:
    dim, batch = _dimension(spark, sf)
    return scd2_statistics(scd2_plan(dim, batch, ["o_custkey"], TRACKED, SECOND_DAY))


@query(
    "inc_06_scd2_reapplied",
    f"WITH {SCD2_SQL} SELECT o_custkey, effective_date::varchar AS effective_date, end_date::varchar AS end_date FROM result",
)
def scd2_again(spark: SparkSession, sf: str) -> DataFrame:
    """The same batch a month later changes nothing."""
    dim, batch = _dimension(spark, sf)
    once = scd2_apply(dim, batch, ["o_custkey"], TRACKED, SECOND_DAY)
    later = prepare_versions(at_second(spark, sf), ["o_custkey"], THIRD_DAY)
    return scd2_apply(once, later, ["o_custkey"], TRACKED, THIRD_DAY).select("o_custkey", "effective_date", "end_date")


@query(
    "inc_06_scd2_late_batches",
    f"""WITH {HISTORY} SELECT o_custkey, o_orderpriority, o_orderstatus, effective_date::varchar AS effective_date,
          end_date::varchar AS end_date, is_current FROM history""",
)
def late_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Finished orders arrive last and the oldest of the others second, so most batches change the past."""
    orders = table(spark, sf, "orders")
    finished, old = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False)), F.col("o_orderdate") < moment(date(1999, 1, 1), "timestamp_ntz")
    batches = [orders.filter(~finished & ~old), orders.filter(~finished & old), orders.filter(finished)]
    log = (["o_custkey"], TRACKED, "o_orderdate", ["o_orderkey"])
    path = scratch_path(spark, "late-0")
    scd2_open(batches[0], *log).write.parquet(path)
    for n, batch in enumerate(batches[1:], 1):
        after = scratch_path(spark, f"late-{n}")
        scd2_repair(read_table(spark, path), batch, *log).write.parquet(after)
        path = after
    return read_table(spark, path).drop(SEEN)


@query(
    "inc_07_prepared_batch",
    """SELECT sha256(concat_ws('|', c_custkey::varchar, '2001-09-01')) AS customer_sk, c_custkey, c_name, c_mktsegment,
              '2001-09-01' AS effective_date, NULL::varchar AS end_date, true AS is_current FROM customer""",
)
def prepared_batch(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return prepare_versions(customers, ["c_custkey"], SECOND_DAY, "customer_sk")


@query(
    "inc_08_history_from_log",
    f"""WITH {HISTORY} SELECT o_custkey, o_orderpriority, o_orderstatus, effective_date::varchar AS effective_date,
          end_date::varchar AS end_date, is_current FROM history""",
)
def history_from_log(spark: SparkSession, sf: str) -> DataFrame:
    return customer_history(spark, sf)


@query(
    "inc_09_invariants",
    f"""WITH {HISTORY}, k AS (SELECT o_custkey, count(*) FILTER (WHERE is_current) AS open FROM history GROUP BY 1)
        SELECT (SELECT count(*) FROM k WHERE open > 1) AS keys_with_two_current,
               count(*) FILTER (WHERE is_current AND end_date IS NOT NULL) AS current_with_end,
               count(*) FILTER (WHERE NOT is_current AND end_date IS NULL) AS history_without_end,
               count(*) FILTER (WHERE end_date < effective_date) AS end_before_start FROM history""",
)
def invariants(spark: SparkSession, sf: str) -> DataFrame:
    return scd2_invariants(customer_history(spark, sf), ["o_custkey"])


@query(
    "inc_10_first_run",
    """SELECT run, count(*) AS n_rows FROM (
         SELECT 1 AS run, p_partkey FROM part UNION ALL SELECT 2, p_partkey FROM part WHERE p_retailprice > 950) GROUP BY run""",
)
def first_run(spark: SparkSession, sf: str) -> DataFrame:
    """The first load fills an absent table; the next one adds to it."""
    path = scratch_path(spark, "first-run")
    parts = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    for run in (1, 2):
        rows = parts if not table_exists(spark, path) else parts.filter("p_retailprice > 950")
        append_table(rows.withColumn("run", F.lit(run)), path)
    return read_table(spark, path).groupBy("run").agg(F.count(F.lit(1)).alias("n_rows"))
