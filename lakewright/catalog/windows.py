"""Window operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.catalog import standins as s
from lakewright.catalog.base import query, table
from lakewright.catalog.sources import FEATURES, NAMES
from lakewright.functions.keys import compact
from lakewright.operators.ranks import average_rank
from lakewright.operators.windows import keep_latest, trend_metrics
from lakewright.session import scratch_path
from lakewright.sinks.tables import overwrite_table
from lakewright.sources.files import read_table
from lakewright.streaming.features import user_features

SERIES_SQL = f"""WITH {s.PRICED},
monthly AS (
  SELECT date_trunc('month', o_orderdate)::date AS ref_date, geo, o_orderpriority, sum(price)::double AS total
  FROM priced GROUP BY ALL
)"""


def monthly_series(spark: SparkSession, sf: str) -> DataFrame:
    return (
        s.priced_orders(spark, sf)
        .groupBy(F.trunc("o_orderdate", "month").alias("ref_date"), "geo", "o_orderpriority")
        .agg(F.sum("price").cast("double").alias("total"))
    )


def _trends(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    return trend_metrics(
        monthly_series(spark, sf),
        ["geo", "o_orderpriority"],
        "ref_date",
        "total",
        {"mom": 1, "yoy": 12},
        mode=mode,
        change_digits=2,
        rolling_digits=None,
    )


def _row_change(n: int, name: str) -> str:
    back = f"lag(total, {n}) OVER w"
    return f"""round((total - {back})::decimal(38,10), 2)::double AS {name}_change,
       round(((total - {back}) * 100.0 / nullif({back}, 0))::decimal(38,10), 2)::double AS {name}_change_pct"""


@query(
    "win_01_keep_latest",
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM lineitem
       QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1""",
)
def latest_line(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    items = table(spark, sf, "lineitem").select(*columns)
    return keep_latest(items, columns[:2], "l_shipdate", columns[3:])


@query(
    "win_01_one_per_text",
    """SELECT doc_id, text, lang FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY n_chars DESC, doc_id DESC) = 1""",
)
def one_per_text(spark: SparkSession, sf: str) -> DataFrame:
    """Long texts are told apart by their hash, so the key is short."""
    documents = table(spark, sf, "documents").withColumn("_text_key", compact(F.col("text")))
    return keep_latest(documents, ["_text_key"], "n_chars", ["doc_id"]).select("doc_id", "text", "lang")


@query(
    "win_02_latest_snapshot",
    """SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return keep_latest(table(spark, sf, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"])


KEY = "ref_date::varchar AS ref_date, geo, o_orderpriority, total"
ROWS_WINDOW = "WINDOW w AS (PARTITION BY geo, o_orderpriority ORDER BY ref_date)"
KEYS = ["ref_date", "geo", "o_orderpriority", "total"]


@query("win_03_period_change", f"{SERIES_SQL} SELECT {KEY}, {_row_change(1, 'mom')} FROM monthly {ROWS_WINDOW}")
def period_change(spark: SparkSession, sf: str) -> DataFrame:
    return _trends(spark, sf, "rows").select(*KEYS, "mom_change", "mom_change_pct")


@query("win_04_year_change", f"{SERIES_SQL} SELECT {KEY}, {_row_change(12, 'yoy')} FROM monthly {ROWS_WINDOW}")
def year_change(spark: SparkSession, sf: str) -> DataFrame:
    return _trends(spark, sf, "rows").select(*KEYS, "yoy_change", "yoy_change_pct")


@query(
    "win_04_year_change_calendar",
    f"""{SERIES_SQL}
        SELECT m.ref_date::varchar AS ref_date, m.geo, m.o_orderpriority, m.total,
               round((m.total - p.total)::decimal(38,10), 2)::double AS yoy_change,
               round(((m.total - p.total) * 100.0 / nullif(p.total, 0))::decimal(38,10), 2)::double AS yoy_change_pct
        FROM monthly m LEFT JOIN monthly p ON p.geo = m.geo AND p.o_orderpriority = m.o_orderpriority
          AND p.ref_date = (m.ref_date - INTERVAL 12 MONTH)::date""",
)
def year_change_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return _trends(spark, sf, "calendar").select(*KEYS, "yoy_change", "yoy_change_pct")


@query(
    "win_05_rolling_mean",
    f"""{SERIES_SQL} SELECT {KEY}, (sum(total::decimal(18,2)) OVER r)::double / count(total) OVER r AS rolling_3_avg FROM monthly
        WINDOW r AS (PARTITION BY geo, o_orderpriority ORDER BY ref_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def rolling_mean(spark: SparkSession, sf: str) -> DataFrame:
    return _trends(spark, sf, "rows").select(*KEYS, "rolling_3_avg")


@query(
    "win_06_average_rank",
    f"""WITH {FEATURES.format(width='1 day')}
        SELECT user_id, window_start, engagement_score,
               rank() OVER (ORDER BY engagement_score DESC) + (count(*) OVER (PARTITION BY engagement_score) - 1) / 2 AS score_rank
        FROM scored""",
)
def score_rank(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "scores")
    features = user_features(table(spark, sf, "events"), "ts", width="1 day", names=NAMES)
    overwrite_table(features.select("user_id", "window_start", F.col("engagement_score").cast("double").alias("engagement_score")), path)
    return average_rank(read_table(spark, path), "engagement_score", "score_rank")


@query(
    "win_06_quantity_rank",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity,
              rank() OVER (ORDER BY l_quantity DESC) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2 AS quantity_rank FROM lineitem""",
)
def quantity_rank(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return average_rank(items, "l_quantity", "quantity_rank")
