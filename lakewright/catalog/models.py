"""End-to-end models."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.catalog import standins as s
from lakewright.catalog.base import query, table
from lakewright.catalog.sources import FEATURES, NAMES
from lakewright.functions.dates import moment
from lakewright.plans import engagement, labour, rentals
from lakewright.session import scratch_path
from lakewright.sinks.tables import overwrite_table, register_table, write_verified
from lakewright.sources.files import read_raw_csv, read_table
from lakewright.sources.seeds import full_moons
from lakewright.streaming.features import user_features


@query(
    "mod_01_raw_ingest",
    f"""WITH {s.PROVINCE_ARRIVAL}
        SELECT ref_date_raw AS REF_DATE, geo AS GEO, labour_force_characteristic AS Labour_force_characteristics, gender AS Gender, age_group AS Age_group,
               statistic_type AS Statistics, amount::varchar AS VALUE, status AS STATUS, TIMESTAMP '2002-01-01 10:00:00' AS _ingested_at,
               'province.csv' AS _source_file, '2002' AS ingestion_year, '01' AS ingestion_month FROM province_arrival""",
)
def raw_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """CSV file -> raw table partitioned by load period, read back."""
    arrived, stored = scratch_path(spark, "province-csv"), scratch_path(spark, "province-raw")
    s.province_arrival(spark, sf).write.option("header", True).option("nullValue", "").csv(arrived)
    raw = labour.raw_layer(read_raw_csv(spark, arrived), labour.PROVINCE_DROPS, "province.csv", s.FIRST_LOAD)
    write_verified(raw, stored, ["ingestion_year", "ingestion_month"], rebalance=False)
    return read_table(spark, stored, raw.schema).select(
        "REF_DATE", "GEO", "Labour_force_characteristics", "Gender", "Age_group", "Statistics", "VALUE", "STATUS",
        "_ingested_at", "_source_file", "ingestion_year", "ingestion_month",
    )


PROVINCE_COLUMNS = """ref_date::varchar AS ref_date, geo, dguid, labour_force_characteristic, gender, age_group, statistic_type, data_type, unit_of_measure,
 scalar_factor, vector_id, coordinate, decimals, status, _ingested_at, _source_file, is_suppressed, value, ref_year, ref_month"""


@query("mod_02_clean_layer", f"WITH {s.PROVINCE_CLEAN} SELECT {PROVINCE_COLUMNS} FROM province")
def clean(spark: SparkSession, sf: str) -> DataFrame:
    """Raw loads -> clean table, partitioned, registered and read through the catalog."""
    path = scratch_path(spark, "province-clean")
    province = s.province_clean(spark, sf)
    write_verified(province, path, ["ref_year", "ref_month"])
    return register_table(spark, "clean_province", path, province.schema, ["ref_year", "ref_month"], replace=True)


@query(
    "mod_02_clean_industry",
    f"WITH {s.PRICED},{s.INDUSTRY_CLEAN} SELECT ref_date::varchar AS ref_date, geo, naics_industry, statistic_type, data_type, is_suppressed, value FROM industry",
)
def clean_industry(spark: SparkSession, sf: str) -> DataFrame:
    return s.industry_clean(spark, sf).select("ref_date", "geo", "naics_industry", "statistic_type", "data_type", "is_suppressed", "value")


GEO_REGION = """CASE WHEN geo IN ('British Columbia', 'Alberta', 'Saskatchewan', 'Manitoba') THEN 'Western Canada'
  WHEN geo IN ('Ontario', 'Quebec') THEN 'Central Canada'
  WHEN geo IN ('New Brunswick', 'Nova Scotia', 'Prince Edward Island', 'Newfoundland and Labrador') THEN 'Atlantic Canada'
  WHEN geo = 'Canada' THEN 'National' ELSE 'Other' END AS geo_region"""
GEO_DIM = f"""geos AS (
  SELECT DISTINCT md5(concat_ws('-', dguid, geo)) AS geo_key, geo AS geo_name, dguid,
         CASE WHEN geo = 'Canada' THEN 'National' ELSE 'Province' END AS geo_level, {GEO_REGION}
  FROM province WHERE {s.HEADLINE}
)"""
FACT = f"""fact AS (
  SELECT md5(concat_ws('-', p.ref_date::varchar, p.geo, p.labour_force_characteristic, p.gender, p.age_group)) AS fact_key,
         p.ref_date, p.ref_year, p.ref_month, p.geo, p.labour_force_characteristic, p.gender, p.age_group, p.value AS value_thousands,
         round((p.value * 1000)::decimal(38,10), 0)::double AS value_actual, p.data_type, p.statistic_type, p.unit_of_measure,
         p.scalar_factor, i.value AS industry_total_thousands, p._ingested_at, p._source_file
  FROM province p LEFT JOIN industry i ON i.ref_date = p.ref_date AND i.geo = p.geo
   AND i.naics_industry = '{labour.ALL_INDUSTRIES}' AND i.geo <> 'Canada'
  WHERE p.data_type = 'Seasonally adjusted' AND p.statistic_type = 'Estimate' AND NOT p.is_suppressed AND p.age_group = '15 years and over'
)"""


@query("mod_03_geo_dimension", f"WITH {s.PROVINCE_CLEAN},{GEO_DIM} SELECT * FROM geos")
def geo_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return labour.geo_dimension(labour.headline(s.province_clean(spark, sf)))


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    province = labour.headline(s.province_clean(spark, sf))
    return labour.monthly_fact(province, labour.headline(s.industry_clean(spark, sf)))


@query(
    "mod_04_monthly_fact",
    f"WITH {s.PROVINCE_CLEAN},{s.INDUSTRY_CLEAN},{FACT} SELECT * REPLACE (ref_date::varchar AS ref_date) FROM fact",
)
def monthly_fact(spark: SparkSession, sf: str) -> DataFrame:
    return monthly(spark, sf)


SERIES_HISTORY = f"""changes AS (
  SELECT * FROM province WHERE {s.HEADLINE}
  WINDOW w AS (PARTITION BY geo, labour_force_characteristic, gender, age_group ORDER BY ref_date)
  QUALIFY lag(ref_date) OVER w IS NULL OR lag(value) OVER w IS DISTINCT FROM value OR lag(status) OVER w IS DISTINCT FROM status
),
history AS (
  SELECT geo, labour_force_characteristic, gender, age_group, value, status, data_type, ref_date AS effective_date,
         lead(ref_date) OVER w - 1 AS end_date, lead(ref_date) OVER w IS NULL AS is_current,
         sha256(concat_ws('|', geo, labour_force_characteristic, gender, age_group, ref_date::varchar)) AS dim_employment_sk
  FROM changes WINDOW w AS (PARTITION BY geo, labour_force_characteristic, gender, age_group ORDER BY ref_date)
)"""


def _change(n: int, name: str) -> str:
    back = f"lag(value_thousands, {n}) OVER w"
    return f"""value_thousands - {back} AS {name}_raw,
      round(((value_thousands - {back}) * 100.0 / nullif({back}, 0))::decimal(38,10), 2)::double AS {name}_change_pct"""


MART_SQL = f"""WITH {s.PROVINCE_CLEAN},{s.INDUSTRY_CLEAN},{GEO_DIM},{FACT},{SERIES_HISTORY},
trends AS (
  SELECT *, {_change(1, 'mom')}, {_change(12, 'yoy')},
         (sum(value_thousands::decimal(18,2)) OVER r)::double / count(value_thousands) OVER r AS rolling_3m_avg_thousands
  FROM fact WHERE gender = 'Total - Gender'
  WINDOW w AS (PARTITION BY geo, labour_force_characteristic, gender, age_group ORDER BY ref_date),
         r AS (PARTITION BY geo, labour_force_characteristic, gender, age_group ORDER BY ref_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
)
SELECT t.fact_key, t.ref_date::varchar AS ref_date, t.geo, t.labour_force_characteristic, t.value_thousands, t.value_actual, t.industry_total_thousands,
       round(t.mom_raw::decimal(38,10), 4)::double AS mom_change_thousands, t.mom_change_pct, round(t.yoy_raw::decimal(38,10), 4)::double AS yoy_change_thousands, t.yoy_change_pct,
       round(t.rolling_3m_avg_thousands::decimal(38,10), 4)::double AS rolling_3m_avg_thousands,
       h.dim_employment_sk, g.geo_key, g.geo_level, g.geo_region
FROM trends t LEFT JOIN history h ON h.geo = t.geo AND h.labour_force_characteristic = t.labour_force_characteristic
  AND h.gender = t.gender AND h.age_group = t.age_group AND t.ref_date >= h.effective_date AND (h.is_current OR t.ref_date <= h.end_date)
LEFT JOIN geos g ON g.geo_name = t.geo"""
MART_COLUMNS = [
    "fact_key", "ref_date", "geo", "labour_force_characteristic", "value_thousands", "value_actual", "industry_total_thousands",
    "mom_change_thousands", "mom_change_pct", "yoy_change_thousands", "yoy_change_pct", "rolling_3m_avg_thousands",
    "dim_employment_sk", "geo_key", "geo_level", "geo_region",
]


@query("mod_05_trend_mart", MART_SQL)
def trend_mart(spark: SparkSession, sf: str) -> DataFrame:
    """The clean tables are written once; fact, history and geography read them back."""
    province_path, industry_path, mart_path = (scratch_path(spark, f"mart-{n}") for n in ("province", "industry", "out"))
    overwrite_table(s.province_clean(spark, sf), province_path)
    overwrite_table(s.industry_clean(spark, sf), industry_path)
    province, industry = read_table(spark, province_path), read_table(spark, industry_path)
    rows = labour.headline(province)
    mart = labour.trend_mart(
        labour.monthly_fact(rows, labour.headline(industry)),
        labour.dimension_history(province),
        labour.geo_dimension(rows),
        digits=4,
    )
    overwrite_table(mart, mart_path, ["ref_year"])
    return register_table(spark, "employment_trends", mart_path, mart.schema, ["ref_year"], replace=True).select(*MART_COLUMNS)


@query("mod_05_trend_mart_in_one_plan", MART_SQL)
def trend_mart_one_plan(spark: SparkSession, sf: str) -> DataFrame:
    """The same mart without intermediate tables."""
    province = s.province_clean(spark, sf)
    rows = labour.headline(province)
    fact = labour.monthly_fact(rows, labour.headline(s.industry_clean(spark, sf)))
    mart = labour.trend_mart(fact, labour.dimension_history(province), labour.geo_dimension(rows), digits=4)
    return mart.select(*MART_COLUMNS)


DIMENSION_SQL = f"""WITH {s.PROVINCE_CLEAN},
h AS (SELECT * FROM province WHERE {s.HEADLINE}),
n1 AS (SELECT * FROM h WHERE ref_date < DATE '1999-01-01' QUALIFY row_number() OVER (PARTITION BY geo, labour_force_characteristic, gender, age_group ORDER BY ref_date DESC) = 1),
n2 AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY geo, labour_force_characteristic, gender, age_group ORDER BY ref_date DESC) = 1),
j AS (SELECT n1.*, n2.geo IS NOT NULL AND (n2.value IS DISTINCT FROM n1.value OR n2.status IS DISTINCT FROM n1.status) AS changed
      FROM n1 LEFT JOIN n2 USING (geo, labour_force_characteristic, gender, age_group)),
r AS (
  SELECT geo, labour_force_characteristic, gender, age_group, value, status, ref_date, DATE '1999-01-01' AS effective_date,
         CASE WHEN changed THEN DATE '2001-08-31' END AS end_date FROM j
  UNION ALL
  SELECT n2.geo, n2.labour_force_characteristic, n2.gender, n2.age_group, n2.value, n2.status, n2.ref_date, DATE '2001-09-01', NULL
  FROM n2 LEFT JOIN n1 USING (geo, labour_force_characteristic, gender, age_group)
  WHERE n1.ref_date IS NULL OR n2.value IS DISTINCT FROM n1.value OR n2.status IS DISTINCT FROM n1.status
)
SELECT sha256(concat_ws('|', geo, labour_force_characteristic, gender, age_group, effective_date::varchar)) AS dim_employment_sk,
       geo, labour_force_characteristic, gender, age_group, value, status, ref_date::varchar AS ref_date,
       effective_date::varchar AS effective_date, end_date::varchar AS end_date, end_date IS NULL AS is_current FROM r"""


@query("mod_06_scd2_dimension", DIMENSION_SQL)
def scd2_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """First run from the months before 1999, then the newest months as a second batch."""
    clean_path, dim_path = scratch_path(spark, "scd2-clean"), scratch_path(spark, "scd2-dim")
    overwrite_table(s.province_clean(spark, sf), clean_path)
    province = read_table(spark, clean_path)
    early = province.filter(F.col("ref_date") < F.lit(date(1999, 1, 1)))
    first = labour.dimension_batch(early, date(1999, 1, 1))
    overwrite_table(first, dim_path, ["is_current"])
    dim = read_table(spark, dim_path, first.schema)
    updated = labour.update_dimension(dim, labour.dimension_batch(province, date(2001, 9, 1)), date(2001, 9, 1))
    return updated.select(
        "dim_employment_sk", *labour.DIMENSION_KEY, "value", "status", "ref_date", "effective_date", "end_date", "is_current"
    )


@query(
    "mod_07_clean_events",
    f"""WITH {s.ENGAGEMENT_ONCE} SELECT event_id, event_type, user_id, content_id, content_type, device_type, event_ts, {s.EVENT_FLAGS}
        FROM engagement_once WHERE {s.GOOD_EVENT}""",
)
def clean_events(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries of the raw events merged by id."""
    raw = s.engagement_events(spark, sf)
    early = engagement.clean_table(None, raw.filter(F.col("event_ts") < "2024-01-15"))
    return engagement.clean_table(early, raw).select(
        "event_id", "event_type", "user_id", "content_id", "content_type", "device_type", "event_ts",
        "event_hour", "is_mobile", "is_viral_content_type",
    )


@query(
    "mod_08_user_features",
    f"""WITH {FEATURES.format(width='5 minutes')} SELECT user_id, window_start, window_end, total_likes, total_shares, total_comments,
          total_impressions, engagement_score, content_virality FROM scored""",
)
def features(spark: SparkSession, sf: str) -> DataFrame:
    """Features as of the newest event, from a stored table and a look-back refresh."""
    path = scratch_path(spark, "features")
    events = table(spark, sf, "events")
    as_of: datetime = events.agg(F.max("ts").alias("t")).first()["t"]
    overwrite_table(user_features(events.filter(F.col("ts") < moment(as_of, "timestamp_ntz")), "ts", names=NAMES), path)
    return engagement.refresh_features(read_table(spark, path), events, as_of, at="ts", names=NAMES)


@query("mod_09_listings_with_hosts", f"WITH {s.WITH_HOSTS} SELECT * REPLACE (price::double AS price) FROM joined")
def listings_with_hosts(spark: SparkSession, sf: str) -> DataFrame:
    return rentals.listings_with_hosts(
        rentals.listings_cleansed(s.raw_listings(spark, sf)), rentals.hosts_cleansed(s.raw_hosts(spark, sf))
    )


@query("mod_09_hosts_cleansed", f"WITH {s.HOSTS} SELECT * FROM hosts")
def hosts(spark: SparkSession, sf: str) -> DataFrame:
    return rentals.hosts_cleansed(s.raw_hosts(spark, sf))


@query("mod_09_listings_cleansed", f"WITH {s.LISTINGS} SELECT * REPLACE (price::double AS price) FROM listings")
def listings(spark: SparkSession, sf: str) -> DataFrame:
    return rentals.listings_cleansed(s.raw_listings(spark, sf))


@query(
    "mod_10_sentiment_by_moon",
    f"""WITH {s.REVIEWS},{s.MOONS}
        SELECT CASE WHEN full_moon_date IS NULL THEN 'not full moon' ELSE 'full moon' END AS is_full_moon, review_sentiment, count(*) AS reviews
        FROM reviews LEFT JOIN moons ON review_date::date = full_moon_date + 1 GROUP BY 1, 2 ORDER BY 1, 2""",
)
def sentiment_by_moon(spark: SparkSession, sf: str) -> DataFrame:
    """Incremental review fact -> full-moon mart -> counts."""
    path = scratch_path(spark, "reviews")
    raw = s.raw_reviews(spark, sf)
    first = raw.filter(F.col("date") < F.lit("2000-01-01").cast("timestamp_ntz"))
    overwrite_table(rentals.review_fact(first), path)
    reviews = rentals.review_fact(raw, read_table(spark, path))
    span = raw.agg(F.date_sub(F.to_date(F.min("date")), 1).alias("a"), F.to_date(F.max("date")).alias("b")).first()
    return rentals.sentiment_by_moon(rentals.full_moon_reviews(reviews, full_moons(spark, span["a"], span["b"])))


@query(
    "mod_11_long_stays",
    f"WITH {s.LISTINGS} SELECT listing_id, listing_name, price::double AS price FROM listings WHERE minimum_nights >= 30",
)
def long_stays(spark: SparkSession, sf: str) -> DataFrame:
    return rentals.long_stays(rentals.listings_cleansed(s.raw_listings(spark, sf)))
