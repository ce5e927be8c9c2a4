"""Monthly labour survey: raw -> clean -> star schema -> trend mart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewright.functions.classify import SUPPRESSION_CODES, geo_level, geo_region, in_codes, unless
from lakewright.functions.dates import month_start_from_text, year_month_text
from lakewright.functions.keys import hash_key
from lakewright.functions.numbers import scaled, to_number
from lakewright.operators.filters import equals_all, not_flagged
from lakewright.operators.history import prepare_versions, scd2_apply, scd2_from_log
from lakewright.operators.joins import enrich, pit_join
from lakewright.operators.projections import (
    add_load_audit,
    add_period_columns,
    drop_present,
    rename_contract,
    sanitize_names,
)
from lakewright.operators.windows import keep_latest, trend_metrics

# Columns dropped on arrival.
PROVINCE_DROPS = ("UOM_ID", "SCALAR_ID", "SYMBOL", "TERMINATED")
INDUSTRY_DROPS = ("UOM", "UOM_ID", "SCALAR_ID", "SYMBOL", "TERMINATED")

# Source name after cleaning -> name in the clean layer.
PROVINCE_NAMES = {
    "REF_DATE": "ref_date_raw",
    "GEO": "geo",
    "DGUID": "dguid",
    "Labour_force_characteristics": "labour_force_characteristic",
    "Gender": "gender",
    "Age_group": "age_group",
    "Statistics": "statistic_type",
    "Data_type": "data_type",
    "UOM": "unit_of_measure",
    "SCALAR_FACTOR": "scalar_factor",
    "VECTOR": "vector_id",
    "COORDINATE": "coordinate",
    "VALUE": "value_raw",
    "STATUS": "status",
    "DECIMALS": "decimals",
    "_ingested_at": "_ingested_at",
    "_source_file": "_source_file",
}
INDUSTRY_NAMES = {
    "REF_DATE": "ref_date_raw",
    "GEO": "geo",
    "DGUID": "dguid",
    "North_American_Industry_Classification_System_NAICS": "naics_industry",
    "Statistics": "statistic_type",
    "Data_type": "data_type",
    "SCALAR_FACTOR": "scalar_factor",
    "VECTOR": "vector_id",
    "COORDINATE": "coordinate",
    "VALUE": "value_raw",
    "STATUS": "status",
    "DECIMALS": "decimals",
    "_ingested_at": "_ingested_at",
    "_source_file": "_source_file",
}

# Natural keys of the two clean tables.
PROVINCE_KEY = (
    "ref_date",
    "geo",
    "labour_force_characteristic",
    "gender",
    "age_group",
    "statistic_type",
    "data_type",
)
INDUSTRY_KEY = ("ref_date", "geo", "naics_industry", "statistic_type", "data_type")

# The headline selection.
ADJUSTED = "Seasonally adjusted"
ESTIMATE = "Estimate"
ALL_GENDERS = "Total - Gender"
ALL_AGES = "15 years and over"
ALL_INDUSTRIES = "Total employed, all industries"

# The dimension keeps the whole key of a series: geography and characteristic
# alone would tie across gender and age group.
DIMENSION_KEY = ("geo", "labour_force_characteristic", "gender", "age_group")
TRACKED = ("value", "status", "data_type")


def raw_layer(arrived: DataFrame, drops: Sequence[str], source: str, loaded_at: datetime | Column | None = None) -> DataFrame:
    """Arrived text columns with clean names, load audit and load-period columns."""
    trimmed = sanitize_names(drop_present(arrived, drops))
    return add_period_columns(add_load_audit(trimmed, source, loaded_at), "_ingested_at", "ingestion")


def clean_layer(
    raw: DataFrame,
    names: Mapping[str, str],
    key: Sequence[str],
    tie_breakers: Sequence[str] = ("value_raw", "status", "vector_id", "coordinate"),
) -> DataFrame:
    """Contract names, dates, suppressed values as flagged NULLs, newest load per key."""
    renamed = rename_contract(raw, names)
    dated = renamed.withColumn("ref_date", month_start_from_text(F.col("ref_date_raw")))
    latest = keep_latest(dated, key, "_ingested_at", tie_breakers)
    flagged = latest.withColumn("is_suppressed", in_codes(F.col("status"), SUPPRESSION_CODES))
    valued = flagged.withColumn("value", unless(F.col("is_suppressed"), to_number(F.col("value_raw"))))
    return drop_present(add_period_columns(valued, "ref_date", "ref"), ["ref_date_raw", "value_raw"])


def normalised_month(raw: DataFrame, column: str = "REF_DATE") -> DataFrame:
    """Month text for inputs whose month was turned into a timestamp."""
    return raw.withColumn(column, year_month_text(F.col(column)))


def headline(clean: DataFrame) -> DataFrame:
    """Adjusted estimates that are not suppressed."""
    return clean.filter(
        equals_all({"data_type": ADJUSTED, "statistic_type": ESTIMATE}) & not_flagged("is_suppressed")
    )


def geo_dimension(province: DataFrame) -> DataFrame:
    """One row per geography with key, level and region."""
    geos = province.select("geo", "dguid").distinct()
    return geos.select(
        hash_key(["dguid", "geo"], "md5", "-", plain=True).alias("geo_key"),
        F.col("geo").alias("geo_name"),
        "dguid",
        geo_level(F.col("geo")).alias("geo_level"),
        geo_region(F.col("geo")).alias("geo_region"),
    )


def monthly_fact(province: DataFrame, industry: DataFrame) -> DataFrame:
    """Monthly values of the whole age group with the province's all-industry total beside them."""
    totals = industry.filter((F.col("naics_industry") == ALL_INDUSTRIES) & (F.col("geo") != "Canada")).select(
        F.col("ref_date").alias("i_date"), F.col("geo").alias("i_geo"), F.col("value").alias("i_value")
    )
    values = province.filter(F.col("age_group") == ALL_AGES)
    joined = enrich(values, totals, {"ref_date": "i_date", "geo": "i_geo"}, {"i_value": "industry_total_thousands"})
    return joined.select(
        hash_key(["ref_date", "geo", "labour_force_characteristic", "gender", "age_group"], "md5", "-", plain=True).alias("fact_key"),
        "ref_date",
        "ref_year",
        "ref_month",
        "geo",
        "labour_force_characteristic",
        "gender",
        "age_group",
        F.col("value").alias("value_thousands"),
        scaled(F.col("value")).alias("value_actual"),
        "data_type",
        "statistic_type",
        "unit_of_measure",
        "scalar_factor",
        "industry_total_thousands",
        "_ingested_at",
        "_source_file",
    )


def latest_values(clean: DataFrame, key: Sequence[str] = DIMENSION_KEY) -> DataFrame:
    """Newest headline row of each series."""
    return keep_latest(headline(clean), key, "ref_date", ["vector_id", "coordinate"])


def dimension_batch(clean: DataFrame, as_of: date, key: Sequence[str] = DIMENSION_KEY) -> DataFrame:
    """The newest values as open versions of ``as_of``."""
    rows = latest_values(clean, key).select(*key, *TRACKED, "ref_date", "unit_of_measure", "scalar_factor")
    return prepare_versions(rows, key, as_of, "dim_employment_sk")


def update_dimension(dim: DataFrame, batch: DataFrame, as_of: date, key: Sequence[str] = DIMENSION_KEY) -> DataFrame:
    return scd2_apply(dim, batch, key, TRACKED, as_of)


def dimension_history(clean: DataFrame, key: Sequence[str] = DIMENSION_KEY) -> DataFrame:
    """Back-loaded history: one version per run of months with equal values."""
    history = scd2_from_log(headline(clean), key, TRACKED, "ref_date", ["vector_id", "coordinate"])
    return history.withColumn("dim_employment_sk", hash_key([*key, "effective_date"]))


def trend_mart(fact: DataFrame, dim: DataFrame, geos: DataFrame, mode: str = "rows", digits: int | None = 1) -> DataFrame:
    """Changes and rolling means of the all-gender series, with dimension keys and regions."""
    series = ["geo", "labour_force_characteristic", "gender", "age_group"]
    trends = trend_metrics(
        fact.filter(F.col("gender") == ALL_GENDERS),
        series,
        "ref_date",
        "value_thousands",
        {"mom": 1, "yoy": 12},
        mode=mode,
        change_digits=digits,
        rolling_digits=digits,
    ).withColumnsRenamed(
        {
            "mom_change": "mom_change_thousands",
            "yoy_change": "yoy_change_thousands",
            "rolling_3_avg": "rolling_3m_avg_thousands",
        }
    )
    keyed = pit_join(trends, dim, series, "ref_date", {"dim_employment_sk": "dim_employment_sk"})
    geo_columns = {c: c for c in ("geo_key", "geo_level", "geo_region")}
    return enrich(keyed, geos, {"geo": "geo_name"}, geo_columns)


def mart_checks(mart: DataFrame) -> DataFrame:
    """Verification counts of the mart in one pass over it and one over its keys."""
    first = mart.agg(F.min("ref_date").alias("m")).scalar()
    key = ["ref_date", "geo", "labour_force_characteristic", "gender", "age_group"]
    per_key = mart.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("mom_change_thousands").isNull()).alias("_no_mom"),
        F.count_if(F.col("yoy_change_thousands").isNotNull()).alias("_yoy"),
        F.count_if(F.col("geo_key").isNotNull()).alias("_geo"),
        F.count_if(F.col("dim_employment_sk").isNotNull()).alias("_dim"),
    )
    return per_key.agg(
        F.sum("_n").alias("total_rows"),
        F.sum(F.when(F.col("ref_date") > first, F.col("_no_mom")).otherwise(0)).alias("null_mom_after_first"),
        F.sum("_yoy").alias("rows_with_yoy"),
        F.sum("_geo").alias("rows_with_geo"),
        F.sum("_dim").alias("rows_with_dimension"),
        F.count_if(F.col("_n") > 1).alias("repeated_keys"),
    )
