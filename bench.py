"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the
runs of each query (the median counts, so of three the cold first one does not)
and ``BENCH_ALL=1`` takes every registered query. Each run computes all rows and columns of the result.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from lakewright.catalog import ENTRIES  # noqa: E402
from lakewright.session import build_session  # noqa: E402

HEADLINE = [
    "src_02_typed_csv",
    "snk_01_partitioned_overwrite",
    "snk_06_stream_upsert",
    "prj_07_struct_flatten",
    "jon_03_point_in_time",
    "jon_03_point_in_time_salted",
    "jon_03_point_in_time_monthly",
    "jon_09_shifted_date",
    "agg_03_conditional_counts",
    "agg_12_exact_quantile",
    "agg_13_table_profile",
    "win_01_keep_latest",
    "win_01_one_per_text",
    "win_04_year_change_calendar",
    "win_06_quantity_rank",
    "set_03_table_difference",
    "inc_05_snapshot",
    "inc_06_scd2_apply",
    "inc_08_history_from_log",
    "str_02_watermarked_features",
    "str_06_user_features",
    "dq_00_whole_suite",
    "mod_01_raw_ingest",
    "mod_02_clean_layer",
    "mod_04_monthly_fact",
    "mod_05_trend_mart",
    "mod_06_scd2_dimension",
    "mod_07_clean_events",
    "mod_08_user_features",
    "mod_09_listings_with_hosts",
    "mod_10_sentiment_by_moon",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = list(ENTRIES) if os.environ.get("BENCH_ALL") else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(max(runs, 1)):
            started = time.perf_counter()
            ENTRIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken), 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
