"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default
all), BENCH_RUNS (default 3, the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from stormledger import catalog, session

HEADLINE = [
    "bi_time_series", "bi_area_ranking", "bi_seasonality", "bi_rain_correlation", "kpis",
    "general_stats", "all_aggregates", "agg_area_year", "agg_kind_month", "agg_weekday",
    "stats_area", "hotspots", "hour_weekday", "rollup_year_month", "mean_response",
    "clean_and_unify", "parse_dates", "normalize_area", "profile_columns", "profile_categorical",
    "outliers_iqr", "outliers_iqr_approx", "diagnosis", "join_daily_rain", "corr_rain_daily",
    "orphans", "dedup_latest", "dq_dup_ratio", "dq_scorecard", "gaps", "volume_check",
    "src_csv_semicolon", "src_union_by_name", "sink_parquet_partitioned", "html_blocks", "non_ascii",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        session.builder("bench").master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds(names[0])
    times = {n: round(statistics.median(seconds(n) for _ in range(runs)), 4) for n in names}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus, "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
