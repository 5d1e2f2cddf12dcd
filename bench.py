"""Time headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and
cores. Build steps run once, queries are the median of three runs after a first one;
``first_runs`` gives those first ones. Results go to a sink that keeps nothing.
"""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from setlog.catalog import QUERIES
from setlog.sources import workspace

BUILDS = {
    "build_bronze": workspace.bronze,
    "build_star": workspace.star,
    "build_cells": workspace.cells,
    "build_sheet_bronze": workspace.sheet_bronze,
    "build_sheet_star": workspace.sheet_star,
}
HEADLINE = [
    "kpis", "filtered_kpis", "weekly_volume", "weekly_volume_all", "group_distribution",
    "exercise_progress", "best_set_by_session", "personal_records", "weekly_volume_by_group",
    "mesocycle_volume", "intensity_by_session", "rir_by_microcycle", "daily_frequency",
    "group_volume", "group_sets_over_time", "longest_streak", "days_per_month_full",
    "best_worst_month", "calendar_heatmap", "group_share_others", "load_trend", "rir_quartiles",
    "fact_stats", "quality_report", "top_exercises", "load_totals", "grid_days", "grid_micros",
    "athlete_weekly_volume", "athlete_records",
]
RUNS = 3


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("setlog-bench")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds, first_runs = {}, {}

    def timed(action) -> float:
        start = time.perf_counter()
        action()
        return time.perf_counter() - start

    for name, build in BUILDS.items():
        seconds[name] = round(timed(lambda: build(spark, folder)), 3)
    for name in HEADLINE:
        query = QUERIES[name]
        first_runs[name] = round(timed(lambda: run(query(spark, folder))), 3)
        seconds[name] = round(statistics.median(
            timed(lambda: run(query(spark, folder))) for _ in range(RUNS)), 3)
    print(json.dumps({
        "metric": "build steps plus median query times", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "first_runs": first_runs,
        "sf": folder.rsplit("sf", 1)[-1], "cores": int(cores),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
