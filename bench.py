"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the
local cores. Every query runs to a no-op sink, once to warm the JVM and then
BENCH_RUNS times (default 3); the fastest timed run counts.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from cabstream.plans.catalog import QUERIES
from cabstream.session import drop_work

HEADLINE = (
    "gps_valid", "gps_anonymized", "gps_json_parsed", "gps_thinned", "demand_windows", "trips_deduplicated",
    "trips_with_weather", "trajectory_length_duration", "curated_trips", "points_snapped",
    "zone_hour_month_demand", "kpi_table", "coverage_gap", "dataset_summary", "column_profile",
    "quality_report", "feature_matrix_row_lags", "feature_matrix_calendar_lags", "forecast_metrics",
    "asof_vehicle", "trip_matches", "match_rates", "final_match_status", "late_events_dropped",
    "activity_sessions", "event_vs_arrival_windows", "trajectories_snapped",
    "stream_demand_windows", "stream_gps_thinned", "stream_gps_normalized", "stream_trip_matches_rounds",
)


def run(query, spark: SparkSession, sf_dir: str) -> float:
    began = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("cabstream-bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else cpus)
        .config("spark.driver.memory", "16g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(QUERIES[name], spark, sf_dir)
        drop_work(spark)
        seconds[name] = round(min(run(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "sum of headline query times", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
