"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores. Each query runs
``BENCH_RUNS`` times after one warm-up and is written to the no-op sink, so all
its columns and rows are computed; the median counts. Newer queries and the
model searches (with the grids of their queries) run once, without warm-up; they
are listed by themselves and are not in the total.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from fleetfeatures import catalogue
from fleetfeatures.session import build_session

HEADLINE = [
    "route_weather",
    "city_weather_both",
    "traffic_on_route",
    "merge_back",
    "vehicle_driver",
    "wide_trips",
    "cleaned_traffic",
    "cleaned_trucks",
    "fill_missing",
    "forward_fill",
    "iqr_outliers",
    "dedupe_first",
    "dup_rows",
    "slots_6h",
    "slots_1h",
    "row_index",
    "describe",
    "histogram20",
    "boxplot",
    "distinct_counts",
    "class_report",
    "one_hot",
    "standard_scale",
    "split_random",
    "upsert_latest",
    "csv_roundtrip",
]
#: Running totals in place of slots, key buckets in place of a rewritten table, and what else is new.
FURTHER = ["traffic_by_range", "weather_by_range", "upsert_buckets", "one_hot_wide", "csv_mixed_headers"]
MODELS = ["grid_lr", "grid_rf", "grid_gbt"]


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    catalogue.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    catalogue.load()
    chosen = os.environ.get("BENCH_QUERIES", "").split()
    seconds = {}
    for name in chosen or HEADLINE:
        seconds[name] = round(statistics.median([timed(spark, name, folder) for _ in range(runs + 1)][1:]), 4)
    further, models = ({name: round(timed(spark, name, folder), 4) for name in ([] if chosen else names)} for names in (FURTHER, MODELS))
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 4), "unit": "sec", "queries": seconds,
                      "further": further, "models": models, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
