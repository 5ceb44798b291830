"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  names separated by commas, or "all"
BENCH_RUNS     timed runs per query after one warm-up (default 3; the median counts)
BENCH_SHARED   folder for zones and checkpoints (default: a fresh temporary one)

A run is the whole query, written to a sink that discards the rows.
"""

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from skygauge.plans import QUERIES
from skygauge.plans.views import hazard_labels, obs, predictions

HEADLINE = [
    "csv_scan", "parse_json", "flatten_weather", "dataset_profile", "features", "api_index", "climatology_anomaly", "sequences_train",
    "thresholds_exact", "thresholds_approx", "hazard_labels", "label_rate_by_district", "district_year_stats", "store_stats", "daily_summary",
    "hourly_stats", "alerts", "score_rule", "merge_dedup", "upsert_latest", "slice_batches", "latest_per_district", "top_k_all_districts",
    "best_model", "binary_metrics", "roc_auc", "average_precision", "positional_split", "stream_hourly", "stream_alerts", "csv_dir_station", "stream_land",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("skygauge-bench")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.log.level", "ERROR")
        .config("spark.driver.host", "127.0.0.1").config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "6g").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="skygauge-bench-"))
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )

    def once(name):
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    started = time.perf_counter()
    for zone in (obs, hazard_labels, predictions):  # land the zones the queries start from
        zone(spark, folder)
    landing = time.perf_counter() - started
    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "seconds to land the zones plus the total of the median seconds per query", "value": round(landing + sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "zone_landing_sec": round(landing, 3), "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
