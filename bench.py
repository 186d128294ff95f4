"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.  Each query is written
to the ``noop`` sink, so every row and column is produced and nothing is
collected; the figure is the median of three runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from checks.queries import REGISTRY
from tidewell.session import build_session

HEADLINE = [
    "cdc_snapshot", "cdc_incremental", "cdc_no_key", "cdc_duplicate_keys", "raw_change_log", "row_hashes",
    "scd1", "scd2", "merge_upsert", "dedup_key", "qc_subtract", "qc_mismatch_rows", "diff_rows_strings",
    "qc_durations", "daily_utilisation", "run_quartiles", "quartile_by_interval", "bucket_report",
    "cluster_idle_peak", "run_status", "alerts", "declared_keys", "column_stats", "ucc_discovery", "fd_discovery",
    "sink_clustered", "stream_scd2",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    timings: dict[str, float] = {}
    for name in names:
        seconds = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(seconds[1:]), 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
