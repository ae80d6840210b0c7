"""Benchmark of the headline queries.

Runs each ★ query of the catalogue at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]:
one untimed warm-up pass over all queries, then the median of $BENCH_RUNS (default 3) timed runs per query. Each run executes the whole plan
and discards the rows (noop sink), so nothing is collected. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = (
    "station_catalog",
    "hourly_deltas",
    "station_balance",
    "running_balance",
    "shipment_daily_flow",
    "shipment_balance",
    "table_balances_as_of",  # reads the stored tables, which the warm-up pass loads
)


def main() -> None:
    from pyspark.sql import SparkSession

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or list(HEADLINE)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ebbflow-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):  # one machine: where the stored tables go
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ebbflow-bench-"))
    from ebbflow.plans import QUERIES

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    for name in names:  # warm-up pass over every query (JIT, file listing caches)
        run(name)
    timings = {}
    for name in names:
        fn = QUERIES[name]
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 4)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_median",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "runs": runs,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
