"""Benchmark: time every registered query on one scale factor.

Runs each ``queries()`` entry on ``$BENCH_SF_DIR`` (default sf0.1) with
``local[$BENCH_CPUS]`` and forces the whole plan with the ``noop`` sink (no
rows are collected).  Prints one JSON line:

    {"metric": "total_query_seconds", "value": N, "unit": "sec",
     "queries": {"name": sec, ...}, "sf": ..., ...}

Set ``BENCH_QUERIES=a,b`` to time a subset, ``BENCH_REPEAT`` for best-of-N.
"""

from __future__ import annotations

import importlib
import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="snapvault-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("snapvault-bench")
        .config("spark.sql.shuffle.partitions", str(int(cpus) * 2))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
        .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoint"))
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    entry = importlib.import_module("__spark_entry__")
    all_queries = entry.queries()
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(all_queries)

    # warm-up: JVM, class loading and file listing, not counted
    spark.read.parquet(os.path.join(sf_dir, "orders.parquet")).write.format("noop").mode("overwrite").save()

    timings, failures = {}, {}
    for name in wanted:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            try:
                df = all_queries[name](spark, sf_dir)
                df.write.format("noop").mode("overwrite").save()
            except Exception as exc:  # report, keep timing the rest
                failures[name] = str(exc).splitlines()[0][:200]
                break
            elapsed = time.perf_counter() - t0
            best = elapsed if best is None else min(best, elapsed)
        if best is not None:
            timings[name] = round(best, 3)

    sf_match = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "failed": failures,
        "sf": float(sf_match.group(1)) if sf_match else sf_dir,
        "master": f"local[{cpus}]",
        "spark": spark.version,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
