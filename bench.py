"""Headline-query benchmark.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

One warm-up round over all queries, then three timed rounds in shuffled orders, written to
the ``noop`` sink (the full plan runs, nothing is collected). Prints one JSON line with the median
seconds per query and their sum.
"""

from __future__ import annotations

import json
import os
import random
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "dq_report", "silver_enriched", "genre_stats", "dm_genre_trends", "dm_top_artists",
    "dm_hits", "rank_in_genre", "lag_prev", "page",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("strata-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="strata-bench-"))
             .config("spark.sql.shuffle.partitions", str(cpus))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from strata.registry import QUERIES

    from strata.session import scratch_scope

    # One round over all queries warms up; then whole rounds are timed, each in another
    # order, so no query always runs on a cold or a warm machine.
    samples = {name: [] for name in HEADLINE}
    for i in range(runs + 1):
        for name in random.Random(i).sample(HEADLINE, len(HEADLINE)):
            with scratch_scope(spark):
                t0 = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i:
                    samples[name].append(time.perf_counter() - t0)
    times = {name: round(statistics.median(s), 3) for name, s in samples.items()}
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
