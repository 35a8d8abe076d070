"""Benchmark the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full through Spark's ``noop`` sink (every row is
produced, nothing is collected to the driver), DataFrame construction included.
A warm-up run of a small query absorbs JVM start-up. Every query then runs
``BENCH_REPEAT`` times (default 2): ``queries`` holds the best run (steady state,
code already generated and compiled), ``cold`` the first run of each query.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from refillscope.plans.catalog import QUERIES  # noqa: E402
from refillscope.session import build_session  # noqa: E402

HEADLINE = (
    "delivery_intervals",
    "normalised_days",
    "delivery_measures",
    "delivery_summary",
    "adherence_consolidated",
    "adherence_export",
    "demographics_one_row",
    "therapy_days_total",
    "last_therapy_days",
    "event_intervals",
)


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    names = sys.argv[1:] or list(HEADLINE)
    spark = build_session()
    run(spark, "delivery_count", sf_dir)  # warm-up: JVM, parquet footers, codegen caches
    timings, cold = {}, {}
    for name in names:
        runs = [run(spark, name, sf_dir) for _ in range(repeat)]
        cold[name] = round(runs[0], 3)
        timings[name] = round(min(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "cold": cold,
                "cold_total": round(sum(cold.values()), 3),
                "repeat": repeat,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": int(os.environ.get("BENCH_CPUS", "8")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
