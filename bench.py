"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.catalogue import CATALOGUE, inputs  # noqa: E402
from millrace.session import local_session, scratch_path  # noqa: E402

HEADLINE = [
    "run_all_checks",
    "violation_rows",
    "nyc_taxi_daily_kpi",
    "openaq_location_kpi",
    "merge_insert_only",
    "lateral_flatten",
    "check_unique_violations",
    "fare_distribution",
    "dq_trend_7d",
    "stream_bronze",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = local_session(cpus, app="bench")
    seconds: dict[str, float] = {}
    if not sys.argv[1:]:  # the trip table that the trip queries read, derived once
        tries = []
        for _ in range(repeats):
            start = time.perf_counter()
            inputs.trip_bridge(spark, sf_dir).write.parquet(scratch_path(spark, "bench"))
            tries.append(time.perf_counter() - start)
        seconds["derive_trip_table"] = round(min(tries), 3)
    for name in sys.argv[1:] or HEADLINE:
        best = None
        for _ in range(repeats):  # the first run also warms up the JVM
            start = time.perf_counter()
            CATALOGUE[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
