"""Bench: headline queries on $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].

Each query is run to completion through the ``noop`` sink (full execution, nothing collected):
one warm-up run, then the median of three timed runs. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from asofspark.queries import QUERIES  # noqa: E402
from asofspark.session import local_session  # noqa: E402

HEADLINE = [
    "pit_latest_as_of", "pit_two_clocks", "pit_join", "pit_join_bucketed", "repeated_hour_roundtrip",
    "declared_transform", "melt_series", "coverage_15min", "sample_rule", "alarm_states",
    "repeated_keys", "zone_sum_findings",
]

# whole jobs with writes of their own: one run each, reported beside the headline total
JOBS = ["posting_zip_scan", "stream_hourly_counts"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2)
    times = {}
    for name in names:
        q = QUERIES[name]
        run(q(spark, sf_dir))
        samples = []
        for _ in range(3):
            t0 = time.perf_counter()
            run(q(spark, sf_dir))
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    jobs = {}
    for name in [] if sys.argv[1:] else JOBS:
        t0 = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        jobs[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "jobs": jobs, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
