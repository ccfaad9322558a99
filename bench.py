"""Benchmark of the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line.  Every query is executed with the
``noop`` sink: the whole plan runs (scans, shuffles, aggregates) but nothing is
collected to the driver.  Each query runs ``$BENCH_REPEAT`` times (default 2); the best
time counts in ``queries`` and ``value``.  ``first`` has each query's first run, with JVM
warm-up and the size checks of its dimensions (later runs remember those), and ``spread``
the slowest run over the fastest.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from usagelens.plans import catalog  # noqa: E402
from usagelens.session import build_session  # noqa: E402

HEADLINE = [
    "usage_summary",            # AN-1
    "daily_dimension_summary",  # AN-4
    "baseline",                 # AN-18
    "multi_dim_usage",          # AN-20
    "area_rank",                # AN-24
    "day_aggregate",            # AN-38
    "usage_outlier_period",     # AN-7 (skew-safe trimmed mean)
    "online_sessions",          # AN-15
    "roaming_matrix",           # AN-11
    "auth_summary",             # AN-21
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(max(8, cpus * 2))))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=partitions)
    runs: dict[str, list[float]] = {}
    for name in names:
        runs[name] = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[name].append(time.perf_counter() - t0)
    times = {name: round(min(r), 3) for name, r in runs.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "repeat": repeat,
                      "shuffle_partitions": partitions,
                      "first": {n: round(r[0], 3) for n, r in runs.items()},
                      "spread": {n: round(max(r) / min(r), 2) for n, r in runs.items()}}))
    spark.stop()


if __name__ == "__main__":
    main()
