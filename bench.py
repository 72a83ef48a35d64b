"""Benchmark the headline queries; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_RUNS`` (default 7). Each query is executed in full
with the ``noop`` sink (no collect) and timed as the median of warm runs,
after two round-robin warm-up passes over all headline queries. The sizes
that plans remember are dropped before every run, so plan building is timed
in full; ``cold`` has each query's very first run in the session, before
any code is compiled. The one-off build of the fixture warehouse is
reported separately as ``warehouse_build``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "va4_driver_avg_laptime",
    "va5_session_summary",
    "vb5_best_laps",
    "vb8_pitstops",
    "w2_w3_gaps",
    "w4_n3_pitstops",
    "u4_upsert_laps",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "7"))

    from pitlane.config import local_session
    from pitlane.operators.joins import forget_sizes
    from pitlane.plans.catalog import QUERIES
    from pitlane.sources.fixtures import warehouse

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    t0 = time.perf_counter()
    warehouse(spark, sf_dir, reuse=False)  # always timed from scratch
    build = time.perf_counter() - t0

    def run(name: str) -> float:
        forget_sizes()
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    cold = {name: round(run(name), 4) for name in HEADLINE}
    # JIT warm-up: two round-robin passes over all headline queries.
    for _ in range(2):
        for name in HEADLINE:
            run(name)
    per_query = {}
    for name in HEADLINE:
        per_query[name] = round(statistics.median(run(name) for _ in range(runs)), 4)
    print(json.dumps({
        "metric": "headline_queries_total_median",
        "value": round(sum(per_query.values()), 4),
        "unit": "sec",
        "queries": per_query,
        "cold": cold,
        "warehouse_build": round(build, 3),
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
