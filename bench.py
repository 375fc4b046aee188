"""Benchmark of the headline queries.

Runs on ``$BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) with
``local[$BENCH_CPUS]`` (default 8) and prints ONE JSON line:

    {"metric": "headline_total_sec", "value": N, "unit": "sec",
     "queries": {"q1_top5": sec, ...}, "sf": "...", ...}

Each query is executed in full into Spark's ``noop`` sink (every row is
computed, nothing is pulled to the driver, as a cluster job writing a
table would).  One untimed warm-up pass runs all queries first; the
reported time of a query is the median of ``$BENCH_RUNS`` (default 5)
timed runs.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll.plans.queries import QUERIES  # noqa: E402
from tillroll.session import build_session  # noqa: E402

HEADLINE = {
    "q1_top5": "monthly_top5",
    "q1_top5_line": "monthly_top5_line",
    "q2_revenue": "monthly_revenue",
    "q2_revenue_full": "monthly_revenue_full",
    "q3_pair_rules": "pair_rules",
    "q3_pair_rules_pct1": "pair_rules_pct1",
    "q3_pair_counts_events": "pair_counts_events",
}


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session(
        f"local[{cpus}]", shuffle_partitions=2 * cpus, app_name="tillroll-bench",
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g"),
               # each test table is one file with one row group, so one task would read it
               "spark.tillroll.rebalanceScans": "true"})
    for name in HEADLINE.values():
        run(spark, name, sf_dir)
    times = {}
    for key, name in HEADLINE.items():
        times[key] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
    match = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(match.group(1)) if match else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "stat": "median",
        "sink": "noop",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
