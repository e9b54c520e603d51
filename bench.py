"""Headline benchmark: prints one JSON line with per-query seconds.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Every timed run starts from the landing documents (no model stored by an earlier run is reused)
and forces the full result with Spark's ``noop`` sink, so nothing is collected to the driver.
Reported value per query: median of ``BENCH_RUNS`` runs after one warm-up run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["shred_txn", "latest_per_key", "upsert_latest", "user_manager_phones", "mart_full", "mart_incremental"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE

    from ledgerline.plans.scenario import Scenario
    from ledgerline.queries import QUERIES
    from ledgerline.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    results: dict[str, float] = {}
    for name in names:
        times = []
        for i in range(runs + 1):
            Scenario.reset()
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:  # first run warms the JVM / code caches
                times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "headline_total_seconds",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": int(cpus) if cpus.isdigit() else cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
