"""Times the headline queries: one warm-up, then the median of the timed runs.

Prints one JSON line. Settings: BENCH_SF_DIR, BENCH_CPUS, BENCH_RUNS.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tidemark.plans.session import local_session
from workload import registry

HEADLINES = [
    "stg_market_data",
    "gold_hourly_sentiment",
    "gold_latest_prev_hour",
    "market_summary",
    "symbol_history",
    "semantic_search",
    "search_batch",
    "text_search",
    "upsert_vectors",
    "dq_bronze",
    "ingest_bronze",
    "route_events",
    "rate_limit",
    "counter_rollup",
    "running_level",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, max(8, int(cpus) if cpus.isdigit() else 8))
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    seconds = {}
    for name in HEADLINES:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of median warm run times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
