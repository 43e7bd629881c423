"""Time the headline queries.  Prints one JSON line.

BENCH_SF_DIR   folder of the input tables (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)
BENCH_QUERIES  comma-separated names to run instead of the default ones
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "b10_breaches",
    "c1_inside_flags",
    "e1_edges",
    "c1_site_breaches",
    "c10_grid_edges",
    "c2_breaches_versioned",
    "c3_stream_breaches",
    "b2_poison_split",
    "d6_stream_health",
    "e6_zone_versions",
    "c5_history_join",
    "c4_undelivered",
    "h16_bodies",
    "c7_eval_delta",
    "d9_minute_stats",
    "d11_alarms",
]


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from zonewise.plans.catalog import PLANS
    from zonewise.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session("bench", cores=cpus, shuffle_partitions=cpus)
    spark.read.parquet(f"{sf_dir}/events.parquet").count()

    seconds: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        start = time.perf_counter()
        # Counting over all columns would let Catalyst drop them; the sink reads every value.
        PLANS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]} s", file=sys.stderr, flush=True)
    positions = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    if "b10_breaches" in seconds:
        # Warm run of the flagship for the throughput figure.
        start = time.perf_counter()
        PLANS["b10_breaches"](spark, sf_dir).write.format("noop").mode("overwrite").save()
        rows["positions_per_s"] = round(positions / (time.perf_counter() - start))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
                "positions": positions,
                **rows,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
