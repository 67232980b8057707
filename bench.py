"""Timed headline queries; prints one JSON line.

The fleet reports (``d1``, ``d2``, ``d7``) read layers that are stored before the clock starts, as they
do in use; all other queries start from the given tables.

Environment: BENCH_SF_DIR (data directory) and BENCH_CPUS (local cores).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.lake import Lake, plain  # noqa: E402
from catalog.queries import BUILDS, QUERIES  # noqa: E402
from odolake.session import local_session  # noqa: E402

HEADLINE = (
    "p2_silver_clean", "g_gold_snapshot", "w2_gold_sliding", "w3_rolling_rate", "r1_token_bucket",
    "v_reason_counts", "d8_outcome_counts", "r5_circuit_breaker_closed", "j2_latest_per_key",
    "d1_fleet_summary", "d2_fleet_vehicles", "d7_positions", "w6_suppressed_alerts", "m8_top_features",
    "m4_scores", "e1_erase_silver",
)
ON_STORED_LAYERS = ("d1_fleet_summary", "d2_fleet_vehicles", "d7_positions")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", cores=os.environ.get("BENCH_CPUS", "8"))
    spark.read.parquet(f"{sf_dir}/events.parquet").count()
    stored = Lake(spark, sf_dir)
    stored.store_layers()
    timings = {}
    for name in HEADLINE:
        started = time.perf_counter()
        df = plain(BUILDS[name](stored)) if name in ON_STORED_LAYERS else QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
