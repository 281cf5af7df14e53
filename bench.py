"""Headline-query benchmark.

Runs the headline queries at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints ONE JSON line. Each query is executed in full
(``write.format("noop")``), warm, median of $BENCH_RUNS runs (default 3).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "reconcile_month",
    "reconcile_examples",
    "normalize_core",
    "dedup_keep_last",
    "typed_projection",
    "quality_report",
    "rolling_windows",
    "canonical_text",
    "audit_rollup",
    "snapshot_roundtrip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from snaprecon.plans.catalog import QUERIES
    from snaprecon.session import build_session

    spark = build_session(f"local[{cpus}]")
    # JIT / Python-worker warm-up on the smallest scale
    smoke = "/root/testdata/sf0.001"
    for name in ("reconcile_month", "normalize_core"):
        QUERIES[name](spark, smoke).write.format("noop").mode("overwrite").save()
    out = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(times), 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
