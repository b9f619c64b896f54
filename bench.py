"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]
and print one JSON line.

Each query is fully executed into Spark's ``noop`` sink (every row computed,
nothing collected to the driver). Every query runs ``BENCH_RUNS`` times
(default 2); the reported time is the fastest run (the first run of the
session also pays JIT warm-up), and ``cold`` holds the first-run times.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "slv_players", "slv_sessions", "slv_transactions", "slv_affiliate_cpa_ftd",
    "gold_financial_signals", "gold_affiliate_metrics", "gold_fraud_overview",
    "dq_summary", "signal_validation_counts", "report_risk_by_city",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    from riskmesh.session import build_session
    from riskmesh.plans.catalog import QUERIES
    spark = build_session(f"local[{cpus}]", app="riskmesh-bench",
                          shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)))
    best: dict[str, float] = {}
    cold: dict[str, float] = {}
    for r in range(runs):
        for name in names:
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if r == 0:
                cold[name] = round(dt, 3)
            best[name] = round(min(dt, best.get(name, float("inf"))), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(best.values()), 3),
        "unit": "sec",
        "queries": best,
        "cold": cold,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
