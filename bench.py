"""Time the main jobs: one JSON line with seconds per query (median of the runs after a warm-up).

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the cores, ``BENCH_RUNS``
the timed runs.  A run computes all result rows and discards them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from martloom.registry import all_queries  # noqa: E402
from martloom.session import build_session  # noqa: E402

HEADLINE = [
    "courier_ledger", "settlement_report", "fact_product_sales", "group_conversion", "vault_sat_auth_history",
    "user_geo_stats", "zone_stats", "friend_recommendations", "order_enrichment", "vault2_l_order_product",
    "user_product_counters", "user_category_counters", "envelope_transactions", "daily_metrics",
    "upsert_last_wins", "campaign_push",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.sql.shuffle.partitions": cpus,
    })
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": int(cpus), "runs": runs}))


if __name__ == "__main__":
    main()
