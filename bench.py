"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores. Each query is run once to warm up
and then BENCH_RUNS times; its time is the median, from building the plan to the last row computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketry.plans.registry import QUERIES  # noqa: E402
from basketry.session import build_session  # noqa: E402
from basketry.sources.staging import drop_staged  # noqa: E402

HEADLINE = [
    "fact_order_items", "upsert_orders", "items_clean", "customer_360", "dominant_category", "rfm_base", "rfm_scored",
    "rfm_ranks", "cohort_retention", "segment_report", "dq_report", "dq_foreign_keys", "dq_reconcile",
    "cluster_assign_fixed", "customer_clusters", "stored_orders", "dq_unique_keys", "kmeans_choose_k",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            began = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(times[1:]), 3)
    drop_staged(spark)
    spark.stop()
    scale = folder.rsplit("sf", 1)[-1]
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
