"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. Every query
computes all its rows and columns (noop sink); streaming queries include
their whole bounded run.
"""

from __future__ import annotations

import json
import os
import time

from rillmart.plans.queries import REGISTRY
from rillmart.session import local_session

HEADLINE = [
    "route_log",
    "explode_displays",
    "route_cdc",
    "dim_latest",
    "dau_wide",
    "dau_realtime",
    "dau_by_hour_filled",
    "order_wide",
    "order_full_outer",
    "orphan_orders",
    "stats_by_item",
    "stats_by_item_age",
    "detail_by_item",
    "detail_total",
    "top_terms",
    "paginate",
    "sink_upsert_daily",
    "sink_topics",
    "dau_wide_stream",
    "route_cdc_stream",
    "order_wide_stream",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = local_session(cpus, "rillmart-bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
