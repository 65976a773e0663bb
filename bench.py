"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS the local cores. Every query
computes its whole result and throws it away; the time includes planning.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.queries import QUERIES  # noqa: E402
from stowage.session import build_session  # noqa: E402

HEADLINE = [
    "daily_inventory_level", "inventory_level_by_client", "inventory_kpis", "client_share",
    "latest_item_per_key", "first_per_receipt", "screened_receipts", "monthly_receipts", "monthly_dispatches",
    "stock_by_warehouse", "stock_proportions", "stock_ageing", "pallet_mode", "billing_inflow", "billing_stock",
    "billing_outflow", "report_daily_level", "labor_overlap_adjust", "labor_operations_delivery",
    "labor_margin_by_month",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["client_share"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warms up, untimed
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total time of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
                "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
