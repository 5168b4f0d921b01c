"""Times the headline queries and prints one JSON line.

Each query runs once to warm up and then BENCH_REPEATS times (default 3); the
median counts. A run writes its whole result to the no-op sink, so no column is
pruned away and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from storelake.catalog.queries import QUERIES
from storelake.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

HEADLINE = [
    "clean_pos",
    "dim_product",
    "dim_date_spine",
    "sales_buffer",
    "fct_daily_sales",
    "daily_sales_report",
    "gross_margin_erp_cost",
    "gross_margin_unit_cost",
    "store_iot_daily",
    "sales_vs_iot",
    "profit_by_sku_fanout",
    "margin_view_fanout",
    "alert_sales_impact",
    "revenue_by_category",
    "daily_revenue_trend",
    "store_margin_ranking",
    "iot_vs_revenue",
    "iot_battery_vs_revenue",
    "monthly_growth",
    "supplier_performance",
    "battery_health",
    "store_last_30d",
    "rollup_store_daily",
    "merge_upsert_orders",
    "standard_stream",
    "layer_row_counts",
    "quality_summary",
    "ingest_erp_orders",
    "merge_orders_stream",
]


def run_once(spark, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = build_session(
        "storelake-bench",
        f"local[{CPUS}]",
        {
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        run_once(spark, name)
        seconds[name] = round(statistics.median(run_once(spark, name) for _ in range(REPEATS)), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, warm median",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
