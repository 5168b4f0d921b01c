"""What the plans must and must not hold, whatever the size of the tables."""

from __future__ import annotations

import re

import pytest

from storelake.catalog.jobs import JOBS
from storelake.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")
SAMPLE = [
    "fct_daily_sales", "gross_margin_unit_cost", "sales_vs_iot", "profit_by_sku_fanout",
    "margin_view_fanout", "alert_sales_impact", "store_margin_ranking", "monthly_growth",
    "supplier_performance", "battery_health", "store_last_30d", "merge_upsert_orders",
    "scd2_apply_store", "standard_stream", "dim_date_spine", "surrogate_key",
]


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Tables as if all were too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", SAMPLE)
def test_joins_stay_equi_joins_without_broadcast(no_broadcast, name):
    assert name not in JOBS
    plan = physical(QUERIES[name](no_broadcast, SF_DIR))
    assert not [op for op in FORBIDDEN if op in plan]


def test_windows_over_raw_lines_do_not_occur(no_broadcast):
    """Nothing but scalar results, slice counts and small aggregates passes one task."""
    plan = physical(QUERIES["fct_daily_sales"](no_broadcast, SF_DIR))
    assert "SinglePartition" not in plan and "Window" not in plan


def test_scans_read_the_columns_in_use(spark):
    plan = physical(QUERIES["weekend_flag"](spark, SF_DIR))
    schemas = {s for s in re.findall(r"ReadSchema: struct<([^>]*)", plan)}
    assert not any("o_totalprice" in s or "l_returnflag" in s or "p_name" in s for s in schemas)


def test_date_filter_reaches_below_the_aggregate(spark):
    plan = physical(QUERIES["store_q4"](spark, SF_DIR))
    orders = [line for line in plan.splitlines() if "o_orderdate" in line and "FileScan" in line]
    assert orders and all("1998-10-01" in line for line in orders)
