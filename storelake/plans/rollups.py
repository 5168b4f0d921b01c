"""Rollups of the facts.

The means of means and sums of distinct counts follow the definitions of the
original reports. ``storelake.streaming.rollup`` holds the mergeable form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.functions.numeric import exact_sum, mean, sum_rounded
from storelake.functions.variants import variant_fields


def store_daily(fact: DataFrame) -> DataFrame:
    return fact.groupBy("store_id", "store_name", "store_city", "store_region", "report_date").agg(
        sum_rounded("total_revenue").alias("revenue"),
        F.sum("total_txns").alias("txns"),
        mean("avg_basket", 2).alias("avg_basket"),
        F.sum("unique_customers").alias("customers"),
    )


def store_daily_revenue(pos: DataFrame) -> DataFrame:
    """Revenue per store and day straight from the sales lines."""
    return pos.groupBy("store_id", "store_name", "transaction_date").agg(
        exact_sum("total_amount").cast("double").alias("daily_revenue")
    )


def category_region(fact: DataFrame) -> DataFrame:
    return fact.groupBy("category", "store_region").agg(
        sum_rounded("total_revenue").alias("revenue"),
        F.sum("total_units").alias("units_sold"),
        F.sum("total_txns").alias("transactions"),
        F.count("*").alias("row_count"),
    )


def category_region_lines(pos: DataFrame) -> DataFrame:
    """Category by region straight from the sales lines."""
    return pos.groupBy("store_region", "category").agg(
        exact_sum("total_amount").cast("double").alias("total_revenue"),
        F.sum("quantity").alias("total_units"),
    )


def category_stores(fact: DataFrame) -> DataFrame:
    """Category by region with the number of stores that sell it."""
    return fact.groupBy("category", "store_region").agg(
        sum_rounded("total_revenue").alias("revenue"),
        F.sum("total_units").alias("units_sold"),
        F.countDistinct("store_id").alias("stores_selling"),
    )


def margin_store(fact: DataFrame) -> DataFrame:
    return fact.groupBy("store_id", "store_name", "store_city").agg(
        sum_rounded("total_revenue").alias("total_revenue"),
        sum_rounded("total_cost").alias("total_cost"),
        sum_rounded("gross_profit").alias("total_profit"),
        mean("gross_margin_pct", 1).alias("avg_margin_pct"),
        F.sum("total_units_sold").alias("total_units"),
    )


def erp_cost_lines(raw: DataFrame) -> DataFrame:
    """Category and cost of purchase lines that are variant rows."""
    fields = {"category": ("category", "string"), "total_cost": ("total_cost", "decimal(18,4)")}
    return variant_fields(raw, "raw_data", fields)


def erp_category(raw: DataFrame) -> DataFrame:
    """Purchase cost per category from variant rows."""
    return (
        erp_cost_lines(raw)
        .groupBy("category")
        .agg(exact_sum("total_cost").cast("double").alias("total_sales"))
    )
