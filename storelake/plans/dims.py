"""Conformed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.functions.dates import date_parts, fmt_date, quarter_label
from storelake.operators.aggregates import distinct_rows

# Fixed value: country of stores whose feed names none.
DEFAULT_COUNTRY = "turkey"

STORE_COLUMNS = ["store_id", "store_name", "store_city", "store_region"]
PRODUCT_COLUMNS = ["product_sku", "product_name", "category", "subcategory"]
SUPPLIER_COLUMNS = ["supplier_id", "supplier_name", "supplier_city"]


def dim_store(pos: DataFrame, country: str = DEFAULT_COUNTRY) -> DataFrame:
    return distinct_rows(pos, STORE_COLUMNS, "store_id").withColumn("country", F.lit(country))


def dim_product(pos: DataFrame) -> DataFrame:
    return distinct_rows(pos, PRODUCT_COLUMNS, "product_sku")


def dim_supplier(erp: DataFrame, keep_null_key: bool = False) -> DataFrame:
    return distinct_rows(erp, SUPPLIER_COLUMNS, None if keep_null_key else "supplier_id")


def date_range(bounds: DataFrame, lo: str, hi: str, max_days: int | None = None) -> DataFrame:
    """Every day from ``lo`` to ``hi`` of the one-row relation ``bounds``."""
    last = F.col(hi)
    if max_days is not None:
        last = F.least(last, F.date_add(lo, max_days - 1))
    return bounds.select(F.explode(F.sequence(F.col(lo), last)).alias("date_key"))


def dim_date(pos: DataFrame, max_days: int | None = None) -> DataFrame:
    """Calendar without gaps over the dates of the sales lines.

    The bounds are a partial min and max; only they reach the task that unrolls
    the days.
    """
    bounds = pos.agg(F.min("transaction_date").alias("lo"), F.max("transaction_date").alias("hi"))
    days = date_range(bounds.where(F.col("lo").isNotNull()), "lo", "hi", max_days)
    return days.withColumns(date_parts("date_key"))


def dim_date_observed(pos: DataFrame) -> DataFrame:
    """Calendar of the dates that have sales."""
    days = pos.select(F.col("transaction_date").alias("date_key")).distinct()
    return days.select(
        "date_key",
        F.dayofmonth("date_key").alias("day"),
        F.month("date_key").alias("month_number"),
        F.monthname("date_key").alias("month_name"),
        F.year("date_key").alias("year"),
        F.quarter("date_key").alias("quarter_number"),
        quarter_label("date_key", "Q").alias("quarter_name"),
        fmt_date("date_key", "yyyy-MM").alias("month_year"),
    )
