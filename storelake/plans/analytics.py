"""The report queries over facts, dimensions and rollups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelake.functions.bands import (
    BATTERY_LABELS,
    MARGIN_LABELS,
    MAX_TEMP_C,
    battery_status,
    margin_band,
)
from storelake.functions.numeric import exact_sum, mean, percent, round_dec, sum_rounded
from storelake.operators.aggregates import count_if
from storelake.operators.cleaning import between, order_by, since_latest
from storelake.operators.ordering import ntile_global, pct_of_total, rank_rows, rank_within
from storelake.operators.windows import days_since_seen, moving_avg, pct_change, vs_group_mean
from storelake.plans.iot import LOW_BATTERY_PCT, sales_with_iot

RECENT_DAYS = 30
MOVING_DAYS = 7


def revenue_by_category(fact: DataFrame) -> DataFrame:
    totals = fact.groupBy("category").agg(
        sum_rounded("total_revenue").alias("total_revenue"),
        F.sum("total_units").alias("total_units_sold"),
        F.sum("total_txns").alias("total_transactions"),
        mean("avg_basket", 2).alias("avg_basket_size"),
    )
    return order_by(rank_rows(totals, "total_revenue", "revenue_rank"), "revenue_rank", "category")


def _store_days(fact: DataFrame) -> DataFrame:
    return fact.groupBy("report_date", "store_name").agg(
        exact_sum("total_revenue").cast("double").alias("daily_revenue")
    )


def daily_revenue_trend(fact: DataFrame, by: str = "rows") -> DataFrame:
    """Daily revenue per store with its moving average and change from the day before."""
    days = _store_days(fact)
    days = moving_avg(
        days, "store_name", "report_date", "daily_revenue", MOVING_DAYS, "revenue_7d_ma", by
    )
    days = pct_change(days, ["store_name"], ["report_date"], "daily_revenue", "day_over_day_pct")
    return order_by(days, "store_name", "report_date")


def store_margin_ranking(fact: DataFrame, labels: tuple[str, ...] = MARGIN_LABELS) -> DataFrame:
    """Margin rank in the category, revenue quartile and share, and margin band.

    Tiles come first: they leave the fact checkpointed, and rank and share then
    read that instead of computing the fact again.
    """
    by_revenue = [F.col("total_revenue").desc_nulls_first(), F.col("store_id"), F.col("category")]
    ranked = ntile_global(fact, by_revenue, 4, "revenue_quartile")
    ranked = rank_within(ranked, ["category"], "gross_margin_pct", "rank_in_category")
    ranked = pct_of_total(ranked, "total_revenue", "pct_of_total_revenue")
    out = ranked.select(
        "store_name",
        "store_city",
        "category",
        "total_revenue",
        "total_cost",
        "gross_profit",
        "gross_margin_pct",
        "rank_in_category",
        "revenue_quartile",
        "pct_of_total_revenue",
        margin_band("gross_margin_pct", labels).alias("margin_band"),
    )
    return order_by(out, "category", "rank_in_category", "store_name")


def iot_vs_revenue(fact: DataFrame) -> DataFrame:
    """Store-days with a temperature: revenue against the mean of the store."""
    measured = fact.where(F.col("avg_temp_c").isNotNull())
    compared = vs_group_mean(
        measured, "store_id", "total_revenue", "revenue_vs_store_avg", "revenue_delta_pct"
    )
    out = compared.select(
        "store_name",
        "report_date",
        "category",
        "total_revenue",
        "total_txns",
        "avg_temp_c",
        "max_temp_c",
        "avg_footfall",
        "avg_shelf_weight",
        "operational_status",
        "is_temp_breach",
        "is_low_stock",
        "revenue_vs_store_avg",
        "revenue_delta_pct",
    )
    return order_by(out, "revenue_vs_store_avg", "store_name", "report_date", "category")


def iot_battery_vs_revenue(sales: DataFrame, battery: DataFrame) -> DataFrame:
    """All store-days with battery and signal: revenue against the mean of the store."""
    compared = vs_group_mean(
        sales_with_iot(sales, battery),
        "store_id",
        "total_revenue",
        "revenue_vs_store_avg",
        "revenue_delta_pct",
    )
    out = compared.select(
        "store_name",
        "report_date",
        "category",
        "total_revenue",
        "total_txns",
        "avg_battery_pct",
        "min_battery_pct",
        "avg_signal_rssi",
        "revenue_vs_store_avg",
        "revenue_delta_pct",
    )
    return order_by(out, "revenue_vs_store_avg", "store_name", "report_date", "category")


def sales_by_calendar(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Totals per month of the calendar.

    Sales fold to one row per day before they meet the calendar, so the join
    carries days, not facts.
    """
    days = fact.groupBy(F.col("report_date").alias("date_key")).agg(
        exact_sum("total_revenue").alias("_revenue"),
        F.sum("total_txns").alias("_txns"),
        F.sum("total_units").alias("_units"),
    )
    months = ["year", "month_number", "month_name", "quarter_name", "month_year"]
    return (
        days.join(dim_date, "date_key")
        .groupBy(*months)
        .agg(
            F.sum("_revenue").cast("double").alias("revenue"),
            F.sum("_txns").alias("transactions"),
            F.sum("_units").alias("units"),
        )
    )


def monthly_growth(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue per month and its change from the month before.

    The window holds one partition: its input is one row per month.
    """
    order = ["year", "month_number"]
    months = sales_by_calendar(fact, dim_date).withColumn("_all", F.lit(1))
    months = pct_change(months, ["_all"], order, "revenue", "mom_growth_pct")
    previous = F.lag("revenue").over(Window.partitionBy("_all").orderBy(*order))
    months = months.withColumn("prev_month_revenue", round_dec(previous, 2))
    return months.orderBy(*order).select(
        "month_year",
        "month_name",
        "quarter_name",
        round_dec("revenue", 2).alias("monthly_revenue"),
        F.col("transactions").alias("monthly_txns"),
        "prev_month_revenue",
        "mom_growth_pct",
    )


def supplier_performance(
    erp: DataFrame, dim_supplier: DataFrame, delayed: str = "Delayed"
) -> DataFrame:
    """Orders, volumes, cost and punctuality per supplier and category.

    ``on_time_rate_pct`` divides punctual lines by distinct orders, as the
    original does, and can pass 100; ``on_time_order_pct`` counts orders on both
    sides. Purchases fold to supplier and category before they meet the suppliers.
    """
    punctual = F.col("is_late") == F.lit(False)
    orders = F.countDistinct("order_id")
    folded = (
        erp.where(F.col("order_id").isNotNull())
        .groupBy("supplier_id", "category")
        .agg(
            orders.alias("total_orders"),
            F.sum("quantity_ordered").alias("total_qty_ordered"),
            F.sum("quantity_received").alias("total_qty_received"),
            sum_rounded("total_cost").alias("total_procurement_cost"),
            mean("lead_time_days", 1).alias("avg_lead_time_days"),
            count_if(punctual).alias("on_time_deliveries"),
            F.countDistinct(F.when(punctual, F.col("order_id"))).alias("_on_time_orders"),
            count_if(F.col("order_status") == delayed).alias("delayed_orders"),
        )
    )
    out = orders_with_supplier(folded, dim_supplier).select(
        "supplier_id",
        "supplier_name",
        "supplier_city",
        "category",
        "total_orders",
        "total_qty_ordered",
        "total_qty_received",
        "total_procurement_cost",
        "avg_lead_time_days",
        "on_time_deliveries",
        percent("on_time_deliveries", "total_orders", 1).alias("on_time_rate_pct"),
        percent("_on_time_orders", "total_orders", 1).alias("on_time_order_pct"),
        "delayed_orders",
    )
    return order_by(out, "-on_time_rate_pct", "supplier_id", "category")


def orders_with_supplier(erp: DataFrame, dim_supplier: DataFrame) -> DataFrame:
    names = dim_supplier.select("supplier_id", "supplier_name", "supplier_city")
    return erp.drop("supplier_name", "supplier_city").join(names, "supplier_id", "left")


DEVICE_COLUMNS = [
    "store_name", "store_id", "device_id", "event_type", "battery_pct", "firmware", "store_floor",
]


def battery_health(
    readings: DataFrame,
    ts: str = "event_ts",
    labels: tuple[str, ...] = BATTERY_LABELS,
    any_reading: bool = False,
) -> DataFrame:
    """Low-battery devices and the days since they were last seen.

    As in the original a device counts as seen at its last low-battery reading;
    ``any_reading`` takes its last reading of any kind.
    """
    low = readings.where(F.col("battery_pct") < LOW_BATTERY_PCT)
    latest = readings.select(F.max(F.col(ts).cast("date"))).scalar()
    if any_reading:
        last = readings.groupBy("device_id").agg(F.max(F.col(ts).cast("date")).alias("_last"))
        devices = (
            low.select(*DEVICE_COLUMNS)
            .distinct()
            .join(last, "device_id")
            .select(*DEVICE_COLUMNS, F.datediff(latest, "_last").alias("days_since_last_seen"))
        )
    else:
        devices = days_since_seen(
            low, "device_id", DEVICE_COLUMNS, ts, latest, "days_since_last_seen"
        )
    out = devices.withColumn("battery_status", battery_status("battery_pct", labels))
    return order_by(out, "battery_pct", "store_name", "device_id", "event_type")


def store_last_30d(store_daily: DataFrame, fact: DataFrame) -> DataFrame:
    """Store totals from 30 days before the latest data day on."""
    recent = since_latest(store_daily, "report_date", RECENT_DAYS, of=fact)
    out = recent.groupBy("store_name", "store_city").agg(
        exact_sum("revenue").cast("double").alias("revenue_last_30d"),
        F.sum("txns").alias("txns_last_30d"),
        F.sum("customers").alias("customers_last_30d"),
    )
    return order_by(out, "-revenue_last_30d", "store_name")


def store_30d_from(daily_revenue: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Store totals from 30 days before ``as_of`` on."""
    since = F.date_sub(F.lit(as_of).cast("date"), RECENT_DAYS)
    return (
        daily_revenue.where(F.col("transaction_date") >= since)
        .groupBy("store_id", "store_name")
        .agg(exact_sum("daily_revenue").cast("double").alias("revenue_30d"))
    )


def store_period(store_daily: DataFrame, lo: str, hi: str) -> DataFrame:
    """Store totals of a closed date range, such as a quarter."""
    out = (
        between(store_daily, "report_date", lo, hi)
        .groupBy("store_name", "store_city", "store_region")
        .agg(
            exact_sum("revenue").cast("double").alias("q4_revenue"),
            F.sum("txns").alias("q4_txns"),
        )
    )
    return order_by(out, "-q4_revenue", "store_name")


TEMPERATURE_COLUMNS = [
    "event_date", "store_name", "avg_temp_c", "max_temp_c", "avg_footfall", "low_battery_cnt",
]


def temp_breach_days(iot_daily: DataFrame, only_breaches: bool = True) -> DataFrame:
    days = iot_daily.where(F.col("avg_temp_c") > MAX_TEMP_C) if only_breaches else iot_daily
    return order_by(days.select(*TEMPERATURE_COLUMNS), "-max_temp_c", "event_date", "store_name")


def margin_store_listing(margin_store: DataFrame) -> DataFrame:
    out = margin_store.select(
        "store_name", "store_city", "total_revenue", "total_cost", "total_profit", "avg_margin_pct"
    )
    return order_by(out, "-avg_margin_pct", "store_name")
