"""The gold layer as stored tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation

from storelake.functions.dates import period_start
from storelake.plans import dims, facts, iot, rollups
from storelake.sources.tables import PERIOD, side_by_side, write_table

# The gold tables and the labels under which the report lists them.
LABELS = {
    "dim_store": "dim  : dim_store",
    "dim_product": "dim  : dim_product",
    "dim_date": "dim  : dim_date",
    "dim_supplier": "dim  : dim_supplier",
    "fct_daily_sales": "fact : fct_daily_sales",
    "fct_gross_margin": "fact : fct_gross_margin",
    "fct_store_iot_daily": "fact : fct_store_iot_daily",
    "fct_sales_vs_iot": "fact : fct_sales_vs_iot",
    "mv_store_revenue": "mv   : mv_store_revenue",
    "mv_category_revenue": "mv   : mv_category_revenue",
    "mv_margin_summary": "mv   : mv_margin_summary",
}


def store_by_period(
    df: DataFrame, path: str, date_col: str, grain: str = "month", watch: Observation | None = None
) -> DataFrame:
    """Dated rows partitioned by period, so that a date range reads its periods only."""
    dated = df.withColumn(PERIOD, period_start(date_col, grain))
    return write_table(dated, path, partition_by=[PERIOD], watch=watch)


#: What the gold tables need of the lines.
POS_NEEDS = [
    "transaction_id", "store_id", "store_name", "store_city", "store_region", "customer_id",
    "transaction_date", "product_sku", "product_name", "category", "subcategory", "quantity",
    "unit_price", "total_amount",
]
ERP_NEEDS = [
    "order_id", "store_id", "category", "supplier_id", "supplier_name", "supplier_city", "unit_cost",
]


def build_gold(
    pos: DataFrame, erp: DataFrame, readings: DataFrame, root: str, grain: str = "month"
) -> dict[str, DataFrame]:
    """Writes dimensions, facts and rollups under ``root`` and returns the stored tables."""
    return build_counted(pos, erp, readings, root, grain)[0]


def build_counted(
    pos: DataFrame, erp: DataFrame, readings: DataFrame, root: str, grain: str = "month"
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """As ``build_gold``, with the rows of each table as counted while it was written.

    Facts are computed once from the lines; everything behind them reads the stored
    facts, which are smaller by the lines per day, store and category. Tables that do
    not need each other are written side by side.
    """
    watched: dict[str, Observation] = {}

    def store(name: str, df: DataFrame, date_col: str | None = None) -> Callable[[], DataFrame]:
        path, watch = f"{root}/{name}", watched.setdefault(name, Observation(name))
        if date_col:
            return lambda: store_by_period(df, path, date_col, grain, watch)
        return lambda: write_table(df, path, watch=watch)

    out = side_by_side(
        {
            "fct_daily_sales": store("fct_daily_sales", facts.fct_daily_sales(pos), "report_date"),
            "fct_gross_margin": store("fct_gross_margin", facts.gross_margin_unit(pos, erp)),
            "fct_store_iot_daily": store(
                "fct_store_iot_daily", iot.store_iot_daily(readings), "event_date"
            ),
            "dim_product": store("dim_product", dims.dim_product(pos)),
            "dim_supplier": store("dim_supplier", dims.dim_supplier(erp)),
            "dim_store": store("dim_store", dims.dim_store(pos)),
            "dim_date": store("dim_date", dims.dim_date(pos)),
        }
    )
    sales, sensors = out["fct_daily_sales"].drop(PERIOD), out["fct_store_iot_daily"].drop(PERIOD)
    out |= side_by_side(
        {
            "fct_sales_vs_iot": store("fct_sales_vs_iot", iot.sales_vs_iot(sales, sensors), "report_date"),
            "mv_store_revenue": store("mv_store_revenue", rollups.store_daily(sales), "report_date"),
            "mv_category_revenue": store("mv_category_revenue", rollups.category_region(sales)),
            "mv_margin_summary": store(
                "mv_margin_summary", rollups.margin_store(out["fct_gross_margin"])
            ),
        }
    )
    return out, {name: watch.get["n_rows"] for name, watch in watched.items()}


def labelled(stored: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {label: stored[name] for name, label in LABELS.items()}


def register_views(stored: dict[str, DataFrame], prefix: str = "") -> None:
    """Makes the tables available to ``spark.sql`` by name."""
    for name, df in stored.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
