"""Sales and margin facts, and the joins of sales with purchase costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.functions.numeric import (
    MONEY,
    SNAP,
    exact_sum,
    mean,
    percent,
    ratio,
    round_dec,
    safe_div,
    sum_rounded,
)

# Fixed value: share of revenue the flat-rate margin assumes to be profit.
FLAT_MARGIN_RATE = 0.30

STORE_GRAIN = ["store_id", "store_name", "store_city", "category"]


def sales_lines(pos: DataFrame) -> DataFrame:
    """Lines that count as sales."""
    return pos.where(F.col("transaction_id").isNotNull() & (F.col("total_amount") > 0))


def from_staging(stg: DataFrame) -> DataFrame:
    """Lines of the staging form: a timestamp and ``line_total`` per line."""
    return stg.withColumns(
        {
            "transaction_date": F.col("transaction_ts").cast("date"),
            "total_amount": F.col("line_total"),
        }
    ).drop("transaction_ts", "line_total")


def fct_daily_sales(pos: DataFrame) -> DataFrame:
    """Sales per day, store and category.

    ``avg_basket`` is the mean line amount, as the original names it;
    ``avg_txn_amount`` is the revenue per transaction.
    """
    revenue = exact_sum("total_amount")
    return (
        sales_lines(pos)
        .withColumnRenamed("transaction_date", "report_date")
        .groupBy("report_date", "store_id", "store_name", "store_city", "store_region", "category")
        .agg(
            round_dec(revenue, 2).alias("total_revenue"),
            F.sum("quantity").alias("total_units"),
            F.countDistinct("transaction_id").alias("total_txns"),
            mean("total_amount", 2).alias("avg_basket"),
            ratio(revenue, F.countDistinct("transaction_id"), 2).alias("avg_txn_amount"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
    )


def daily_sales_report(pos: DataFrame) -> DataFrame:
    revenue, txns = exact_sum("total_amount"), F.countDistinct("transaction_id")
    return (
        pos.withColumnRenamed("transaction_date", "report_date")
        .groupBy("report_date", "store_id", "store_city", "store_name", "category")
        .agg(
            revenue.cast("double").alias("total_revenue_generated"),
            mean("total_amount", 2).alias("region_score"),
            F.sum("quantity").alias("total_units_sold"),
            txns.alias("total_transactions"),
            ratio(revenue, txns, 2).alias("avg_cart_size"),
            F.countDistinct("customer_id").alias("total_unique_customers"),
        )
    )


def pos_agg_price(pos: DataFrame) -> DataFrame:
    """Revenue, units and mean selling price per store and category."""
    return (
        pos.where(F.col("total_amount") > 0)
        .groupBy(*STORE_GRAIN)
        .agg(
            sum_rounded("total_amount").alias("total_revenue"),
            F.sum("quantity").alias("total_units_sold"),
            mean("unit_price", 2).alias("avg_selling_price"),
        )
    )


def _margins(cost: Column) -> dict[str, Column]:
    revenue = F.col("total_revenue").cast("decimal(28,4)")
    profit = revenue - cost
    return {
        "total_cost": round_dec(cost, 2),
        "gross_profit": round_dec(profit, 2),
        "gross_margin_pct": percent(profit, revenue, 1),
    }


def _margin_fact(pos: DataFrame, erp_agg: DataFrame, cost: Column) -> DataFrame:
    orders = F.coalesce("total_orders", F.lit(0)).alias("total_orders")
    return margin_rows(pos_agg_price(pos), erp_agg, cost, orders)


def margin_rows(sales: DataFrame, erp_agg: DataFrame, cost: Column, *more: Column) -> DataFrame:
    """Both sides come with one row per store and category: the join cannot fan out."""
    joined = sales.join(erp_agg, ["store_id", "category"], "left")
    return joined.select(
        *STORE_GRAIN,
        "total_revenue",
        *[c.alias(name) for name, c in _margins(cost).items()],
        "total_units_sold",
        *more,
    )


def unit_cost(total: Column, n: Column) -> Column:
    """Mean unit cost to four decimals."""
    return F.round(safe_div(total, n).cast(SNAP), 4).cast(MONEY).alias("avg_unit_cost")


def cost_of_units() -> Column:
    """What the units sold cost at the mean unit cost; nothing where it is unknown."""
    cost = F.coalesce("avg_unit_cost", F.lit(0).cast(MONEY)) * F.col("total_units_sold")
    return cost.cast("decimal(28,4)")


def gross_margin_erp(pos: DataFrame, erp: DataFrame) -> DataFrame:
    """Revenue against the whole purchase cost of the store and category."""
    erp_agg = erp.groupBy("store_id", "category").agg(
        F.round(exact_sum("total_cost"), 2).alias("erp_cost"),
        F.countDistinct("order_id").alias("total_orders"),
    )
    cost = F.coalesce("erp_cost", F.lit(0)).cast("decimal(28,4)")
    return _margin_fact(pos, erp_agg, cost)


def gross_margin_unit(pos: DataFrame, erp: DataFrame) -> DataFrame:
    """Revenue against the mean unit cost of the units sold."""
    erp_agg = (
        erp.where(F.col("unit_cost") > 0)
        .groupBy("store_id", "category")
        .agg(
            unit_cost(exact_sum("unit_cost"), F.count("unit_cost")),
            F.countDistinct("order_id").alias("total_orders"),
        )
    )
    return _margin_fact(pos, erp_agg, cost_of_units())


def gross_margin_flat(pos: DataFrame, rate: float = FLAT_MARGIN_RATE) -> DataFrame:
    """Margin if a fixed share of the revenue were profit."""
    revenue = exact_sum("total_amount")
    profit = revenue * F.lit(str(rate)).cast("decimal(4,2)")
    return pos.groupBy("store_name", "category").agg(
        revenue.cast("double").alias("total_revenue_generated"),
        profit.cast("double").alias("gross_profit"),
        round_dec(F.lit(100.0) * safe_div(profit, revenue), 2).alias("gross_margin_pct"),
        F.sum("quantity").alias("number_of_units_sold"),
        F.countDistinct("transaction_id").alias("total_unique_orders"),
    )


def margin_by_category(fact: DataFrame) -> DataFrame:
    return fact.groupBy("category").agg(
        sum_rounded("total_revenue").alias("total_revenue"),
        sum_rounded("total_cost").alias("total_cost"),
        sum_rounded("gross_profit").alias("gross_profit"),
        mean("gross_margin_pct", 1).alias("avg_margin_pct"),
    )


def sales_buffer(pos: DataFrame) -> DataFrame:
    """Daily totals per store and product."""
    return (
        pos.withColumnRenamed("transaction_date", "date_key")
        .groupBy("date_key", "store_id", "product_sku", "category")
        .agg(
            F.count("*").alias("total_transactions"),
            F.sum("quantity").alias("total_quantity"),
            exact_sum("total_amount").cast("double").alias("total_revenue"),
        )
    )


# --- joins of sales and purchases on a shared attribute -------------------------
#
# Each sale meets every purchase line of its product (or store and category).
# The sums over that product of rows follow from each side's own sums and counts:
# a sale amount occurs once per purchase line, and a cost once per sale. So both
# sides aggregate first, and the pairs are never formed.


def _costs(erp: DataFrame, keys: list[str]) -> DataFrame:
    return erp.groupBy(*keys).agg(
        exact_sum("total_cost").alias("_cost"), F.count("*").alias("_n_erp")
    )


def _fanned(revenue: str, cost: str) -> dict[str, Column]:
    money_out = F.col(revenue) * F.col("_n_erp").cast("decimal(15,0)")
    cost_out = F.col(cost) * F.col("_n_pos").cast("decimal(15,0)")
    return {"revenue": money_out, "cost": cost_out, "profit": money_out - cost_out}


def profit_by_sku(pos: DataFrame, erp: DataFrame, fanout: bool = True) -> DataFrame:
    """Sales with the purchase cost of the product.

    ``fanout`` gives the sums over all pairs of sale and purchase line. Without
    it each sale counts once and carries the mean purchase cost per line.
    """
    keys = ["transaction_date", "store_id", "store_name", "product_sku", "product_name", "category"]
    sales = pos.groupBy(*keys).agg(
        F.sum("quantity").alias("_units"),
        exact_sum("total_amount").alias("_revenue"),
        F.count("*").alias("_n_pos"),
    )
    joined = sales.join(_costs(erp, ["product_sku"]), "product_sku")
    if fanout:
        m = _fanned("_revenue", "_cost")
        revenue, cost, units = m["revenue"], m["cost"], F.col("_units") * F.col("_n_erp")
    else:
        revenue, units = F.col("_revenue"), F.col("_units")
        per_line = F.round(safe_div("_cost", "_n_erp").cast(SNAP), 4).cast(MONEY)
        cost = (per_line * F.col("_n_pos")).cast("decimal(28,4)")
    profit = revenue - cost
    return joined.select(
        *keys,
        units.alias("units_sold"),
        revenue.cast("double").alias("revenue"),
        cost.cast("double").alias("total_cost"),
        profit.cast("double").alias("gross_profit"),
        percent(profit, revenue, 2).alias("gross_margin_pct"),
    )


def margin_by_store_category(pos: DataFrame, erp: DataFrame, fanout: bool = True) -> DataFrame:
    """Revenue and purchase cost per store and category, over all pairs or once each."""
    keys = ["store_id", "category"]
    sales = pos.groupBy(*keys).agg(
        exact_sum("total_amount").alias("_revenue"), F.count("*").alias("_n_pos")
    )
    joined = sales.join(_costs(erp, keys), keys)
    if fanout:
        m = _fanned("_revenue", "_cost")
        revenue, cost = m["revenue"], m["cost"]
    else:
        revenue, cost = F.col("_revenue"), F.col("_cost")
    margin = revenue - cost
    return joined.select(
        *keys,
        revenue.cast("double").alias("total_revenue"),
        cost.cast("double").alias("total_cost"),
        margin.cast("double").alias("gross_margin"),
        percent(margin, revenue, 2).alias("gross_margin_pct"),
    )


def alert_sales_impact(alerts: DataFrame, pos: DataFrame, fanout: bool = True) -> DataFrame:
    """Alerts with the revenue of their store on that day.

    ``fanout`` counts joined rows: an alert counts once per sale of the day (once
    if there is none) and the revenue once per alert. Without it alerts and
    revenue count once.
    """
    keys = ["store_id", "alert_date", "alert_type", "severity"]
    raised = (
        alerts.withColumn("alert_date", F.col("triggered_at").cast("date"))
        .groupBy(*keys)
        .agg(F.count("*").alias("_alerts"))
    )
    sales = pos.groupBy("store_id", F.col("transaction_date").alias("alert_date")).agg(
        exact_sum("total_amount").alias("_revenue"), F.count("*").alias("_sales")
    )
    joined = raised.join(sales, ["store_id", "alert_date"], "left")
    if fanout:
        count = F.col("_alerts") * F.greatest(F.coalesce("_sales", F.lit(1)), F.lit(1))
        revenue = F.col("_revenue") * F.col("_alerts").cast("decimal(15,0)")
    else:
        count, revenue = F.col("_alerts"), F.col("_revenue")
    return joined.select(
        *keys, count.alias("alert_count"), revenue.cast("double").alias("same_day_revenue")
    )
