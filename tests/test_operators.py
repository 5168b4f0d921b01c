from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from storelake.operators import changes, cleaning, merge, ordering, quality, windows
from storelake.plans import analytics, dims, facts


def skewed(spark, n=5000):
    """A third of the rows share one group and one value."""
    hot = F.col("id") % 3 == 0
    return spark.range(n).select(
        "id",
        F.when(hot, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 17)).alias("grp"),
        F.when(hot, 1.0).otherwise(((F.col("id") * 7919) % 113).cast("double")).alias("val"),
    )


@pytest.mark.parametrize("n", [1, 3, 5, 1000])
def test_positions_equal_window(spark, n):
    df = skewed(spark, n)
    order = [F.col("val").desc(), F.col("id")]
    got = ordering.global_positions(df, order).withColumn(
        "expected", F.row_number().over(Window.orderBy(*order))
    )
    assert got.count() == n
    assert got.where("position <> expected").count() == 0


@pytest.mark.parametrize("n,tiles", [(1, 4), (3, 4), (4, 4), (10, 4), (1001, 7)])
def test_ntile_equals_window(spark, n, tiles):
    df = skewed(spark, n)
    order = [F.col("val").desc(), F.col("id")]
    got = ordering.ntile_global(df, order, tiles).withColumn(
        "expected", F.ntile(tiles).over(Window.orderBy(*order))
    )
    assert got.count() == n
    assert got.where("tile <> expected").count() == 0


@pytest.mark.parametrize("descending", [True, False])
def test_rank_equals_window_with_ties_and_nulls(spark, descending):
    df = skewed(spark).withColumn("val", F.when(F.col("id") % 50 != 1, F.col("val")))
    df = df.withColumn("grp", F.when(F.col("id") % 40 != 2, F.col("grp")))
    val = F.col("val").desc_nulls_first() if descending else F.col("val").asc_nulls_last()
    w = Window.partitionBy("grp").orderBy(val)
    got = ordering.rank_within(df, ["grp"], "val", "r", descending)
    expected = df.select("id", F.rank().over(w).alias("e"))
    both = got.join(expected, "id")
    assert both.count() == df.count()
    assert both.where("r <> e").count() == 0


def test_surrogate_keys_are_dense_and_repeatable(spark):
    df = skewed(spark, 300)
    for parts in (1, 6):
        keyed = ordering.add_surrogate_key(df.repartition(parts), ["id"], start=10, name="k")
        assert keyed.where("k <> id + 10").count() == 0


def test_moving_average_counts_rows_or_days(spark, rows):
    days = [("s", dt.date(2024, 1, d), float(d)) for d in (1, 2, 9)]
    df = spark.createDataFrame(days, "store string, day date, v double")
    by_rows = windows.moving_avg(df, "store", "day", "v", 7, "ma")
    by_days = windows.moving_avg(df, "store", "day", "v", 7, "ma", by="days")
    assert [r[0] for r in rows(by_rows, "ma")] == [1.0, 1.5, 4.0]
    assert [r[0] for r in rows(by_days, "ma")] == [1.0, 1.5, 9.0]


def test_change_against_zero_and_first_row(spark, rows):
    data = [("s", 1, 0.0), ("s", 2, 5.0), ("s", 3, 4.0)]
    df = spark.createDataFrame(data, "store string, day int, v double")
    got = windows.pct_change(df, ["store"], ["day"], "v", "pct")
    assert rows(got, "day", "pct") == [(1, None), (2, None), (3, -20.0)]


def test_device_last_seen_counts_low_readings(spark, rows):
    data = [
        ("d1", 15, "2024-01-01 10:00:00"), ("d1", 15, "2024-01-03 10:00:00"),
        ("d1", 12, "2024-01-02 10:00:00"), ("d1", 90, "2024-01-09 10:00:00"),
        ("d2", 20, "2024-01-05 10:00:00"),
    ]
    df = spark.createDataFrame(data, "device_id string, battery_pct int, t string").select(
        "device_id", "battery_pct", F.col("t").cast("timestamp_ntz").alias("event_ts"),
        *[F.lit("x").alias(c) for c in ("store_name", "store_id", "event_type", "firmware", "store_floor")],
    )
    literal = analytics.battery_health(df)
    assert rows(literal, "device_id", "battery_pct", "days_since_last_seen") == [("d1", 12, 6), ("d1", 15, 6)]
    latest = analytics.battery_health(df, any_reading=True)
    assert rows(latest, "device_id", "battery_pct", "days_since_last_seen") == [("d1", 12, 0), ("d1", 15, 0)]


# --- keyed merge ----------------------------------------------------------------

ORDER = "order_id string, quantity_ordered int, order_status string, load_ts int, processed_ts timestamp_ntz"


def test_merge_upsert(spark, rows):
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    target = spark.createDataFrame(
        [("a", 1, "open", 1, old), ("b", 2, "open", 1, old), (None, 9, "open", 1, old)], ORDER
    )
    source = spark.createDataFrame(
        [
            ("a", 100, "late", 2, None), ("a", 100, "done", 3, None), ("a", 100, "held", 1, None),
            ("c", 3, "open", 2, None), (None, 7, "x", 2, None), (None, 8, "x", 2, None),
        ],
        ORDER,
    ).drop("processed_ts")
    got = merge.merge_upsert(
        target, source, ["order_id"], ["order_status"], ["load_ts"], touch="processed_ts", at=new
    )
    assert got.columns == target.columns
    assert rows(got, "order_id", "quantity_ordered", "order_status", "processed_ts") == [
        ("a", 1, "done", new), ("b", 2, "open", old), ("c", 3, "open", new),
        (None, 7, "x", new), (None, 8, "x", new), (None, 9, "open", old),
    ]


def test_merge_can_set_null(spark, rows):
    schema = "order_id string, order_status string, load_ts int"
    target = spark.createDataFrame([("a", "open", 1)], schema)
    source = spark.createDataFrame([("a", None, 2)], schema)
    got = merge.merge_upsert(target, source, ["order_id"], ["order_status"], ["load_ts"])
    assert rows(got, "order_id", "order_status") == [("a", None)]


def test_merge_row_count_is_distinct_keys(spark):
    source = skewed(spark, 900).select(F.col("grp").alias("k"), F.col("id").alias("load_ts"))
    target = spark.createDataFrame([("g1", 0), ("new", 0)], "k string, load_ts bigint")
    got = merge.merge_upsert(target, source, ["k"], ["load_ts"], ["load_ts"])
    assert got.count() == source.select("k").distinct().count() + 1
    assert got.where("k = 'hot'").first().load_ts == 897


# --- change feed ----------------------------------------------------------------


def test_diff_changes(spark, rows):
    schema = "k string, v int"
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", None), (None, 5)], schema)
    new = spark.createDataFrame([("a", 1), ("b", 9), ("d", 4), ("e", 5), (None, 5)], schema)
    feed = changes.diff_changes(old, new, ["k"])
    assert rows(feed, "k", "v", "_action", "_is_update") == [
        ("b", 2, "DELETE", True), ("b", 9, "INSERT", True), ("c", 3, "DELETE", False),
        ("d", 4, "INSERT", True), ("d", None, "DELETE", True), ("e", 5, "INSERT", False),
    ]
    assert rows(changes.inserts_only(feed)) == [("b", 9), ("d", 4), ("e", 5)]


# --- cleaning, listings, rules --------------------------------------------------


def test_clean_pos(spark, rows):
    columns = {
        "transaction_id": "string", "category": "string", "quantity": "int", "unit_price": "double",
        "discount_pct": "int", "total_amount": "double", "payment_method": "string", "loyalty_points": "int",
    }
    data = [
        ("t1", "HOME-garden", -2, -1.5, None, 5.0, "  card ", None),
        ("t2", "food", None, 2.0, 10, 0.01, "Cash", 3),
        ("t3", "food", 1, 2.0, 10, 0.0, "cash", 3),
        ("t4", "food", 1, 2.0, 10, None, "cash", 3),
        (None, "food", 1, 2.0, 10, 5.0, "cash", 3),
    ]
    df = spark.createDataFrame(data, ", ".join(f"{k} {v}" for k, v in columns.items()))
    for name in ("store_id", "store_name", "store_city", "store_region", "cashier_id", "customer_id",
                 "transaction_date", "transaction_time", "product_sku", "product_name", "subcategory"):
        df = df.withColumn(name, F.lit("x"))
    assert rows(cleaning.clean_pos(df), *columns) == [
        ("t1", "Home-Garden", 0, 0.0, 0, 5.0, "CARD", 0),
        ("t2", "Food", None, 2.0, 10, 0.01, "CASH", 3),
    ]


def test_recent_rows(spark):
    at = dt.datetime(2024, 1, 1, 12, 0)
    data = [(i, at - dt.timedelta(minutes=i)) for i in range(10)]
    df = spark.createDataFrame(data, "n int, ts timestamp_ntz")
    got = cleaning.recent_rows(df, "ts", at, 5, 3, ["n"])
    assert [r.n for r in got.collect()] == [0, 1, 2]
    assert cleaning.recent_rows(df, "ts", at, 5, 100, ["n"]).count() == 6


def test_descending_order_puts_nulls_first(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v int")
    assert [r.v for r in cleaning.order_by(df, "-v").collect()] == [None, 3, 1]
    assert [r.v for r in cleaning.order_by(df, "v").collect()] == [1, 3, None]


def test_quality_checks(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", -1), ("b", None)], "k string, v int")
    got = quality.quality_checks(df, {"positive": F.col("v") > 0}, unique={"key": ["k"]})
    assert rows(got) == [("key", 3, 1), ("positive", 3, 2)]


def test_calendar_has_no_gaps_and_honours_a_cap(spark):
    data = [(dt.date(2023, 12, 30),), (dt.date(2025, 3, 2),)]
    pos = spark.createDataFrame(data, "transaction_date date")
    assert dims.dim_date(pos).count() == (data[1][0] - data[0][0]).days + 1
    assert dims.dim_date(pos, max_days=400).count() == 400
    assert dims.dim_date(pos, max_days=9999).count() == 429
    assert dims.dim_date(pos.where("false")).count() == 0


def test_month_without_sales_is_skipped_by_the_lag(spark, rows):
    sales = [(dt.date(2024, 1, 5), 100.0), (dt.date(2024, 3, 5), 150.0)]
    fact = spark.createDataFrame(sales, "report_date date, total_revenue double").withColumns(
        {"total_txns": F.lit(1), "total_units": F.lit(1)}
    )
    calendar = dims.dim_date(fact.withColumnRenamed("report_date", "transaction_date"))
    got = analytics.monthly_growth(fact, calendar)
    assert rows(got, "month_year", "prev_month_revenue", "mom_growth_pct") == [
        ("Jan-2024", None, None), ("Mar-2024", 100.0, 50.0),
    ]


def test_tied_categories_share_a_rank(spark, rows):
    data = [("a", 10.0), ("b", 10.0), ("c", 5.0)]
    fact = spark.createDataFrame(data, "category string, total_revenue double").withColumns(
        {"total_units": F.lit(1), "total_txns": F.lit(1), "avg_basket": F.lit(1.0)}
    )
    assert rows(analytics.revenue_by_category(fact), "category", "revenue_rank") == [
        ("a", 1), ("b", 1), ("c", 3),
    ]


# --- joins that pair every sale with every purchase -----------------------------


def _sales_and_costs(spark):
    """One product holds a third of the rows on both sides."""
    hot = F.col("id") % 3 == 0
    sku = F.when(hot, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 11))
    pos = spark.range(600).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias("transaction_date"),
        F.concat(F.lit("s"), F.col("id") % 5).alias("store_id"),
        F.lit("n").alias("store_name"), sku.alias("product_sku"), F.lit("pn").alias("product_name"),
        F.when(hot, "c0").otherwise(F.concat(F.lit("c"), F.col("id") % 3)).alias("category"),
        (F.col("id") % 9).cast("int").alias("quantity"),
        (F.col("id") * 1.37).cast("decimal(18,4)").alias("total_amount"),
    )
    erp = spark.range(500).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 13)).alias("product_sku"),
        F.concat(F.lit("s"), F.col("id") % 6).alias("store_id"),
        F.concat(F.lit("c"), F.col("id") % 3).alias("category"),
        (F.col("id") * 0.91).cast("decimal(18,4)").alias("total_cost"),
    )
    return pos, erp


def test_profit_by_sku_equals_the_pairs(spark, rows):
    pos, erp = _sales_and_costs(spark)
    keys = ["transaction_date", "store_id", "store_name", "product_sku", "product_name", "category"]
    pairs = pos.join(erp.select("product_sku", "total_cost"), "product_sku").groupBy(*keys).agg(
        F.sum("quantity").alias("units_sold"),
        F.sum("total_amount").cast("double").alias("revenue"),
        F.sum("total_cost").cast("double").alias("total_cost"),
    )
    got = facts.profit_by_sku(pos, erp)
    columns = [*keys, "units_sold", "revenue", "total_cost"]
    assert rows(got, *columns) == rows(pairs, *columns)


def test_margin_view_equals_the_pairs(spark, rows):
    pos, erp = _sales_and_costs(spark)
    keys = ["store_id", "category"]
    pairs = pos.join(erp.drop("product_sku"), keys).groupBy(*keys).agg(
        F.sum("total_amount").cast("double").alias("total_revenue"),
        F.sum("total_cost").cast("double").alias("total_cost"),
    )
    got = facts.margin_by_store_category(pos, erp)
    assert rows(got, *keys, "total_revenue", "total_cost") == rows(pairs)


def test_alert_impact_equals_the_pairs(spark, rows):
    pos, _ = _sales_and_costs(spark)
    alerts = spark.range(90).select(
        F.concat(F.lit("s"), F.col("id") % 7).alias("store_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise("cold").alias("alert_type"),
        F.lit("high").alias("severity"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("id") % 6).cast("int"))).alias("triggered_at"),
    )
    day = F.col("triggered_at").cast("date")
    keys = ["a.store_id", "alert_date", "alert_type", "severity"]
    pairs = (
        alerts.withColumn("alert_date", day).alias("a")
        .join(pos.alias("p"), (F.col("a.store_id") == F.col("p.store_id")) & (F.col("alert_date") == F.col("transaction_date")), "left")
        .groupBy(*keys)
        .agg(F.count("*").alias("alert_count"), F.sum("total_amount").cast("double").alias("same_day_revenue"))
    )
    assert rows(facts.alert_sales_impact(alerts, pos)) == rows(pairs)
