"""Every query by name, as a function of session and test-table folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.catalog.jobs import JOBS
from storelake.functions import bands, dates, numeric, scalars
from storelake.operators import aggregates as agg
from storelake.operators import changes, cleaning, merge, ordering, quality, scd
from storelake.plans import analytics, dims, facts, gold, iot, rollups
from storelake.session import new_folder
from storelake.sources import tables, testbed

Query = Callable[[SparkSession, str], DataFrame]

QUARTER = ("1998-10-01", "1998-12-31")
TODAY = "1998-12-31"
SEED_DATE = "1996-01-01"
CHANGE_DATE = "1999-01-01"
RECENT_AT = dt.datetime(1998, 1, 15, 12, 0)


class Layers:
    """The relations of the test tables and the facts on top of them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return testbed.table(self.spark, self.dir, name)

    @cached_property
    def pos(self) -> DataFrame:
        return testbed.pos(self.spark, self.dir)

    @cached_property
    def erp(self) -> DataFrame:
        return testbed.erp_orders(self.spark, self.dir)

    @cached_property
    def suppliers(self) -> DataFrame:
        """The supplier dimension from master data, so that no line is read for a name."""
        return dims.dim_supplier(testbed.suppliers(self.spark, self.dir))

    @cached_property
    def inventory(self) -> DataFrame:
        return testbed.inventory(self.spark, self.dir)

    @cached_property
    def readings(self) -> DataFrame:
        return testbed.iot_readings(self.spark, self.dir)

    @cached_property
    def iot_raw(self) -> DataFrame:
        return testbed.iot_raw(self.spark, self.dir)

    @cached_property
    def iot_documents(self) -> DataFrame:
        return testbed.iot_documents(self.spark, self.dir)

    @cached_property
    def iot_events(self) -> DataFrame:
        return iot.iot_events(self.iot_documents)

    @cached_property
    def alerts(self) -> DataFrame:
        return iot.iot_alerts(self.iot_documents, wide=True)

    @cached_property
    def f1(self) -> DataFrame:
        return facts.fct_daily_sales(self.pos)

    @cached_property
    def f3(self) -> DataFrame:
        return facts.gross_margin_erp(self.pos, self.erp)

    @cached_property
    def f4(self) -> DataFrame:
        return facts.gross_margin_unit(self.pos, self.erp)

    @cached_property
    def f7(self) -> DataFrame:
        return iot.store_iot_daily(self.readings)

    @cached_property
    def f8(self) -> DataFrame:
        return iot.sales_vs_iot(self.f1, self.f7)

    @cached_property
    def calendar(self) -> DataFrame:
        return dims.dim_date(self.pos)

    @cached_property
    def store_days(self) -> DataFrame:
        return rollups.store_daily(self.f1)


def _money_out(df: DataFrame, *columns: str) -> DataFrame:
    """Decimals as doubles, the type the results have at the boundary."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


QUERIES: dict[str, Query] = {}


def query(*names: str):
    """Registers a function of the layers under one or more names."""

    def register(fn: Callable[[Layers], DataFrame]):
        for name in names:
            QUERIES[name] = lambda spark, sf_dir: fn(Layers(spark, sf_dir))
        return fn

    return register


# --- projections, filters, scalar expressions -----------------------------------


@query("clean_pos")
def _(x: Layers):
    return _money_out(cleaning.clean_pos(x.pos), "unit_price", "total_amount")


@query("title_case")
def _(x: Layers):
    return x.table("part").select(
        "p_partkey",
        scalars.title_case("p_name").alias("product_title"),
        scalars.title_case(F.concat_ws("-", F.lower("p_type"), "p_brand")).alias("label"),
    )


@query("clamp_min")
def _(x: Layers):
    return x.inventory.select(
        "store_id", "product_sku", "quantity_on_hand",
        scalars.clamp_min("quantity_on_hand").alias("clamped"),
        scalars.clamp_min(
            F.when(F.col("quantity_on_hand") != 0, F.col("quantity_on_hand"))
        ).alias("clamped_or_null"),
    )


@query("default_to")
def _(x: Layers):
    return x.pos.groupBy(
        scalars.default_to("discount_pct", 0).alias("discount_pct"),
        scalars.default_to("loyalty_points", 0).alias("loyalty_points"),
        scalars.default_to(F.col("discount_pct") > 5, False).alias("is_promoted"),
    ).agg(F.count("*").alias("n_lines"))


@query("normalize_code")
def _(x: Layers):
    return x.pos.groupBy(scalars.normalize_code("payment_method").alias("payment_method")).agg(
        F.count("*").alias("n_lines")
    )


@query("row_filters")
def _(x: Layers):
    kept = x.pos.where(
        F.col("customer_id").isNotNull()
        & F.col("loyalty_points").isNotNull()
        & (F.col("total_amount") > 1000)
        & (F.col("store_region") == "ASIA")
    )
    return _money_out(
        kept.select("transaction_id", "store_id", "loyalty_points", "total_amount"), "total_amount"
    )


@query("clean_inventory")
def _(x: Layers):
    return cleaning.clean_inventory(x.inventory)


@query("between_dates", "store_q4")
def _(x: Layers):
    return analytics.store_period(x.store_days, *QUARTER)


@query("recent_rows")
def _(x: Layers):
    recent = cleaning.recent_rows(x.readings, "event_ts", RECENT_AT, 720, 100, ["event_id"])
    return _money_out(recent, "sensor_value")


@query("case_bands_margin")
def _(x: Layers):
    return x.f4.select(
        "store_id", "category", "gross_margin_pct",
        bands.margin_band("gross_margin_pct").alias("margin_band"),
        bands.margin_band("gross_margin_pct", bands.MARGIN_LABELS_TITLE).alias("margin_title"),
    )


@query("case_bands_battery")
def _(x: Layers):
    return x.iot_events.groupBy(
        "battery_pct",
        bands.battery_status("battery_pct").alias("battery_status"),
        bands.battery_status("battery_pct", bands.BATTERY_LABELS_UPPER).alias("battery_code"),
    ).agg(F.count("*").alias("n_events"))


@query("operational_status")
def _(x: Layers):
    return x.f7.select(
        "event_date", "store_id",
        bands.operational_status("avg_temp_c", "avg_occupancy_pct", "avg_weight_kg").alias("status"),
    )


@query("safe_divide")
def _(x: Layers):
    return x.inventory.select(
        "store_id", "product_sku",
        numeric.ratio("max_stock_level", "quantity_on_hand", 4).alias("cover"),
    )


@query("round_decimal")
def _(x: Layers):
    price = F.col("total_amount")
    return x.pos.groupBy("product_sku").agg(
        *[numeric.round_dec(F.sum(price) / 7, n).alias(f"round_{n}") for n in (0, 1, 2, 4)]
    )


@query("typed_casts")
def _(x: Layers):
    return x.table("events").select(
        "event_id",
        scalars.to_type("value", "int").alias("value_int"),
        scalars.to_type(F.col("event_id").cast("string"), "double").alias("id_double"),
        scalars.to_type("value", "string").isNotNull().alias("has_text"),
        scalars.to_type("ts", "date").alias("event_date"),
        scalars.to_type("event_type", "int").alias("not_a_number"),
    )


@query("as_date")
def _(x: Layers):
    return x.table("events").groupBy(
        dates.as_date("ts").alias("event_date"),
        dates.as_date(F.substring(F.col("ts").cast("string"), 1, 10)).alias("from_text"),
    ).agg(F.count("*").alias("n_events"))


@query("date_parts")
def _(x: Layers):
    days = x.table("orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    parts = dates.date_parts("d") | {"sunday_weekday": dates.sunday_weekday("d")}
    return days.withColumns(parts)


@query("format_date")
def _(x: Layers):
    day = F.col("o_orderdate").cast("date")
    return x.table("orders").groupBy(
        dates.fmt_date(day, "yyyy-MM").alias("month_key"),
        dates.fmt_date(day, "MMM-yyyy").alias("month_label"),
    ).agg(F.count("*").alias("n_orders"))


@query("quarter_label")
def _(x: Layers):
    return x.table("orders").groupBy(
        dates.quarter_label("o_orderdate", "Q").alias("quarter_name"),
        dates.quarter_label("o_orderdate", "q", with_year=True).alias("quarter_year"),
    ).agg(F.count("*").alias("n_orders"))


@query("shift_date")
def _(x: Layers):
    return x.table("events").select(
        "event_id",
        dates.shift_date(F.col("ts").cast("date"), -30).alias("days_back"),
        dates.shift_date("ts", -24, "hour").alias("hours_back"),
        dates.shift_date("ts", -5, "minute").alias("minutes_back"),
    )


@query("days_between")
def _(x: Layers):
    return x.erp.groupBy(dates.days_between("order_date", "actual_delivery").alias("days")).agg(
        F.count("*").alias("n_lines")
    )


@query("weekend_flag")
def _(x: Layers):
    return x.pos.groupBy(dates.is_weekend("transaction_date").alias("is_weekend")).agg(
        numeric.sum_rounded("total_amount").alias("revenue")
    )


@query("variant_path", "iot_events_typed")
def _(x: Layers):
    return iot.iot_events(x.iot_raw)


@query("nonempty_arrays")
def _(x: Layers):
    return x.iot_documents.where(scalars.has_elements("data.alerts")).select(
        F.col("data.event_id").alias("event_id"), F.size("data.alerts").alias("n_alerts")
    )


@query("distinct_projection")
def _(x: Layers):
    return agg.distinct_rows(x.readings, ["sensor_name"], "sensor_name")


@query("literal_columns")
def _(x: Layers):
    return tables.with_literals(
        x.table("nation").select("n_nationkey"),
        {"effective_date": (SEED_DATE, "date"), "end_date": (None, "date"), "is_current": True},
    )


# --- joins ----------------------------------------------------------------------


@query("join_sales_date")
def _(x: Layers):
    return analytics.sales_by_calendar(x.f1, x.calendar)


@query("join_left_composite", "gross_margin_erp_cost")
def _(x: Layers):
    return x.f3


@query("join_sales_iot", "sales_vs_iot")
def _(x: Layers):
    return x.f8


@query("join_supplier")
def _(x: Layers):
    joined = analytics.orders_with_supplier(x.erp, x.suppliers)
    return joined.select(
        "order_id", "product_sku", "supplier_id", "supplier_name", "supplier_city", "quantity_ordered"
    )


@query("profit_by_sku_fanout")
def _(x: Layers):
    return facts.profit_by_sku(x.pos, x.erp)


@query("profit_by_sku")
def _(x: Layers):
    return facts.profit_by_sku(x.pos, x.erp, fanout=False)


@query("margin_view_fanout")
def _(x: Layers):
    return facts.margin_by_store_category(x.pos, x.erp)


@query("margin_view")
def _(x: Layers):
    return facts.margin_by_store_category(x.pos, x.erp, fanout=False)


@query("alert_sales_impact")
def _(x: Layers):
    return facts.alert_sales_impact(x.alerts, x.pos)


@query("alert_sales_impact_once")
def _(x: Layers):
    return facts.alert_sales_impact(x.alerts, x.pos, fanout=False)


@query("cross_join_range")
def _(x: Layers):
    bounds = x.table("orders").agg(
        F.min(F.col("o_orderdate").cast("date")).alias("lo"),
        F.max(F.col("o_orderdate").cast("date")).alias("hi"),
    )
    return dims.date_range(bounds, "lo", "hi")


@query("lateral_flatten")
def _(x: Layers):
    return iot.iot_alerts(x.iot_documents)


@query("flatten_object")
def _(x: Layers):
    meta = x.iot_documents.select(
        F.col("data.event_id").alias("event_id"),
        F.parse_json(F.to_json("data.metadata")).alias("metadata"),
    )
    values = iot.explode_object(meta, "metadata", keep=["event_id"])
    return values.select("event_id", F.col("value").cast("string").alias("value"))


@query("scalar_subquery_filter")
def _(x: Layers):
    recent = cleaning.since_latest(x.store_days, "report_date", 30)
    return recent.select("store_id", "report_date", "revenue")


@query("scalar_subquery_project")
def _(x: Layers):
    events = x.iot_events.select(
        "event_id", F.col("event_timestamp").cast("date").alias("event_date")
    )
    return cleaning.with_global_max(events, "event_date", "latest_date")


# --- aggregations ---------------------------------------------------------------


@query("count_all")
def _(x: Layers):
    return agg.row_count(x.pos)


@query("group_sum")
def _(x: Layers):
    measures = {
        "n_lines": F.count("*"),
        "units": F.sum("quantity"),
        "revenue": numeric.sum_rounded("total_amount"),
    }
    return agg.sum_by(x.pos, ["store_id", "product_sku"], measures)


@query("count_distinct_multi")
def _(x: Layers):
    return agg.distinct_by(
        x.pos,
        ["store_id", "category"],
        {"txns": "transaction_id", "customers": "customer_id", "products": "product_sku"},
    )


@query("conditional_agg")
def _(x: Layers):
    late = F.col("is_late")
    return agg.sum_by(
        x.erp,
        ["supplier_id"],
        {
            "late_cost": numeric.round_dec(agg.sum_if(late, "total_cost"), 2),
            "max_late_lead": F.max(F.when(late, F.col("lead_time_days"))),
            "avg_on_time_lead": numeric.mean(F.when(~late, F.col("lead_time_days")), 2),
            "delayed_lines": agg.count_if(F.col("order_status") == "Delayed"),
        },
    )


@query("distinct_conditional")
def _(x: Layers):
    low = F.col("battery_pct") < iot.LOW_BATTERY_PCT
    return agg.sum_by(x.readings, ["store_id"], {"low_devices": agg.distinct_if(low, "device_id")})


@query("pivot_sensors", "store_iot_daily")
def _(x: Layers):
    return x.f7


@query("global_agg")
def _(x: Layers):
    return agg.summary(
        x.f1,
        {
            "total_rows": F.count("*"),
            "stores": F.countDistinct("store_id"),
            "categories": F.countDistinct("category"),
            "first_date": F.min("report_date"),
            "last_date": F.max("report_date"),
            "grand_total_revenue": numeric.sum_rounded("total_revenue"),
        },
    )


@query("basic_aggregates")
def _(x: Layers):
    return agg.sum_by(
        x.erp,
        ["category"],
        {
            "min_cost": F.min("unit_cost").cast("double"),
            "max_cost": F.max("unit_cost").cast("double"),
            "avg_cost": numeric.mean("unit_cost", 4),
            "sum_cost": numeric.sum_rounded("total_cost"),
            "n_lines": F.count("*"),
        },
    )


@query("ratio_of_aggregates")
def _(x: Layers):
    revenue = numeric.exact_sum("total_amount")
    return agg.sum_by(
        x.pos,
        ["store_id"],
        {
            "basket": numeric.ratio(revenue, F.countDistinct("transaction_id"), 2),
            "revenue_per_unit": numeric.ratio(revenue, F.sum("quantity"), 4),
        },
    )


@query("group_by_expr")
def _(x: Layers):
    return agg.sum_by(
        x.readings, [F.col("event_ts").cast("date").alias("event_date")], {"n_events": F.count("*")}
    )


@query("alert_summary")
def _(x: Layers):
    return cleaning.order_by(iot.alert_summary(x.alerts), "-alert_count", "store_name")


@query("alert_summary_by_id")
def _(x: Layers):
    return cleaning.order_by(iot.alert_summary(x.alerts, by="store_id"), "-alert_count", "store_id")


@query("ops_status_impact")
def _(x: Layers):
    return cleaning.order_by(iot.status_impact(x.f8), "-avg_revenue")


@query("margin_by_category")
def _(x: Layers):
    return cleaning.order_by(facts.margin_by_category(x.f4), "-avg_margin_pct")


@query("margin_by_category_erp_cost")
def _(x: Layers):
    return cleaning.order_by(facts.margin_by_category(x.f3), "-avg_margin_pct")


# --- windows --------------------------------------------------------------------


@query("rank_category", "revenue_by_category")
def _(x: Layers):
    return analytics.revenue_by_category(x.f1)


@query("rank_in_category")
def _(x: Layers):
    staged = ordering.stage(x.f4)
    ranked = ordering.rank_within(staged, ["category"], "gross_margin_pct", "rank_in_category")
    return ranked.select("store_id", "category", "gross_margin_pct", "rank_in_category")


@query("revenue_quartile")
def _(x: Layers):
    order = [F.col("total_revenue").desc_nulls_first(), F.col("store_id"), F.col("category")]
    tiled = ordering.ntile_global(x.f4, order, 4, "revenue_quartile")
    return tiled.select("store_id", "category", "total_revenue", "revenue_quartile")


@query("pct_of_total")
def _(x: Layers):
    shares = ordering.pct_of_total(x.f4, "total_revenue", "pct_of_total_revenue")
    return shares.select("store_id", "category", "total_revenue", "pct_of_total_revenue")


@query("moving_avg_7", "day_over_day", "daily_revenue_trend")
def _(x: Layers):
    return analytics.daily_revenue_trend(x.f1)


@query("moving_avg_7_days")
def _(x: Layers):
    return analytics.daily_revenue_trend(x.f1, by="days")


@query("month_over_month", "monthly_growth")
def _(x: Layers):
    return analytics.monthly_growth(x.f1, x.calendar)


@query("vs_store_avg", "iot_vs_revenue")
def _(x: Layers):
    return analytics.iot_vs_revenue(x.f8)


@query("device_last_seen", "battery_health")
def _(x: Layers):
    return analytics.battery_health(x.readings)


@query("battery_health_any_reading")
def _(x: Layers):
    return analytics.battery_health(
        x.iot_events, "event_timestamp", bands.BATTERY_LABELS_UPPER, any_reading=True
    )


@query("row_generator")
def _(x: Layers):
    """As many generated rows as the order range has days, each dated from its number."""
    days = F.to_date("o_orderdate")
    span = x.table("orders").agg(F.min(days).alias("first"), F.max(days).alias("last")).first()
    n = (span["last"] - span["first"]).days + 1 if span["first"] else 0
    numbered = tables.number_rows(x.spark, n)
    day = F.date_add(F.lit(span["first"]), F.col("row_id").cast("int"))
    return numbered.select("row_id", day.alias("day"))


@query("row_number_spine")
def _(x: Layers):
    days = x.table("orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return ordering.global_positions(days, [F.col("d")], "row_id")


# --- sort, limit, listings ------------------------------------------------------


@query("ordered_listing")
def _(x: Layers):
    return cleaning.order_by(dims.dim_product(x.pos), "product_sku", "-category")


@query("top_n")
def _(x: Layers):
    report = facts.daily_sales_report(x.pos)
    return cleaning.top_n(report, ["-total_revenue_generated", "report_date", "store_id"], 20)


@query("layer_listing")
def _(x: Layers):
    return cleaning.order_by(rollups.category_region_lines(x.pos), "-total_revenue")


@query("layer_row_counts")
def _(x: Layers):
    """Rows of every gold table, counted as they are written; lines are derived once."""
    pos, erp = _stored_lines(x, gold.POS_NEEDS, gold.ERP_NEEDS)
    _, rows = gold.build_counted(pos, erp, x.readings, new_folder(x.spark, "layers"), grain="year")
    counts = [(label, rows[name]) for name, label in gold.LABELS.items()]
    return x.spark.createDataFrame(counts, "layer_table string, n_rows bigint").orderBy("layer_table")


def _stored_lines(x: Layers, pos: list[str], erp: list[str]) -> tuple[DataFrame, DataFrame]:
    """The named columns of sales and of purchase lines, each derived once and stored."""
    root = new_folder(x.spark, "lines")
    out = tables.side_by_side(
        {
            "pos": lambda: tables.write_table(x.pos.select(*pos), f"{root}/pos"),
            "erp": lambda: tables.write_table(x.erp.select(*erp), f"{root}/erp"),
        }
    )
    return out["pos"], out["erp"]


# --- change data and dimensions over time ---------------------------------------


def _orders_before_and_changes(x: Layers) -> tuple[DataFrame, DataFrame]:
    """One row per order from the settled lines, and the open lines as changes."""
    settled = x.erp.where(F.col("order_status") == "Delivered")
    target = merge.latest_per_key(settled, merge.ORDER_KEYS, ["load_ts", "product_sku"])
    target = target.withColumn("processed_ts", F.lit("2000-01-01").cast("timestamp_ntz"))
    return target, x.erp.where(F.col("order_status") == "Delayed")


@query("merge_upsert_orders")
def _(x: Layers):
    target, source = _orders_before_and_changes(x)
    merged = merge.merge_upsert(
        target.drop("load_ts"),
        source,
        merge.ORDER_KEYS,
        merge.ORDER_UPDATES,
        ["load_ts", "product_sku"],
        touch="processed_ts",
        at=dt.datetime(2001, 1, 1),
    )
    return _money_out(merged, "unit_cost", "total_cost")


def _store_updates(x: Layers) -> DataFrame:
    """Stores as the feed sees them: those of one region moved to the region's name."""
    stores = dims.dim_store(x.pos)
    city = F.when(F.col("store_region") == "ASIA", F.col("store_region")).otherwise(
        F.col("store_city")
    )
    return stores.select("store_id", "store_name", city.alias("store_city"))


def _seeded(x: Layers) -> DataFrame:
    """First load, without the stores of one region, which the updates then add."""
    known = x.pos.where(F.col("store_region") != "EUROPE")
    return scd.scd2_seed(dims.dim_store(known), SEED_DATE)


@query("scd2_seed")
def _(x: Layers):
    return scd.scd2_seed(x.pos, SEED_DATE)


@query("scd2_apply_store")
def _(x: Layers):
    return scd.scd2_apply(_seeded(x), _store_updates(x), CHANGE_DATE)


@query("scd2_apply_store_literal", "scd_self_lookup")
def _(x: Layers):
    return scd.scd2_apply(_seeded(x), _store_updates(x), CHANGE_DATE, literal=True)


@query("surrogate_key")
def _(x: Layers):
    products = dims.dim_product(x.pos)
    return ordering.add_surrogate_key(products, ["product_sku"], name="product_key")


def _stock_versions(x: Layers) -> tuple[DataFrame, DataFrame]:
    """Stock before and after: empty shelves leave, full ones are counted anew."""
    old = x.inventory.where(F.col("quantity_on_hand") < 35)
    new = cleaning.clean_inventory(x.inventory).where(F.col("quantity_on_hand") != 0)
    return old, new


@query("standard_stream")
def _(x: Layers):
    old, new = _stock_versions(x)
    return changes.diff_changes(old, new, ["store_id", "product_sku"])


@query("insert_action_filter")
def _(x: Layers):
    old, new = _stock_versions(x)
    return changes.inserts_only(changes.diff_changes(old, new, ["store_id", "product_sku"]))


# --- dimensions, facts, rollups -------------------------------------------------


@query("dim_store")
def _(x: Layers):
    return dims.dim_store(x.pos)


@query("dim_product")
def _(x: Layers):
    return dims.dim_product(x.pos)


@query("dim_date_spine")
def _(x: Layers):
    return x.calendar


@query("dim_date_distinct")
def _(x: Layers):
    return dims.dim_date_observed(x.pos)


@query("dim_supplier")
def _(x: Layers):
    return dims.dim_supplier(x.erp)


@query("iot_alerts")
def _(x: Layers):
    return iot.iot_alerts(x.iot_raw, wide=True)


@query("sales_buffer")
def _(x: Layers):
    return facts.sales_buffer(x.pos)


@query("fct_daily_sales")
def _(x: Layers):
    return x.f1


@query("fct_daily_sales_staging")
def _(x: Layers):
    """The fact from lines of the staging form: a timestamp and ``line_total``."""
    staged = x.pos.withColumns(
        {
            "transaction_ts": F.col("transaction_date").cast("timestamp_ntz"),
            "line_total": F.col("total_amount"),
        }
    ).drop("transaction_date", "total_amount")
    return facts.fct_daily_sales(facts.from_staging(staged))


@query("daily_sales_report")
def _(x: Layers):
    return facts.daily_sales_report(x.pos)


@query("gross_margin_unit_cost")
def _(x: Layers):
    return x.f4


@query("gross_margin_flat_rate")
def _(x: Layers):
    return facts.gross_margin_flat(x.pos)


@query("store_iot_battery_daily")
def _(x: Layers):
    return iot.store_iot_battery(x.iot_events)


@query("pos_agg_price")
def _(x: Layers):
    return facts.pos_agg_price(x.pos)


@query("store_margin_ranking")
def _(x: Layers):
    return analytics.store_margin_ranking(x.f4)


@query("iot_battery_vs_revenue")
def _(x: Layers):
    return analytics.iot_battery_vs_revenue(x.f1, iot.store_iot_battery(x.iot_events))


@query("supplier_performance")
def _(x: Layers):
    return analytics.supplier_performance(x.erp, x.suppliers)


@query("store_last_30d")
def _(x: Layers):
    return analytics.store_last_30d(x.store_days, x.f1)


@query("store_30d_from_today")
def _(x: Layers):
    return analytics.store_30d_from(rollups.store_daily_revenue(x.pos), TODAY)


@query("category_stores_selling")
def _(x: Layers):
    return cleaning.order_by(rollups.category_stores(x.f1), "-revenue")


@query("temp_breach_days")
def _(x: Layers):
    return analytics.temp_breach_days(x.f7)


@query("temp_days_listing")
def _(x: Layers):
    return analytics.temp_breach_days(x.f7, only_breaches=False)


@query("margin_store_listing")
def _(x: Layers):
    return analytics.margin_store_listing(rollups.margin_store(x.f4))


@query("rollup_store_daily")
def _(x: Layers):
    return x.store_days


@query("rollup_store_daily_lines")
def _(x: Layers):
    return rollups.store_daily_revenue(x.pos)


@query("rollup_category_region")
def _(x: Layers):
    return rollups.category_region(x.f1)


@query("rollup_category_region_lines")
def _(x: Layers):
    return rollups.category_region_lines(x.pos)


@query("rollup_margin_store")
def _(x: Layers):
    return rollups.margin_store(x.f4)


@query("rollup_erp_category")
def _(x: Layers):
    return rollups.erp_category(testbed.erp_raw(x.spark, x.dir))


@query("quality_summary")
def _(x: Layers):
    """Rules over stored lines, so that the base tables are joined once, not per rule."""
    pos, erp = _stored_lines(x, gold.POS_NEEDS, ["order_id", "store_id", "category", "unit_cost", "total_cost"])
    daily = facts.fct_daily_sales(pos)
    profit = {"profit_positive": F.col("gross_profit") > 0}
    calendar = dims.dim_date(pos).agg(
        F.count("*").alias("days"), F.datediff(F.max("date_key"), F.min("date_key")).alias("span")
    )
    fact_total = daily.agg(numeric.exact_sum("total_revenue").alias("fact"), F.count("*").alias("n"))
    totals = fact_total.withColumn(
        "source", facts.sales_lines(pos).select(numeric.exact_sum("total_amount")).scalar()
    )
    # Each fact row is rounded to cents, so the totals may differ by half a cent a row.
    close = F.abs(F.col("fact") - F.col("source")) <= F.col("n") * F.lit("0.005").cast("decimal(4,3)")
    named = {
        "dim_store": quality.quality_checks(dims.dim_store(pos), unique={"key": ["store_id"]}),
        "dim_product": quality.quality_checks(dims.dim_product(pos), unique={"key": ["product_sku"]}),
        "dim_date": quality.quality_checks(calendar, {"continuous": F.col("days") == F.col("span") + 1}),
        "daily_sales": quality.quality_checks(totals, {"equals_source": close}),
        "margin_erp_cost": quality.quality_checks(facts.gross_margin_erp(pos, erp), profit),
        "margin_unit_cost": quality.quality_checks(facts.gross_margin_unit(pos, erp), profit),
        "clean_pos": quality.quality_checks(
            cleaning.clean_pos(x.pos),
            {"quantity_not_negative": F.col("quantity") >= 0, "amount_positive": F.col("total_amount") > 0},
        ),
    }
    out = None
    for subject, checks in named.items():
        rows = checks.select(F.lit(subject).alias("subject"), "rule", "rows_checked", "rows_failed")
        out = rows if out is None else out.unionByName(rows)
    return out


QUERIES.update(JOBS)
