"""The retail relations derived from the test tables.

No join carries a broadcast hint: Spark broadcasts a side only if its size is
below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise, and
adaptive execution splits the partition of a hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.functions.numeric import MONEY, SNAP
from storelake.schemas import ALERT_ARRAY
from storelake.sources.batches import stored_bytes

# Days by which sensor events are moved so that they fall into the order dates.
EVENT_SHIFT_DAYS = 9496
STORES = 25
# Bytes of stored line items for one task of their join with the orders, and
# from how many on; below, adaptive execution sets the tasks.
BYTES_A_TASK = 4 << 20
MANY_BYTES = 64 << 20

SENSOR_OF_EVENT = {
    "click": "footfall",
    "view": "occupancy_pct",
    "purchase": "weight_kg",
    "error": "temp_c",
    "signup": "power_kw",
}


# Schemas of the test tables. Stating them saves reading file footers to plan a query.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _line_with_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order, product and the store of the ordering customer."""
    stores = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, sf_dir, "customer").join(
        stores, F.col("c_nationkey") == F.col("n_nationkey")
    )
    orders = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    lines = _spread(spark, lines, f"{sf_dir}/lineitem.parquet")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def _spread(spark: SparkSession, lines: DataFrame, path: str) -> DataFrame:
    """Lines in as many partitions as their files ask for, by the key of the next join.

    What follows that join in the same tasks, as a first count of distinct values, takes
    many times the bytes that are shuffled, by which adaptive execution sets the tasks.
    """
    stored = stored_bytes(spark, path)
    if stored < MANY_BYTES:
        return lines
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return lines.repartition(max(few, -(-stored // BYTES_A_TASK)), "l_orderkey")


def pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point-of-sale lines."""
    # Four decimals in truth: the cast removes what the doubles are off by.
    amount = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return _line_with_store(spark, sf_dir).select(
        _text("l_orderkey").alias("transaction_id"),
        _text("n_nationkey").alias("store_id"),
        F.col("n_name").alias("store_name"),
        F.col("n_name").alias("store_city"),
        F.col("r_name").alias("store_region"),
        F.concat(F.lit("C"), _text("l_linenumber")).alias("cashier_id"),
        _text("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("transaction_date"),
        F.concat(F.lpad(_text("l_linenumber"), 2, "0"), F.lit(":00:00")).alias("transaction_time"),
        _text("l_partkey").alias("product_sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.round((F.col("l_extendedprice") / F.col("l_quantity")).cast(SNAP), 4)
        .cast(MONEY)
        .alias("unit_price"),
        F.nullif(F.round(F.col("l_discount") * 100).cast("int"), F.lit(0)).alias("discount_pct"),
        amount.cast(MONEY).alias("total_amount"),
        F.concat(F.lit(" "), F.lower("o_orderpriority")).alias("payment_method"),
        F.nullif((F.col("l_suppkey") % 7).cast("int"), F.lit(0)).alias("loyalty_points"),
    )


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("s_city_key"), F.col("n_name").alias("s_city")
        ),
        F.col("s_nationkey") == F.col("s_city_key"),
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier master data: the names that the purchase lines repeat."""
    return _suppliers(spark, sf_dir).select(
        _text("s_suppkey").alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        F.col("s_city").alias("supplier_city"),
    )


def erp_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase order lines."""
    lines = _line_with_store(spark, sf_dir).join(
        _suppliers(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey")
    )
    unit_cost = (F.col("p_retailprice") * 0.6).cast(MONEY)
    received = F.when(F.col("l_returnflag") == "R", 0).otherwise(F.col("l_quantity").cast("int"))
    lead = F.abs(F.datediff("l_shipdate", "o_orderdate")) % 30
    ship_day = F.col("l_shipdate").cast("date")
    return lines.select(
        _text("l_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_date"),
        _text("n_nationkey").alias("store_id"),
        F.col("n_name").alias("store_city"),
        _text("l_suppkey").alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        F.col("s_city").alias("supplier_city"),
        _text("l_partkey").alias("product_sku"),
        F.col("p_type").alias("category"),
        F.col("l_quantity").cast("int").alias("quantity_ordered"),
        received.alias("quantity_received"),
        unit_cost.alias("unit_cost"),
        (unit_cost * F.col("l_quantity").cast("int")).cast(MONEY).alias("total_cost"),
        F.when(F.col("l_linestatus") == "O", "Delayed").otherwise("Delivered").alias("order_status"),
        F.date_add(F.col("o_orderdate").cast("date"), 20).alias("expected_delivery"),
        ship_day.alias("actual_delivery"),
        F.concat(F.lit("W"), _text("n_regionkey")).alias("warehouse_id"),
        lead.alias("lead_time_days"),
        (lead > 20).alias("is_late"),
        F.col("l_shipdate").alias("load_ts"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock of every part in one warehouse per region."""
    regions = table(spark, sf_dir, "region")
    stocked = table(spark, sf_dir, "part").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("in_region")
    )
    return stocked.join(regions, F.col("in_region") == F.col("r_regionkey")).select(
        F.lit("2001-08-01").cast("date").alias("snapshot_date"),
        _text("r_regionkey").alias("store_id"),
        F.concat(F.lit("W"), _text("r_regionkey")).alias("warehouse_id"),
        _text("p_partkey").alias("product_sku"),
        F.col("p_type").alias("category"),
        (F.col("p_size") - 10).alias("quantity_on_hand"),
        F.lit(10).alias("reorder_level"),
        F.lit(100).alias("max_stock_level"),
        F.date_add(F.lit("2001-01-01").cast("date"), F.col("p_size")).alias("last_received_date"),
    )


def iot_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sensor reading per event."""
    stores = table(spark, sf_dir, "nation").select(
        _text("n_nationkey").alias("store_key"), F.col("n_name").alias("store_name")
    )
    sensor = F
    for event_type, name in SENSOR_OF_EVENT.items():
        sensor = sensor.when(F.col("event_type") == event_type, name)
    battery = F.get_json_object("props", "$.k").cast("int")
    events = table(spark, sf_dir, "events").select(
        _text("event_id").alias("event_id"),
        (F.col("ts") - F.make_dt_interval(days=F.lit(EVENT_SHIFT_DAYS))).alias("event_ts"),
        (F.col("user_id") % STORES).cast("string").alias("store_id"),
        _text("user_id").alias("device_id"),
        "event_type",
        sensor.alias("sensor_name"),
        F.col("value").cast(MONEY).alias("sensor_value"),
        battery.alias("battery_pct"),
        (-battery).alias("signal_rssi"),
        F.concat(F.lit("v"), (F.col("user_id") % 3).cast("string")).alias("firmware"),
        (F.col("user_id") % 4).cast("int").alias("store_floor"),
    )
    return events.join(stores, F.col("store_id") == F.col("store_key")).select(
        "event_id", "event_ts", "store_id", "store_name", "device_id", "event_type",
        "sensor_name", "sensor_value", "battery_pct", "signal_rssi", "firmware", "store_floor",
    )


def iot_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event documents as the devices send them, one struct ``data`` per event.

    Error events carry none to two alerts; other events have no alerts field.
    """
    r = iot_readings(spark, sf_dir)
    alert_no = F.when(F.col("battery_pct") % 3 > 0, F.sequence(F.lit(1), F.col("battery_pct") % 3))
    alerts = F.transform(
        F.coalesce(alert_no, F.array().cast("array<int>")),
        lambda i: F.struct(
            F.when(i == 1, "temperature").otherwise("door_open").alias("alert_type"),
            F.when(F.col("battery_pct") < 20, "critical").otherwise("warning").alias("severity"),
            (F.col("event_ts") + F.make_dt_interval(hours=i)).alias("triggered_at"),
        ),
    )
    return r.select(
        F.struct(
            "event_id",
            "event_type",
            "store_id",
            "store_name",
            F.col("event_ts").alias("timestamp"),
            "device_id",
            F.struct("firmware", "battery_pct", "signal_rssi", "store_floor").alias("metadata"),
            F.when(F.col("event_type") == "error", alerts).cast(ALERT_ARRAY).alias("alerts"),
        ).alias("data")
    )


def as_json(col: str) -> Column:
    """JSON text that keeps microseconds."""
    return F.to_json(col, {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})


def iot_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents as a variant column."""
    return iot_documents(spark, sf_dir).select(F.parse_json(as_json("data")).alias("data"))


def erp_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase order lines as one variant column."""
    df = erp_orders(spark, sf_dir)
    return df.select(F.to_variant_object(F.struct(*df.columns)).alias("raw_data"))
