"""Sensor relations: typed events, alerts and daily store conditions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.functions.bands import low_stock, operational_status, overcrowded, temp_breach
from storelake.functions.numeric import exact_sum, mean, round_dec, to_whole
from storelake.functions.scalars import default_to, has_elements
from storelake.functions.variants import variant_fields, variant_path
from storelake.operators.aggregates import distinct_if
from storelake.schemas import ALERT_ARRAY

# Paths into an event document.
EVENT_PATHS = {
    "event_id": ("event_id", "string"),
    "event_type": ("event_type", "string"),
    "store_id": ("store_id", "string"),
    "store_name": ("store_name", "string"),
    "event_timestamp": ("timestamp", "timestamp_ntz"),
    "device_id": ("device_id", "string"),
    "firmware": ("metadata.firmware", "string"),
    "battery_pct": ("metadata.battery_pct", "int"),
    "signal_rssi": ("metadata.signal_rssi", "int"),
    "store_floor": ("metadata.store_floor", "int"),
}
LOW_BATTERY_PCT = 20


def iot_events(raw: DataFrame) -> DataFrame:
    """Typed events from the raw documents, variant or struct."""
    if raw.schema["data"].dataType.typeName() == "variant":
        return variant_fields(raw, "data", EVENT_PATHS)
    return raw.select(
        *[F.col(f"data.{path}").cast(t).alias(name) for name, (path, t) in EVENT_PATHS.items()]
    )


def _alert_array(raw: DataFrame):
    if raw.schema["data"].dataType.typeName() == "variant":
        return variant_path("data", "alerts", ALERT_ARRAY)
    return F.col("data.alerts")


def iot_alerts(raw: DataFrame, wide: bool = False) -> DataFrame:
    """One row per alert; events without alerts drop out.

    ``wide`` keeps the store name, event type and device of the event too.
    """
    names = ["event_id", "store_id", "event_timestamp"]
    if wide:
        names = ["event_id", "store_id", "store_name", "event_timestamp", "event_type", "device_id"]
    if raw.schema["data"].dataType.typeName() == "variant":
        fields = [variant_path("data", *EVENT_PATHS[n]).alias(n) for n in names]
    else:
        fields = [F.col(f"data.{EVENT_PATHS[n][0]}").alias(n) for n in names]
    with_alerts = raw.select(*fields, _alert_array(raw).alias("_alerts"))
    return (
        with_alerts.where(has_elements("_alerts"))
        .select(*names, F.explode("_alerts").alias("_alert"))
        .select(*names, "_alert.alert_type", "_alert.severity", "_alert.triggered_at")
    )


def external_events(raw: DataFrame) -> DataFrame:
    """Date and alert type per event: one row per alert, or one with none."""
    return raw.select(
        variant_path("data", "event_id", "string").alias("event_id"),
        variant_path("data", "store_id", "string").alias("store_id"),
        variant_path("data", "timestamp", "date").alias("event_date"),
        F.explode_outer(variant_path("data", "alerts", ALERT_ARRAY)).alias("alert"),
    ).select("event_id", "store_id", "event_date", F.col("alert.alert_type").alias("alert_type"))


def explode_object(df: DataFrame, col: str, keep: list[str] | None = None) -> DataFrame:
    """One row per top-level field of a variant object, its value as a variant."""
    fields = df.lateralJoin(df.sparkSession.tvf.variant_explode(F.col(col).outer()))
    return fields.select(*(keep or []), "value")


def alert_summary(alerts: DataFrame, by: str = "store_name") -> DataFrame:
    return alerts.groupBy(by, "alert_type", "severity").agg(F.count("*").alias("alert_count"))


def store_iot_battery(iot: DataFrame) -> DataFrame:
    """Battery and signal per store and day."""
    return (
        iot.withColumn("event_date", F.col("event_timestamp").cast("date"))
        .groupBy("event_date", "store_id", "store_name")
        .agg(
            mean("battery_pct", 2).alias("avg_battery_pct"),
            F.min("battery_pct").alias("min_battery_pct"),
            mean("signal_rssi", 2).alias("avg_signal_rssi"),
        )
    )


def store_iot_daily(readings: DataFrame) -> DataFrame:
    """Sensor readings pivoted to one row per store and day."""

    def of(sensor: str):
        return F.when(F.col("sensor_name") == sensor, F.col("sensor_value"))

    measures = {
        "avg_temp_c": mean(of("temp_c"), 2),
        "max_temp_c": round_dec(F.max(of("temp_c")), 2),
        "avg_weight_kg": mean(of("weight_kg"), 2),
        "avg_footfall": mean(of("footfall"), 2),
        "total_footfall": to_whole(exact_sum(of("footfall"))),
        "avg_occupancy_pct": mean(of("occupancy_pct"), 2),
        "avg_humidity_pct": mean(of("humidity_pct"), 2),
        "avg_power_kw": mean(of("power_kw"), 2),
        "avg_queue_length": mean(of("queue_length"), 2),
        "avg_voltage": mean(of("voltage"), 2),
        "device_count": F.countDistinct("device_id"),
        "low_battery_cnt": distinct_if(F.col("battery_pct") < LOW_BATTERY_PCT, "device_id"),
        "event_count": F.countDistinct("event_id"),
    }
    return (
        readings.withColumn("event_date", F.col("event_ts").cast("date"))
        .groupBy("event_date", "store_id", "store_name")
        .agg(*[m.alias(name) for name, m in measures.items()])
    )


def sales_with_iot(sales: DataFrame, iot: DataFrame) -> DataFrame:
    """Sales rows with the sensor day of their store, where there is one."""
    days = iot.withColumnRenamed("event_date", "report_date").drop("store_name")
    return sales.join(days, ["store_id", "report_date"], "left")


def sales_vs_iot(sales: DataFrame, iot: DataFrame) -> DataFrame:
    """Daily sales with sensor averages and condition flags."""
    return sales_with_iot(sales, iot).select(
        "report_date",
        "store_id",
        "store_name",
        "category",
        "total_revenue",
        "total_txns",
        "avg_basket",
        "unique_customers",
        "avg_temp_c",
        "max_temp_c",
        "avg_footfall",
        "total_footfall",
        F.col("avg_weight_kg").alias("avg_shelf_weight"),
        "avg_power_kw",
        "avg_queue_length",
        "avg_occupancy_pct",
        "device_count",
        "low_battery_cnt",
        default_to(temp_breach("avg_temp_c"), False).alias("is_temp_breach"),
        default_to(low_stock("avg_weight_kg"), False).alias("is_low_stock"),
        default_to(overcrowded("avg_occupancy_pct"), False).alias("is_overcrowded"),
        operational_status("avg_temp_c", "avg_occupancy_pct", "avg_weight_kg").alias(
            "operational_status"
        ),
    )


def status_impact(fact: DataFrame) -> DataFrame:
    """Average revenue and readings per store condition."""
    return fact.groupBy("operational_status").agg(
        F.count("*").alias("store_day_count"),
        mean("total_revenue", 2).alias("avg_revenue"),
        mean("avg_footfall", 2).alias("avg_footfall"),
        mean("avg_temp_c", 2).alias("avg_temp"),
    )
