"""Schemas of the landing, silver and dimension relations."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, str]) -> T.StructType:
    return T.StructType(
        [T.StructField(name, T._parse_datatype_string(t)) for name, t in fields]
    )


# Column names, order and types of the feeds.
_POS = (
    ("transaction_id", "string"),
    ("store_id", "string"),
    ("store_name", "string"),
    ("store_city", "string"),
    ("store_region", "string"),
    ("cashier_id", "string"),
    ("customer_id", "string"),
    ("transaction_date", "date"),
    ("transaction_time", "string"),
    ("product_sku", "string"),
    ("product_name", "string"),
    ("category", "string"),
    ("subcategory", "string"),
    ("quantity", "int"),
    ("unit_price", "double"),
    ("discount_pct", "int"),
    ("total_amount", "double"),
    ("payment_method", "string"),
    ("loyalty_points", "int"),
)

_ERP_ORDERS = (
    ("order_id", "string"),
    ("order_date", "timestamp_ntz"),
    ("store_id", "string"),
    ("store_city", "string"),
    ("supplier_id", "string"),
    ("supplier_name", "string"),
    ("supplier_city", "string"),
    ("product_sku", "string"),
    ("category", "string"),
    ("quantity_ordered", "int"),
    ("quantity_received", "int"),
    ("unit_cost", "double"),
    ("total_cost", "double"),
    ("order_status", "string"),
    ("expected_delivery", "date"),
    ("actual_delivery", "date"),
    ("warehouse_id", "string"),
    ("lead_time_days", "int"),
    ("is_late", "boolean"),
)

_ERP_INVENTORY = (
    ("snapshot_date", "date"),
    ("store_id", "string"),
    ("warehouse_id", "string"),
    ("product_sku", "string"),
    ("category", "string"),
    ("quantity_on_hand", "int"),
    ("reorder_level", "int"),
    ("max_stock_level", "int"),
    ("last_received_date", "date"),
)

_IOT_EVENT = (
    ("event_id", "string"),
    ("event_type", "string"),
    ("store_id", "string"),
    ("store_name", "string"),
    ("timestamp", "timestamp_ntz"),
    ("device_id", "string"),
    ("metadata", "struct<firmware:string,battery_pct:int,signal_rssi:int,store_floor:int>"),
    ("alerts", "array<struct<alert_type:string,severity:string,triggered_at:timestamp_ntz>>"),
)

_STORE_SCD2 = (
    ("store_key", "bigint"),
    ("store_id", "string"),
    ("store_name", "string"),
    ("city_name", "string"),
    ("effective_date", "date"),
    ("end_date", "date"),
    ("is_current", "boolean"),
)

ALERT_ARRAY = dict(_IOT_EVENT)["alerts"]

# Lazily built: parsing a type string needs a running session.


def pos_schema() -> T.StructType:
    return _struct(*_POS)


def erp_orders_schema() -> T.StructType:
    return _struct(*_ERP_ORDERS)


def erp_inventory_schema() -> T.StructType:
    return _struct(*_ERP_INVENTORY)


def iot_event_schema() -> T.StructType:
    return _struct(*_IOT_EVENT)


def store_scd2_schema() -> T.StructType:
    return _struct(*_STORE_SCD2)


POS_COLUMNS = [name for name, _ in _POS]
ERP_ORDER_COLUMNS = [name for name, _ in _ERP_ORDERS]
INVENTORY_COLUMNS = [name for name, _ in _ERP_INVENTORY]
