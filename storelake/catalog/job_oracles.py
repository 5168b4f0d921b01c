"""SQL for the queries that exercise loading and streaming jobs."""

from __future__ import annotations

_POS = """SELECT transaction_id, store_id, store_name, store_city, store_region, cashier_id, customer_id,
    transaction_date, transaction_time, product_sku, product_name, category, subcategory, quantity,
    CAST(unit_price AS DOUBLE) AS unit_price, discount_pct, CAST(total_amount AS DOUBLE) AS total_amount,
    payment_method, loyalty_points FROM pos"""

_ERP = """SELECT * REPLACE (CAST(unit_cost AS DOUBLE) AS unit_cost, CAST(total_cost AS DOUBLE) AS total_cost)
    FROM erp"""

_ORDER_COLUMNS = """order_date store_id store_city supplier_id supplier_name supplier_city product_sku
    category quantity_ordered quantity_received unit_cost total_cost order_status expected_delivery
    actual_delivery warehouse_id lead_time_days is_late""".split()
_ORDER_UPDATES = "order_status quantity_received actual_delivery is_late load_ts".split()


def _first_orders(side: str) -> str:
    """The newest line of each order on one side of the day that parts the batches."""
    newest = ", ".join(f"{c} DESC NULLS LAST" for c in ["load_ts", *_ORDER_COLUMNS])
    return f"""SELECT DISTINCT ON (order_id) * FROM ({_ERP})
        WHERE load_ts {side} TIMESTAMP '1998-01-01 00:00:00' ORDER BY order_id, {newest}"""


def _merged_orders() -> str:
    """The newest line of each order of two batches: inserted by the first, updated by the second."""
    values = ", ".join(
        f"CASE WHEN {'b.order_id IS NOT NULL THEN b' if c in _ORDER_UPDATES else 'a.order_id IS NULL THEN b'}"
        f".{c} ELSE a.{c} END AS {c}"
        for c in [*_ORDER_COLUMNS, "load_ts"]
    )
    return f"""SELECT coalesce(a.order_id, b.order_id) AS order_id, {values}
        FROM ({_first_orders("<")}) a FULL JOIN ({_first_orders(">=")}) b ON a.order_id = b.order_id"""


JOB_ORACLES = {
    "scan_csv_landing": _POS,
    "scan_parquet_by_name": f"SELECT * EXCLUDE (load_ts) FROM ({_ERP})",
    "scan_parquet_as_variant": f"SELECT * EXCLUDE (load_ts) FROM ({_ERP})",
    "scan_json_array": "SELECT * FROM iot_events",
    "scan_json_array_variant": "SELECT * FROM alerts",
    "file_name_pattern": """SELECT transaction_id, product_sku, transaction_date, quantity FROM pos
        WHERE transaction_date <= DATE '1998-06-30'""",
    "load_metadata": """SELECT count(*) AS n_rows, count(*) AS n_with_file,
        CAST(1 AS BIGINT) AS n_load_times FROM pos""",
    "external_csv_positional": """SELECT transaction_id, store_id, store_region, transaction_date,
        product_sku, CAST(total_amount AS DOUBLE) AS total_amount FROM pos""",
    "external_by_name": """SELECT order_id, store_id, CAST(order_date AS DATE) AS order_date, category,
        CAST(total_cost AS DOUBLE) AS total_cost FROM erp""",
    "external_iot_events": """SELECT r.event_id, r.store_id, CAST(event_ts AS DATE) AS event_date,
        alert_type FROM readings r LEFT JOIN alerts a ON r.event_id = a.event_id""",
    "external_inventory_by_name": """SELECT store_id, product_sku, snapshot_date, quantity_on_hand
        FROM inventory""",
    "ctas_snapshot": "SELECT * FROM f2",
    "insert_select": """SELECT * REPLACE (
            CASE WHEN quantity_on_hand < 10 THEN reorder_level ELSE 5 END AS reorder_level,
            CASE WHEN quantity_on_hand >= 10 THEN last_received_date END AS last_received_date)
        FROM inventory""",
    "truncate_reload": """SELECT transaction_date AS date_key, store_id, product_sku, category,
        count(*) AS total_transactions, CAST(sum(quantity
            * CASE WHEN year(transaction_date) >= 1998 THEN 1 ELSE 2 END) AS BIGINT)
            AS total_quantity,
        CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
        CAST(year(transaction_date) AS INTEGER) AS year FROM pos GROUP BY ALL""",
    "as_of_read": """SELECT order_id, product_sku, order_status, load_ts FROM erp
        WHERE load_ts <= TIMESTAMP '1998-06-30 00:00:00'""",
    "incremental_ingest": _POS,
    "ingest_erp_orders": f"""SELECT * EXCLUDE (load_ts), CAST(1 AS BIGINT) AS rows_rejected
        FROM ({_ERP})""",
    "ingest_erp_inventory": "SELECT *, CAST(1 AS BIGINT) AS rows_rejected FROM inventory",
    "ingest_iot": "SELECT *, CAST(1 AS BIGINT) AS rows_rejected FROM iot_events",
    "append_only_stream": "SELECT * FROM clean",
    "file_ledger": """SELECT CAST(0 AS BIGINT) AS files_missing, CAST(0 AS BIGINT) AS files_twice,
        count(*) AS rows_loaded, CAST(0 AS BIGINT) AS rows_rejected FROM pos""",
    "load_audit": """SELECT 'pos_transactions' AS table_name, CAST(0 AS BIGINT) AS files_over,
        count(*) AS rows_loaded,
        CAST(0 AS BIGINT) AS rows_rejected FROM pos""",
    "run_if_data": "SELECT count(*) AS n_rows FROM inventory",
    "inventory_append": "SELECT * FROM clean_stock",
    "iot_passthrough": "SELECT * FROM iot_events",
    "stream_insert_all": _ERP,
    "chained_refresh": """SELECT transaction_date AS date_key, store_id, product_sku, category,
        count(*) AS total_transactions, CAST(sum(quantity) AS BIGINT) AS total_quantity,
        CAST(sum(total_amount) AS DOUBLE) AS total_revenue FROM clean_lines GROUP BY ALL""",
    "merge_orders_stream": _merged_orders(),
    "orders_change_feed": f"""SELECT * FROM (WITH old AS ({_first_orders("<")}), new AS ({_merged_orders()}),
        pairs AS (SELECT old, new FROM old FULL JOIN new ON old.order_id = new.order_id
            WHERE old IS DISTINCT FROM new)
        SELECT unnest(old), 'DELETE' AS _action, new.order_id IS NOT NULL AS _is_update
            FROM pairs WHERE old.order_id IS NOT NULL
        UNION ALL BY NAME SELECT unnest(new), 'INSERT' AS _action, old.order_id IS NOT NULL AS _is_update
            FROM pairs WHERE new.order_id IS NOT NULL)""",
    "orders_as_of": f"""SELECT * FROM ({_first_orders("<")})""",
    "incremental_rollup": """SELECT store_id, store_name, store_city, store_region, transaction_date,
        CAST(round(sum(total_amount), 2) AS DOUBLE) AS revenue,
        CAST(sum(quantity) AS BIGINT) AS units_sold, count(*) AS n_lines,
        CAST(round(CAST(CAST(sum(total_amount) AS DOUBLE) / count(*) AS DECIMAL(38,9)), 2) AS DOUBLE)
            AS avg_basket
        FROM pos WHERE transaction_id IS NOT NULL AND total_amount > 0 GROUP BY ALL""",
    "incremental_rollup_distinct": """SELECT category, store_region,
        count(DISTINCT transaction_id) AS txns, count(DISTINCT customer_id) AS customers, true AS close
        FROM pos WHERE transaction_id IS NOT NULL AND total_amount > 0 GROUP BY ALL""",
    "repeated_deliveries": f"""
        SELECT lines.*, TIMESTAMP '2024-01-01' + to_hours(hour_of) AS load_ts,
            (SELECT count(*) FROM pos WHERE CAST(transaction_id AS BIGINT) % 4 = 0) AS rows_late
        FROM ({_POS}) lines JOIN (VALUES (0, 8), (1, 8), (1, 15), (2, 9), (3, 14)) d(part, hour_of)
            ON CAST(transaction_id AS BIGINT) % 4 = part""",
    "incremental_margin_store": "SELECT * FROM margin_store",
    "load_clock": "SELECT count(*) AS n_injected, count(*) AS n_clock FROM inventory",
}
