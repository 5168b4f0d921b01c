"""SQL for each query, run by another engine on the same test tables.

Each query names the relations it needs; ``_with`` puts their definitions in
front, in order. Sums run over DECIMAL, quotients are cast to DECIMAL(38,9)
before rounding, and results leave as DOUBLE, BIGINT, INTEGER, DATE, TIMESTAMP.
"""

from __future__ import annotations

import re

from storelake.catalog.job_oracles import JOB_ORACLES


def rnd(x: str, n: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,9)), {n}) AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def ratio(a: str, b: str, n: int) -> str:
    return rnd(div(a, b), n)


def pct(a: str, b: str, n: int) -> str:
    return rnd(f"(100.0::DOUBLE * CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))", n)


def m(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,4))"


def msum(x: str) -> str:
    return f"sum({m(x)})"


def total(x: str, n: int = 2) -> str:
    return rnd(msum(x), n)


def mean(x: str, n: int) -> str:
    return ratio(msum(x), f"count({x})", n)


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def num(x: str) -> str:
    return f"CAST({x} AS INTEGER)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _sensor(name: str, what: str = "sensor_value") -> str:
    return f"CASE WHEN sensor_name = '{name}' THEN {what} END"


_STATUS = """CASE WHEN avg_temp_c > 25 THEN 'temp_breach' WHEN avg_occupancy_pct > 80 THEN 'overcrowd'
    WHEN avg_weight_kg < 5 THEN 'low_stock' ELSE 'normal' END"""


def _margin_band(names: tuple[str, ...]) -> str:
    a, b, c, d = names
    return (
        f"CASE WHEN gross_margin_pct >= 35 THEN '{a}' WHEN gross_margin_pct >= 30 THEN '{b}' "
        f"WHEN gross_margin_pct >= 25 THEN '{c}' ELSE '{d}' END"
    )


def _battery(a: str, b: str, c: str) -> str:
    return f"CASE WHEN battery_pct < 10 THEN '{a}' WHEN battery_pct < 20 THEN '{b}' ELSE '{c}' END"


def _margins(cost: str) -> str:
    return f"""{rnd(cost, 2)} AS total_cost,
    {rnd(f"total_revenue_dec - {cost}", 2)} AS gross_profit,
    {pct(f"(total_revenue_dec - {cost})", "total_revenue_dec", 1)} AS gross_margin_pct"""


_ALERTS_OF = "CASE WHEN event_type = 'error' THEN battery_pct % 3 ELSE 0 END"

RELATIONS = {
    "lines": """SELECT * FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        JOIN part ON l_partkey = p_partkey""",
    "pos": f"""SELECT CAST(l_orderkey AS VARCHAR) AS transaction_id,
        CAST(n_nationkey AS VARCHAR) AS store_id, n_name AS store_name, n_name AS store_city,
        r_name AS store_region, 'C' || l_linenumber AS cashier_id,
        CAST(o_custkey AS VARCHAR) AS customer_id, CAST(o_orderdate AS DATE) AS transaction_date,
        lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || ':00:00' AS transaction_time,
        CAST(l_partkey AS VARCHAR) AS product_sku, p_name AS product_name, p_type AS category,
        p_brand AS subcategory, CAST(l_quantity AS INTEGER) AS quantity,
        CAST(round(CAST(l_extendedprice / l_quantity AS DECIMAL(38,9)), 4) AS DECIMAL(18,4)) AS unit_price,
        nullif(CAST(round(l_discount * 100) AS INTEGER), 0) AS discount_pct,
        CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
            AS DECIMAL(18,4)) AS total_amount,
        ' ' || lower(o_orderpriority) AS payment_method,
        nullif(CAST(l_suppkey % 7 AS INTEGER), 0) AS loyalty_points FROM lines""",
    "erp": f"""SELECT CAST(l_orderkey AS VARCHAR) AS order_id, o_orderdate AS order_date,
        CAST(lines.n_nationkey AS VARCHAR) AS store_id, lines.n_name AS store_city,
        CAST(l_suppkey AS VARCHAR) AS supplier_id, s_name AS supplier_name,
        sn.n_name AS supplier_city, CAST(l_partkey AS VARCHAR) AS product_sku, p_type AS category,
        CAST(l_quantity AS INTEGER) AS quantity_ordered,
        CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS quantity_received,
        CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 0.6 AS DECIMAL(18,4)) AS unit_cost,
        CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 0.6 * CAST(l_quantity AS INTEGER)
            AS DECIMAL(18,4)) AS total_cost,
        CASE WHEN l_linestatus = 'O' THEN 'Delayed' ELSE 'Delivered' END AS order_status,
        CAST(o_orderdate AS DATE) + 20 AS expected_delivery,
        CAST(l_shipdate AS DATE) AS actual_delivery, 'W' || lines.n_regionkey AS warehouse_id,
        CAST(abs(date_diff('day', o_orderdate, l_shipdate)) % 30 AS INTEGER) AS lead_time_days,
        abs(date_diff('day', o_orderdate, l_shipdate)) % 30 > 20 AS is_late, l_shipdate AS load_ts
        FROM lines JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation sn ON s_nationkey = sn.n_nationkey""",
    "inventory": """SELECT DATE '2001-08-01' AS snapshot_date, CAST(r_regionkey AS VARCHAR) AS store_id,
        'W' || r_regionkey AS warehouse_id, CAST(p_partkey AS VARCHAR) AS product_sku,
        p_type AS category, p_size - 10 AS quantity_on_hand, 10 AS reorder_level,
        100 AS max_stock_level, DATE '2001-01-01' + p_size AS last_received_date
        FROM part, region""",
    "readings": f"""SELECT CAST(event_id AS VARCHAR) AS event_id, ts - INTERVAL 9496 DAY AS event_ts,
        CAST(user_id % 25 AS VARCHAR) AS store_id, n_name AS store_name,
        CAST(user_id AS VARCHAR) AS device_id, event_type,
        CASE event_type WHEN 'click' THEN 'footfall' WHEN 'view' THEN 'occupancy_pct'
            WHEN 'purchase' THEN 'weight_kg' WHEN 'error' THEN 'temp_c'
            WHEN 'signup' THEN 'power_kw' END AS sensor_name,
        {m("value")} AS sensor_value, CAST(props->>'$.k' AS INTEGER) AS battery_pct,
        -CAST(props->>'$.k' AS INTEGER) AS signal_rssi, 'v' || (user_id % 3) AS firmware,
        CAST(user_id % 4 AS INTEGER) AS store_floor
        FROM events JOIN nation ON user_id % 25 = n_nationkey""",
    "iot_events": """SELECT event_id, event_type, store_id, store_name, event_ts AS event_timestamp,
        device_id, firmware, battery_pct, signal_rssi, store_floor FROM readings""",
    "alerts": f"""SELECT event_id, store_id, store_name, event_ts AS event_timestamp, event_type,
        device_id, CASE WHEN i = 1 THEN 'temperature' ELSE 'door_open' END AS alert_type,
        CASE WHEN battery_pct < 20 THEN 'critical' ELSE 'warning' END AS severity,
        event_ts + i * INTERVAL 1 HOUR AS triggered_at
        FROM (SELECT *, unnest(range(1, 1 + {_ALERTS_OF})) AS i FROM readings)""",
    "f1": f"""SELECT transaction_date AS report_date, store_id, store_name, store_city, store_region,
        category, {total("total_amount")} AS total_revenue, {big("sum(quantity)")} AS total_units,
        count(DISTINCT transaction_id) AS total_txns, {mean("total_amount", 2)} AS avg_basket,
        {ratio(msum("total_amount"), "count(DISTINCT transaction_id)", 2)} AS avg_txn_amount,
        count(DISTINCT customer_id) AS unique_customers
        FROM pos WHERE transaction_id IS NOT NULL AND total_amount > 0 GROUP BY ALL""",
    "f2": f"""SELECT transaction_date AS report_date, store_id, store_city, store_name, category,
        {dbl(msum("total_amount"))} AS total_revenue_generated,
        {mean("total_amount", 2)} AS region_score, {big("sum(quantity)")} AS total_units_sold,
        count(DISTINCT transaction_id) AS total_transactions,
        {ratio(msum("total_amount"), "count(DISTINCT transaction_id)", 2)} AS avg_cart_size,
        count(DISTINCT customer_id) AS total_unique_customers FROM pos GROUP BY ALL""",
    "price": f"""SELECT store_id, store_name, store_city, category,
        {total("total_amount")} AS total_revenue, {big("sum(quantity)")} AS total_units_sold,
        {mean("unit_price", 2)} AS avg_selling_price
        FROM pos WHERE total_amount > 0 GROUP BY ALL""",
    "price_dec": "SELECT *, CAST(total_revenue AS DECIMAL(28,4)) AS total_revenue_dec FROM price",
    "f3": f"""SELECT store_id, store_name, store_city, category, total_revenue,
        {_margins("coalesce(erp_cost, 0)")}, total_units_sold, coalesce(total_orders, 0) AS total_orders
        FROM price_dec LEFT JOIN (SELECT store_id, category, round({msum("total_cost")}, 2) AS erp_cost,
            count(DISTINCT order_id) AS total_orders FROM erp GROUP BY ALL) USING (store_id, category)""",
    "f4": f"""SELECT store_id, store_name, store_city, category, total_revenue,
        {_margins("(coalesce(unit, 0) * total_units_sold)")}, total_units_sold,
        coalesce(total_orders, 0) AS total_orders
        FROM price_dec LEFT JOIN (SELECT store_id, category,
            CAST(round(CAST({div(msum("unit_cost"), "count(unit_cost)")} AS DECIMAL(38,9)), 4)
                AS DECIMAL(18,4)) AS unit,
            count(DISTINCT order_id) AS total_orders FROM erp WHERE unit_cost > 0 GROUP BY ALL)
        USING (store_id, category)""",
    "f6": f"""SELECT CAST(event_timestamp AS DATE) AS event_date, store_id, store_name,
        {mean("battery_pct", 2)} AS avg_battery_pct, min(battery_pct) AS min_battery_pct,
        {mean("signal_rssi", 2)} AS avg_signal_rssi FROM iot_events GROUP BY ALL""",
    "f7": f"""SELECT CAST(event_ts AS DATE) AS event_date, store_id, store_name,
        {mean(_sensor("temp_c"), 2)} AS avg_temp_c,
        {rnd(f"max({_sensor('temp_c')})", 2)} AS max_temp_c,
        {mean(_sensor("weight_kg"), 2)} AS avg_weight_kg,
        {mean(_sensor("footfall"), 2)} AS avg_footfall,
        CAST(round({msum(_sensor("footfall"))}, 0) AS BIGINT) AS total_footfall,
        {mean(_sensor("occupancy_pct"), 2)} AS avg_occupancy_pct,
        {mean(_sensor("humidity_pct"), 2)} AS avg_humidity_pct,
        {mean(_sensor("power_kw"), 2)} AS avg_power_kw,
        {mean(_sensor("queue_length"), 2)} AS avg_queue_length,
        {mean(_sensor("voltage"), 2)} AS avg_voltage,
        count(DISTINCT device_id) AS device_count,
        count(DISTINCT CASE WHEN battery_pct < 20 THEN device_id END) AS low_battery_cnt,
        count(DISTINCT event_id) AS event_count FROM readings GROUP BY ALL""",
    "f8": f"""SELECT report_date, f1.store_id, f1.store_name, category, total_revenue, total_txns,
        avg_basket, unique_customers, avg_temp_c, max_temp_c, avg_footfall, total_footfall,
        avg_weight_kg AS avg_shelf_weight, avg_power_kw, avg_queue_length, avg_occupancy_pct,
        device_count, low_battery_cnt, coalesce(avg_temp_c > 25, false) AS is_temp_breach,
        coalesce(avg_weight_kg < 5, false) AS is_low_stock,
        coalesce(avg_occupancy_pct > 80, false) AS is_overcrowded, {_STATUS} AS operational_status
        FROM f1 LEFT JOIN f7 ON f1.store_id = f7.store_id AND report_date = event_date""",
    "calendar": """SELECT CAST(d AS DATE) AS date_key, CAST(isodow(d) AS INTEGER) AS day_of_week,
        left(dayname(d), 3) AS day_name, CAST(day(d) AS INTEGER) AS day_of_month,
        CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
        CAST(month(d) AS INTEGER) AS month_number, left(monthname(d), 3) AS month_name,
        CAST(quarter(d) AS INTEGER) AS quarter, 'q' || quarter(d) AS quarter_name,
        CAST(year(d) AS INTEGER) AS year, isodow(d) IN (6, 7) AS is_weekend,
        strftime(d, '%b-%Y') AS month_year, 'q' || quarter(d) || '-' || year(d) AS quarter_year
        FROM (SELECT unnest(generate_series(min(transaction_date), max(transaction_date),
            INTERVAL 1 DAY)) AS d FROM pos)""",
    "store_days": f"""SELECT store_id, store_name, store_city, store_region, report_date,
        {total("total_revenue")} AS revenue, {big("sum(total_txns)")} AS txns,
        {mean("avg_basket", 2)} AS avg_basket, {big("sum(unique_customers)")} AS customers
        FROM f1 GROUP BY ALL""",
    "line_days": f"""SELECT store_id, store_name, transaction_date,
        {dbl(msum("total_amount"))} AS daily_revenue FROM pos GROUP BY ALL""",
    "margin_store": f"""SELECT store_id, store_name, store_city, {total("total_revenue")} AS total_revenue,
        {total("total_cost")} AS total_cost, {total("gross_profit")} AS total_profit,
        {mean("gross_margin_pct", 1)} AS avg_margin_pct, {big("sum(total_units_sold)")} AS total_units
        FROM f4 GROUP BY ALL""",
    "category_region": f"""SELECT category, store_region, {total("total_revenue")} AS revenue,
        {big("sum(total_units)")} AS units_sold, {big("sum(total_txns)")} AS transactions,
        count(*) AS row_count FROM f1 GROUP BY ALL""",
    "stores": """SELECT DISTINCT store_id, store_name, store_city, store_region, 'turkey' AS country
        FROM pos WHERE store_id IS NOT NULL""",
    "products": """SELECT DISTINCT product_sku, product_name, category, subcategory FROM pos
        WHERE product_sku IS NOT NULL""",
    "suppliers": """SELECT DISTINCT supplier_id, supplier_name, supplier_city FROM erp
        WHERE supplier_id IS NOT NULL""",
    "clean": """SELECT transaction_id, store_id, store_name, store_city, store_region, cashier_id,
        customer_id, transaction_date, transaction_time, product_sku, product_name,
        upper(left(category, 1)) || lower(substr(category, 2)) AS category, subcategory,
        greatest(quantity, 0) AS quantity, greatest(CAST(unit_price AS DOUBLE), 0) AS unit_price,
        coalesce(discount_pct, 0) AS discount_pct, CAST(total_amount AS DOUBLE) AS total_amount,
        upper(trim(payment_method)) AS payment_method, coalesce(loyalty_points, 0) AS loyalty_points
        FROM pos WHERE transaction_id IS NOT NULL AND total_amount > 0""",
    "clean_lines": """SELECT transaction_date, store_id, product_sku, total_amount,
        upper(left(category, 1)) || lower(substr(category, 2)) AS category,
        greatest(quantity, 0) AS quantity
        FROM pos WHERE transaction_id IS NOT NULL AND total_amount > 0""",
    "clean_stock": """SELECT snapshot_date, store_id, warehouse_id, product_sku, category,
        CASE WHEN quantity_on_hand < 0 THEN 0 ELSE quantity_on_hand END AS quantity_on_hand,
        reorder_level, max_stock_level, last_received_date FROM inventory""",
    "months": f"""SELECT year, month_number, month_name, quarter_name, month_year,
        {dbl(msum("total_revenue"))} AS revenue, {big("sum(total_txns)")} AS transactions,
        {big("sum(total_units)")} AS units
        FROM f1 JOIN calendar ON report_date = date_key GROUP BY ALL""",
    "store_name_days": f"""SELECT report_date, store_name, {dbl(msum("total_revenue"))} AS daily_revenue
        FROM f1 GROUP BY ALL""",
    "seed": """SELECT row_number() OVER (ORDER BY store_id) AS store_key, store_id, store_name,
        store_city AS city_name, DATE '1996-01-01' AS effective_date, CAST(NULL AS DATE) AS end_date,
        true AS is_current FROM (SELECT DISTINCT store_id, store_name, store_city FROM pos
        WHERE store_region <> 'EUROPE')""",
    "updates": """SELECT store_id, store_name,
        CASE WHEN store_region = 'ASIA' THEN store_region ELSE store_city END AS store_city FROM stores""",
    "old_stock": "SELECT * FROM inventory WHERE quantity_on_hand < 35",
    "new_stock": "SELECT * FROM clean_stock WHERE quantity_on_hand <> 0",
    "stock_changes": """SELECT n.*, 'INSERT' AS _action, o.store_id IS NOT NULL AS _is_update
        FROM new_stock n LEFT JOIN old_stock o USING (store_id, product_sku)
        WHERE o.store_id IS NULL OR o.quantity_on_hand <> n.quantity_on_hand
        UNION ALL BY NAME
        SELECT o.*, 'DELETE' AS _action, n.store_id IS NOT NULL AS _is_update
        FROM old_stock o LEFT JOIN new_stock n USING (store_id, product_sku)
        WHERE n.store_id IS NULL OR o.quantity_on_hand <> n.quantity_on_hand""",
}


def _with(body: str) -> str:
    """``body`` with the relations it uses, and those these use, defined before it."""
    needed: set[str] = set()
    pending = [body]
    while pending:
        text = pending.pop()
        for name in RELATIONS:
            if name not in needed and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                needed.add(name)
                pending.append(RELATIONS[name])
    if not needed:
        return body
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in RELATIONS.items() if name in needed)
    return f"WITH {ctes}\n{body}"


def _trend(frame: str) -> str:
    previous = "lag(daily_revenue) OVER w"
    step = f"({m('daily_revenue')} - {m(previous)})"
    average = ratio(f"{msum('daily_revenue')} OVER f", "count(daily_revenue) OVER f", 2)
    return f"""SELECT report_date, store_name, daily_revenue, {average} AS revenue_7d_ma,
        {pct(step, previous, 1)} AS day_over_day_pct FROM store_name_days
        WINDOW w AS (PARTITION BY store_name ORDER BY report_date),
        f AS (PARTITION BY store_name ORDER BY report_date {frame})"""


def _vs_mean(columns: str, source: str) -> str:
    mean_of = div(f"{msum('total_revenue')} OVER w", "count(total_revenue) OVER w")
    gap = f"(total_revenue - {mean_of})"
    return f"""SELECT {columns}, {rnd(gap, 2)} AS revenue_vs_store_avg,
        {rnd(f"(100.0::DOUBLE * {gap} / nullif({mean_of}, 0))", 1)} AS revenue_delta_pct
        FROM {source} WINDOW w AS (PARTITION BY store_id)"""


def _margin_by_category(fact: str) -> str:
    return f"""SELECT category, {total("total_revenue")} AS total_revenue,
        {total("total_cost")} AS total_cost, {total("gross_profit")} AS gross_profit,
        {mean("gross_margin_pct", 1)} AS avg_margin_pct FROM {fact} GROUP BY ALL"""


_DEVICE = "store_name, store_id, device_id, event_type, battery_pct, firmware, store_floor"
_TEMP = "event_date, store_name, avg_temp_c, max_temp_c, avg_footfall, low_battery_cnt"

_FANNED = {
    "revenue": msum("p.total_amount"),
    "cost": msum("e.total_cost"),
}
_FAN_PROFIT = f"({_FANNED['revenue']} - {_FANNED['cost']})"


def _scd2(opened: str, changed: str) -> str:
    """Closed and kept rows with the numbered new versions behind them."""
    return f"""SELECT s.store_key, s.store_id, s.store_name, s.city_name, s.effective_date,
        CASE WHEN {changed} THEN DATE '1999-01-01' ELSE s.end_date END AS end_date,
        NOT ({changed}) AS is_current
        FROM seed s LEFT JOIN updates u USING (store_id)
        UNION ALL BY NAME
        SELECT (SELECT max(store_key) FROM seed) + row_number() OVER (ORDER BY u.store_id) AS store_key,
        u.store_id, u.store_name, u.store_city AS city_name, DATE '1999-01-01' AS effective_date,
        CAST(NULL AS DATE) AS end_date, true AS is_current
        FROM updates u LEFT JOIN seed s USING (store_id) WHERE {opened}"""


def _counts(layers: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS layer_table, count(*) AS n_rows FROM {name}"
        for label, name in layers.items()
    )


def _checks(subject: str, rule: str, source: str, failed: str) -> str:
    return f"""SELECT '{subject}' AS subject, '{rule}' AS rule, count(*) AS rows_checked,
        {big(failed)} AS rows_failed FROM {source}"""


_BODIES = {
    "clean_pos": "SELECT * FROM clean",
    "title_case": """SELECT p_partkey,
        array_to_string(list_transform(string_split(p_name, ' '),
            lambda w: upper(w[1]) || lower(w[2:])), ' ') AS product_title,
        upper(p_type[1]) || lower(p_type[2:]) || '-' || upper(p_brand[1]) || lower(p_brand[2:]) AS label
        FROM part""",
    "clamp_min": """SELECT store_id, product_sku, quantity_on_hand,
        greatest(quantity_on_hand, 0) AS clamped,
        CASE WHEN quantity_on_hand <> 0 THEN greatest(quantity_on_hand, 0) END AS clamped_or_null
        FROM inventory""",
    "default_to": """SELECT coalesce(discount_pct, 0) AS discount_pct,
        coalesce(loyalty_points, 0) AS loyalty_points, coalesce(discount_pct > 5, false) AS is_promoted,
        count(*) AS n_lines FROM pos GROUP BY ALL""",
    "normalize_code": """SELECT upper(trim(payment_method)) AS payment_method, count(*) AS n_lines
        FROM pos GROUP BY ALL""",
    "row_filters": f"""SELECT transaction_id, store_id, loyalty_points, {dbl("total_amount")} AS total_amount
        FROM pos WHERE customer_id IS NOT NULL AND loyalty_points IS NOT NULL
        AND total_amount > 1000 AND store_region = 'ASIA'""",
    "clean_inventory": "SELECT * FROM clean_stock",
    "store_q4": f"""SELECT store_name, store_city, store_region, {dbl(msum("revenue"))} AS q4_revenue,
        {big("sum(txns)")} AS q4_txns FROM store_days
        WHERE report_date BETWEEN DATE '1998-10-01' AND DATE '1998-12-31' GROUP BY ALL""",
    "recent_rows": f"""SELECT * REPLACE ({dbl("sensor_value")} AS sensor_value) FROM readings
        WHERE event_ts >= TIMESTAMP '1998-01-15 00:00:00' ORDER BY event_ts DESC, event_id LIMIT 100""",
    "case_bands_margin": f"""SELECT store_id, category, gross_margin_pct,
        {_margin_band(("high", "medium", "low", "loss risk"))} AS margin_band,
        {_margin_band(("High", "Medium", "Low", "Loss Risk"))} AS margin_title FROM f4""",
    "case_bands_battery": f"""SELECT battery_pct, {_battery("critical", "low", "ok")} AS battery_status,
        {_battery("CRITICAL", "LOW", "OK")} AS battery_code, count(*) AS n_events
        FROM iot_events GROUP BY ALL""",
    "operational_status": f"SELECT event_date, store_id, {_STATUS} AS status FROM f7",
    "safe_divide": f"""SELECT store_id, product_sku,
        {ratio("max_stock_level", "quantity_on_hand", 4)} AS cover FROM inventory""",
    "round_decimal": "SELECT product_sku, "
    + ", ".join(
        f"{rnd('CAST(sum(total_amount) AS DOUBLE) / 7', n)} AS round_{n}" for n in (0, 1, 2, 4)
    )
    + " FROM pos GROUP BY ALL",
    "typed_casts": """SELECT event_id, CAST(round(CAST(value AS DECIMAL(18,4)), 0) AS INTEGER) AS value_int,
        CAST(event_id AS DOUBLE) AS id_double, value IS NOT NULL AS has_text, CAST(ts AS DATE) AS event_date,
        TRY_CAST(event_type AS INTEGER) AS not_a_number FROM events""",
    "as_date": """SELECT CAST(ts AS DATE) AS event_date, CAST(left(CAST(ts AS VARCHAR), 10) AS DATE) AS from_text,
        count(*) AS n_events FROM events GROUP BY ALL""",
    "date_parts": """SELECT DISTINCT d, day_of_week, day_name, day_of_month, day_of_year, week_of_year,
        month_number, month_name, quarter, quarter_name, year, is_weekend, month_year, quarter_year,
        CAST(dayofweek(d) AS INTEGER) AS sunday_weekday
        FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) JOIN calendar ON d = date_key""",
    "format_date": """SELECT strftime(o_orderdate, '%Y-%m') AS month_key,
        strftime(o_orderdate, '%b-%Y') AS month_label, count(*) AS n_orders FROM orders GROUP BY ALL""",
    "quarter_label": """SELECT 'Q' || quarter(o_orderdate) AS quarter_name,
        'q' || quarter(o_orderdate) || '-' || year(o_orderdate) AS quarter_year, count(*) AS n_orders
        FROM orders GROUP BY ALL""",
    "shift_date": """SELECT event_id, CAST(ts AS DATE) - 30 AS days_back, ts - INTERVAL 24 HOUR AS hours_back,
        ts - INTERVAL 5 MINUTE AS minutes_back FROM events""",
    "days_between": """SELECT CAST(date_diff('day', order_date, actual_delivery) AS INTEGER) AS days,
        count(*) AS n_lines FROM erp GROUP BY ALL""",
    "weekend_flag": f"""SELECT isodow(transaction_date) IN (6, 7) AS is_weekend,
        {total("total_amount")} AS revenue FROM pos GROUP BY ALL""",
    "iot_events_typed": "SELECT * FROM iot_events",
    "nonempty_arrays": f"""SELECT event_id, {num(_ALERTS_OF)} AS n_alerts FROM readings
        WHERE {_ALERTS_OF} > 0""",
    "distinct_projection": "SELECT DISTINCT sensor_name FROM readings WHERE sensor_name IS NOT NULL",
    "literal_columns": """SELECT n_nationkey, DATE '1996-01-01' AS effective_date,
        CAST(NULL AS DATE) AS end_date, true AS is_current FROM nation""",
    "join_sales_date": "SELECT * FROM months",
    "gross_margin_erp_cost": "SELECT * FROM f3",
    "sales_vs_iot": "SELECT * FROM f8",
    "join_supplier": """SELECT order_id, product_sku, supplier_id, s.supplier_name, s.supplier_city,
        quantity_ordered FROM erp e LEFT JOIN suppliers s USING (supplier_id)""",
    "profit_by_sku_fanout": f"""SELECT p.transaction_date, p.store_id, p.store_name, p.product_sku,
        p.product_name, p.category, {big("sum(p.quantity)")} AS units_sold,
        {dbl(_FANNED["revenue"])} AS revenue, {dbl(_FANNED["cost"])} AS total_cost,
        {dbl(_FAN_PROFIT)} AS gross_profit, {pct(_FAN_PROFIT, _FANNED["revenue"], 2)} AS gross_margin_pct
        FROM pos p JOIN erp e ON p.product_sku = e.product_sku GROUP BY ALL""",
    "profit_by_sku": f"""SELECT transaction_date, store_id, store_name, product_sku, product_name, category,
        units_sold, {dbl("rev")} AS revenue, {dbl("cost")} AS total_cost,
        {dbl("rev - cost")} AS gross_profit, {pct("(rev - cost)", "rev", 2)} AS gross_margin_pct
        FROM (SELECT transaction_date, store_id, store_name, p.product_sku, product_name, p.category,
            {big("sum(quantity)")} AS units_sold, {msum("total_amount")} AS rev,
            sum(per_line) AS cost
            FROM pos p JOIN (SELECT product_sku,
                {m("round(CAST(" + div(msum("total_cost"), "count(*)") + " AS DECIMAL(38,9)), 4)")} AS per_line
                FROM erp GROUP BY ALL) USING (product_sku)
            GROUP BY ALL)""",
    "margin_view_fanout": f"""SELECT p.store_id, p.category, {dbl(_FANNED["revenue"])} AS total_revenue,
        {dbl(_FANNED["cost"])} AS total_cost, {dbl(_FAN_PROFIT)} AS gross_margin,
        {pct(_FAN_PROFIT, _FANNED["revenue"], 2)} AS gross_margin_pct
        FROM pos p JOIN erp e ON p.store_id = e.store_id AND p.category = e.category GROUP BY ALL""",
    "margin_view": f"""SELECT store_id, category, {dbl("rev")} AS total_revenue, {dbl("cost")} AS total_cost,
        {dbl("rev - cost")} AS gross_margin, {pct("(rev - cost)", "rev", 2)} AS gross_margin_pct
        FROM (SELECT store_id, category, {msum("total_amount")} AS rev FROM pos GROUP BY ALL)
        JOIN (SELECT store_id, category, {msum("total_cost")} AS cost FROM erp GROUP BY ALL)
        USING (store_id, category)""",
    "alert_sales_impact": f"""SELECT a.store_id, CAST(triggered_at AS DATE) AS alert_date, alert_type,
        severity, count(*) AS alert_count, {dbl(msum("p.total_amount"))} AS same_day_revenue
        FROM alerts a LEFT JOIN pos p ON a.store_id = p.store_id
        AND CAST(a.triggered_at AS DATE) = p.transaction_date GROUP BY ALL""",
    "alert_sales_impact_once": f"""SELECT store_id, alert_date, alert_type, severity, alert_count,
        {dbl("rev")} AS same_day_revenue
        FROM (SELECT store_id, CAST(triggered_at AS DATE) AS alert_date, alert_type, severity,
            count(*) AS alert_count FROM alerts GROUP BY ALL)
        LEFT JOIN (SELECT store_id, transaction_date AS alert_date, {msum("total_amount")} AS rev
            FROM pos GROUP BY ALL) USING (store_id, alert_date)""",
    "cross_join_range": "SELECT date_key FROM calendar",
    "lateral_flatten": """SELECT event_id, store_id, event_timestamp, alert_type, severity, triggered_at
        FROM alerts""",
    "flatten_object": """SELECT event_id, firmware AS value FROM readings
        UNION ALL SELECT event_id, CAST(battery_pct AS VARCHAR) FROM readings
        UNION ALL SELECT event_id, CAST(signal_rssi AS VARCHAR) FROM readings
        UNION ALL SELECT event_id, CAST(store_floor AS VARCHAR) FROM readings""",
    "scalar_subquery_filter": """SELECT store_id, report_date, revenue FROM store_days
        WHERE report_date >= (SELECT max(report_date) - 30 FROM store_days)""",
    "scalar_subquery_project": """SELECT event_id, CAST(event_ts AS DATE) AS event_date,
        (SELECT max(CAST(event_ts AS DATE)) FROM readings) AS latest_date FROM readings""",
    "count_all": "SELECT count(*) AS n_rows FROM pos",
    "group_sum": f"""SELECT store_id, product_sku, count(*) AS n_lines, {big("sum(quantity)")} AS units,
        {total("total_amount")} AS revenue FROM pos GROUP BY ALL""",
    "count_distinct_multi": """SELECT store_id, category, count(DISTINCT transaction_id) AS txns,
        count(DISTINCT customer_id) AS customers, count(DISTINCT product_sku) AS products
        FROM pos GROUP BY ALL""",
    "conditional_agg": f"""SELECT supplier_id,
        {total("CASE WHEN is_late THEN total_cost END")} AS late_cost,
        max(CASE WHEN is_late THEN lead_time_days END) AS max_late_lead,
        {mean("CASE WHEN NOT is_late THEN lead_time_days END", 2)} AS avg_on_time_lead,
        count(CASE WHEN order_status = 'Delayed' THEN 1 END) AS delayed_lines FROM erp GROUP BY ALL""",
    "distinct_conditional": """SELECT store_id,
        count(DISTINCT CASE WHEN battery_pct < 20 THEN device_id END) AS low_devices
        FROM readings GROUP BY ALL""",
    "store_iot_daily": "SELECT * FROM f7",
    "global_agg": f"""SELECT count(*) AS total_rows, count(DISTINCT store_id) AS stores,
        count(DISTINCT category) AS categories, min(report_date) AS first_date,
        max(report_date) AS last_date, {total("total_revenue")} AS grand_total_revenue FROM f1""",
    "basic_aggregates": f"""SELECT category, {dbl("min(unit_cost)")} AS min_cost,
        {dbl("max(unit_cost)")} AS max_cost, {mean("unit_cost", 4)} AS avg_cost,
        {total("total_cost")} AS sum_cost, count(*) AS n_lines FROM erp GROUP BY ALL""",
    "ratio_of_aggregates": f"""SELECT store_id,
        {ratio(msum("total_amount"), "count(DISTINCT transaction_id)", 2)} AS basket,
        {ratio(msum("total_amount"), "sum(quantity)", 4)} AS revenue_per_unit FROM pos GROUP BY ALL""",
    "group_by_expr": """SELECT CAST(event_ts AS DATE) AS event_date, count(*) AS n_events
        FROM readings GROUP BY 1""",
    "alert_summary": """SELECT store_name, alert_type, severity, count(*) AS alert_count
        FROM alerts GROUP BY ALL""",
    "alert_summary_by_id": """SELECT store_id, alert_type, severity, count(*) AS alert_count
        FROM alerts GROUP BY ALL""",
    "ops_status_impact": f"""SELECT operational_status, count(*) AS store_day_count,
        {mean("total_revenue", 2)} AS avg_revenue, {mean("avg_footfall", 2)} AS avg_footfall,
        {mean("avg_temp_c", 2)} AS avg_temp FROM f8 GROUP BY ALL""",
    "margin_by_category": _margin_by_category("f4"),
    "margin_by_category_erp_cost": _margin_by_category("f3"),
    "revenue_by_category": f"""SELECT *, CAST(rank() OVER (ORDER BY total_revenue DESC NULLS FIRST)
            AS INTEGER) AS revenue_rank
        FROM (SELECT category, {total("total_revenue")} AS total_revenue,
            {big("sum(total_units)")} AS total_units_sold, {big("sum(total_txns)")} AS total_transactions,
            {mean("avg_basket", 2)} AS avg_basket_size FROM f1 GROUP BY ALL)""",
    "rank_in_category": """SELECT store_id, category, gross_margin_pct, CAST(rank() OVER (
        PARTITION BY category ORDER BY gross_margin_pct DESC NULLS FIRST) AS INTEGER) AS rank_in_category
        FROM f4""",
    "revenue_quartile": """SELECT store_id, category, total_revenue, CAST(ntile(4) OVER (
        ORDER BY total_revenue DESC NULLS FIRST, store_id, category) AS INTEGER) AS revenue_quartile
        FROM f4""",
    "pct_of_total": f"""SELECT store_id, category, total_revenue,
        {pct("total_revenue", f"(SELECT {msum('total_revenue')} FROM f4)", 2)} AS pct_of_total_revenue
        FROM f4""",
    "daily_revenue_trend": _trend("ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"),
    "moving_avg_7_days": _trend("RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW"),
    "monthly_growth": f"""SELECT month_year, month_name, quarter_name, {rnd("revenue", 2)} AS monthly_revenue,
        transactions AS monthly_txns, {rnd("lag(revenue) OVER w", 2)} AS prev_month_revenue,
        {pct(f"({m('revenue')} - {m('lag(revenue) OVER w')})", "lag(revenue) OVER w", 1)} AS mom_growth_pct
        FROM months WINDOW w AS (ORDER BY year, month_number)""",
    "iot_vs_revenue": _vs_mean(
        """store_name, report_date, category, total_revenue, total_txns, avg_temp_c, max_temp_c,
        avg_footfall, avg_shelf_weight, operational_status, is_temp_breach, is_low_stock""",
        "(SELECT * FROM f8 WHERE avg_temp_c IS NOT NULL)",
    ),
    "iot_battery_vs_revenue": _vs_mean(
        """store_name, report_date, category, total_revenue, total_txns, avg_battery_pct,
        min_battery_pct, avg_signal_rssi""",
        """(SELECT f1.*, avg_battery_pct, min_battery_pct, avg_signal_rssi
        FROM f1 LEFT JOIN f6 ON f1.store_id = f6.store_id AND report_date = event_date)""",
    ),
    "battery_health": f"""SELECT DISTINCT {_DEVICE}, {_battery("critical", "low", "ok")} AS battery_status,
        CAST(date_diff('day', max(CAST(event_ts AS DATE)) OVER (PARTITION BY device_id),
            (SELECT max(CAST(event_ts AS DATE)) FROM readings)) AS INTEGER) AS days_since_last_seen
        FROM readings WHERE battery_pct < 20""",
    "battery_health_any_reading": f"""SELECT DISTINCT {_DEVICE},
        {_battery("CRITICAL", "LOW", "OK")} AS battery_status, days_since_last_seen
        FROM (SELECT *, CAST(date_diff('day', max(CAST(event_timestamp AS DATE)) OVER (PARTITION BY device_id),
            max(CAST(event_timestamp AS DATE)) OVER ()) AS INTEGER) AS days_since_last_seen FROM iot_events)
        WHERE battery_pct < 20""",
    "row_number_spine": """SELECT d, row_number() OVER (ORDER BY d) AS row_id
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""",
    "ordered_listing": "SELECT * FROM products ORDER BY product_sku, category DESC",
    "top_n": """SELECT * FROM f2 ORDER BY total_revenue_generated DESC NULLS FIRST, report_date, store_id
        LIMIT 20""",
    "layer_listing": f"""SELECT store_region, category, {dbl(msum("total_amount"))} AS total_revenue,
        {big("sum(quantity)")} AS total_units FROM pos GROUP BY ALL""",
    "layer_row_counts": _counts(
        {
            "dim  : dim_store": "stores",
            "dim  : dim_product": "products",
            "dim  : dim_date": "calendar",
            "dim  : dim_supplier": "suppliers",
            "fact : fct_daily_sales": "f1",
            "fact : fct_gross_margin": "f4",
            "fact : fct_store_iot_daily": "f7",
            "fact : fct_sales_vs_iot": "f8",
            "mv   : mv_store_revenue": "store_days",
            "mv   : mv_category_revenue": "category_region",
            "mv   : mv_margin_summary": "margin_store",
        }
    ),
    "merge_upsert_orders": f"""SELECT order_id, coalesce(t.order_date, s.order_date) AS order_date,
        coalesce(t.store_id, s.store_id) AS store_id, coalesce(t.store_city, s.store_city) AS store_city,
        coalesce(t.supplier_id, s.supplier_id) AS supplier_id,
        coalesce(t.supplier_name, s.supplier_name) AS supplier_name,
        coalesce(t.supplier_city, s.supplier_city) AS supplier_city,
        coalesce(t.product_sku, s.product_sku) AS product_sku, coalesce(t.category, s.category) AS category,
        coalesce(t.quantity_ordered, s.quantity_ordered) AS quantity_ordered,
        coalesce(s.quantity_received, t.quantity_received) AS quantity_received,
        {dbl("coalesce(t.unit_cost, s.unit_cost)")} AS unit_cost,
        {dbl("coalesce(t.total_cost, s.total_cost)")} AS total_cost,
        coalesce(s.order_status, t.order_status) AS order_status,
        coalesce(t.expected_delivery, s.expected_delivery) AS expected_delivery,
        coalesce(s.actual_delivery, t.actual_delivery) AS actual_delivery,
        coalesce(t.warehouse_id, s.warehouse_id) AS warehouse_id,
        coalesce(t.lead_time_days, s.lead_time_days) AS lead_time_days,
        coalesce(s.is_late, t.is_late) AS is_late,
        CASE WHEN s.order_status IS NULL THEN TIMESTAMP '2000-01-01' ELSE TIMESTAMP '2001-01-01' END
            AS processed_ts
        FROM (SELECT * FROM latest_lines WHERE order_status = 'Delivered') t
        FULL JOIN (SELECT * FROM latest_lines WHERE order_status = 'Delayed') s USING (order_id)""",
    "scd2_seed": """SELECT row_number() OVER (ORDER BY store_id) AS store_key, store_id, store_name,
        store_city AS city_name, DATE '1996-01-01' AS effective_date, CAST(NULL AS DATE) AS end_date,
        true AS is_current FROM (SELECT DISTINCT store_id, store_name, store_city FROM pos)""",
    "scd2_apply_store": _scd2(
        "s.store_id IS NULL OR s.city_name <> u.store_city", "s.city_name <> u.store_city"
    ),
    "scd2_apply_store_literal": _scd2("s.city_name <> u.store_city", "s.city_name <> u.store_city"),
    "surrogate_key": """SELECT row_number() OVER (ORDER BY product_sku) AS product_key, * FROM products""",
    "standard_stream": "SELECT * FROM stock_changes",
    "insert_action_filter": """SELECT * EXCLUDE (_action, _is_update) FROM stock_changes
        WHERE _action = 'INSERT'""",
    "dim_store": "SELECT * FROM stores",
    "dim_product": "SELECT * FROM products",
    "dim_date_spine": "SELECT * FROM calendar",
    "dim_date_distinct": """SELECT DISTINCT transaction_date AS date_key,
        CAST(day(transaction_date) AS INTEGER) AS day, CAST(month(transaction_date) AS INTEGER) AS month_number,
        left(monthname(transaction_date), 3) AS month_name, CAST(year(transaction_date) AS INTEGER) AS year,
        CAST(quarter(transaction_date) AS INTEGER) AS quarter_number,
        'Q' || quarter(transaction_date) AS quarter_name, strftime(transaction_date, '%Y-%m') AS month_year
        FROM pos""",
    "dim_supplier": "SELECT * FROM suppliers",
    "iot_alerts": "SELECT * FROM alerts",
    "sales_buffer": f"""SELECT transaction_date AS date_key, store_id, product_sku, category,
        count(*) AS total_transactions, {big("sum(quantity)")} AS total_quantity,
        {dbl(msum("total_amount"))} AS total_revenue FROM pos GROUP BY ALL""",
    "fct_daily_sales": "SELECT * FROM f1",
    "fct_daily_sales_staging": "SELECT * FROM f1",
    "daily_sales_report": "SELECT * FROM f2",
    "gross_margin_unit_cost": "SELECT * FROM f4",
    "gross_margin_flat_rate": f"""SELECT store_name, category, {dbl(msum("total_amount"))} AS total_revenue_generated,
        {dbl(f"{msum('total_amount')} * 0.30")} AS gross_profit,
        {rnd(f"100.0::DOUBLE * {div(msum('total_amount') + ' * 0.30', msum('total_amount'))}", 2)} AS gross_margin_pct,
        {big("sum(quantity)")} AS number_of_units_sold,
        count(DISTINCT transaction_id) AS total_unique_orders FROM pos GROUP BY ALL""",
    "store_iot_battery_daily": "SELECT * FROM f6",
    "pos_agg_price": "SELECT * FROM price",
    "store_margin_ranking": f"""SELECT store_name, store_city, category, total_revenue, total_cost,
        gross_profit, gross_margin_pct,
        CAST(rank() OVER (PARTITION BY category ORDER BY gross_margin_pct DESC NULLS FIRST) AS INTEGER)
            AS rank_in_category,
        CAST(ntile(4) OVER (ORDER BY total_revenue DESC NULLS FIRST, store_id, category) AS INTEGER)
            AS revenue_quartile,
        {pct("total_revenue", f"{msum('total_revenue')} OVER ()", 2)} AS pct_of_total_revenue,
        {_margin_band(("high", "medium", "low", "loss risk"))} AS margin_band FROM f4""",
    "supplier_performance": f"""SELECT e.supplier_id, s.supplier_name, s.supplier_city, e.category,
        count(DISTINCT order_id) AS total_orders, {big("sum(quantity_ordered)")} AS total_qty_ordered,
        {big("sum(quantity_received)")} AS total_qty_received,
        {total("total_cost")} AS total_procurement_cost, {mean("lead_time_days", 1)} AS avg_lead_time_days,
        {big("sum(CASE WHEN is_late = false THEN 1 ELSE 0 END)")} AS on_time_deliveries,
        {pct("sum(CASE WHEN is_late = false THEN 1 ELSE 0 END)", "count(DISTINCT order_id)", 1)}
            AS on_time_rate_pct,
        {pct("count(DISTINCT CASE WHEN is_late = false THEN order_id END)", "count(DISTINCT order_id)", 1)}
            AS on_time_order_pct,
        count(CASE WHEN order_status = 'Delayed' THEN 1 END) AS delayed_orders
        FROM erp e LEFT JOIN suppliers s ON e.supplier_id = s.supplier_id
        WHERE order_id IS NOT NULL GROUP BY ALL""",
    "store_last_30d": f"""SELECT store_name, store_city, {dbl(msum("revenue"))} AS revenue_last_30d,
        {big("sum(txns)")} AS txns_last_30d, {big("sum(customers)")} AS customers_last_30d
        FROM store_days WHERE report_date >= (SELECT max(report_date) - 30 FROM f1) GROUP BY ALL""",
    "store_30d_from_today": f"""SELECT store_id, store_name, {dbl(msum("daily_revenue"))} AS revenue_30d
        FROM line_days WHERE transaction_date >= DATE '1998-12-31' - 30 GROUP BY ALL""",
    "category_stores_selling": f"""SELECT category, store_region, {total("total_revenue")} AS revenue,
        {big("sum(total_units)")} AS units_sold, count(DISTINCT store_id) AS stores_selling
        FROM f1 GROUP BY ALL""",
    "temp_breach_days": f"SELECT {_TEMP} FROM f7 WHERE avg_temp_c > 25",
    "temp_days_listing": f"SELECT {_TEMP} FROM f7",
    "margin_store_listing": """SELECT store_name, store_city, total_revenue, total_cost, total_profit,
        avg_margin_pct FROM margin_store""",
    "rollup_store_daily": "SELECT * FROM store_days",
    "rollup_store_daily_lines": "SELECT * FROM line_days",
    "rollup_category_region": "SELECT * FROM category_region",
    "rollup_category_region_lines": f"""SELECT store_region, category,
        {dbl(msum("total_amount"))} AS total_revenue, {big("sum(quantity)")} AS total_units
        FROM pos GROUP BY ALL""",
    "rollup_margin_store": "SELECT * FROM margin_store",
    "rollup_erp_category": f"""SELECT category, {dbl(msum("total_cost"))} AS total_sales
        FROM erp GROUP BY ALL""",
    "quality_summary": " UNION ALL ".join(
        [
            _checks("dim_store", "key", "stores", "count(*) - count(DISTINCT store_id)"),
            _checks("dim_product", "key", "products", "count(*) - count(DISTINCT product_sku)"),
            """SELECT 'dim_date' AS subject, 'continuous' AS rule, CAST(1 AS BIGINT) AS rows_checked,
            CAST(CASE WHEN count(*) = date_diff('day', min(date_key), max(date_key)) + 1 THEN 0 ELSE 1 END
                AS BIGINT) AS rows_failed FROM calendar""",
            f"""SELECT 'daily_sales', 'equals_source', CAST(1 AS BIGINT),
            CAST(CASE WHEN abs({msum("total_revenue")} - (SELECT {msum("total_amount")} FROM pos
                WHERE transaction_id IS NOT NULL AND total_amount > 0)) <= count(*) * 0.005
                THEN 0 ELSE 1 END AS BIGINT) FROM f1""",
            _checks("margin_erp_cost", "profit_positive", "f3", "count(*) FILTER (WHERE NOT gross_profit > 0)"),
            _checks("margin_unit_cost", "profit_positive", "f4", "count(*) FILTER (WHERE NOT gross_profit > 0)"),
            _checks("clean_pos", "quantity_not_negative", "clean", "count(*) FILTER (WHERE NOT quantity >= 0)"),
            _checks("clean_pos", "amount_positive", "clean", "count(*) FILTER (WHERE NOT total_amount > 0)"),
        ]
    ),
}

RELATIONS["latest_lines"] = """SELECT DISTINCT ON (order_id, order_status) * FROM erp
    ORDER BY order_id, order_status, load_ts DESC, product_sku DESC, order_date DESC, store_id DESC,
    store_city DESC, supplier_id DESC, supplier_name DESC, supplier_city DESC, category DESC,
    quantity_ordered DESC, quantity_received DESC, unit_cost DESC, total_cost DESC,
    expected_delivery DESC, actual_delivery DESC, warehouse_id DESC, lead_time_days DESC, is_late DESC"""

# Names under which the same query is registered more than once.
_BODIES["row_generator"] = """SELECT CAST(i AS BIGINT) AS row_id,
    CAST(first + CAST(i AS INTEGER) AS DATE) AS day
    FROM (SELECT min(CAST(o_orderdate AS DATE)) AS first,
                 unnest(range(0, max(CAST(o_orderdate AS DATE)) - min(CAST(o_orderdate AS DATE)) + 1)) AS i
          FROM orders)"""

_SAME = {
    "between_dates": "store_q4",
    "variant_path": "iot_events_typed",
    "join_left_composite": "gross_margin_erp_cost",
    "join_sales_iot": "sales_vs_iot",
    "pivot_sensors": "store_iot_daily",
    "rank_category": "revenue_by_category",
    "moving_avg_7": "daily_revenue_trend",
    "day_over_day": "daily_revenue_trend",
    "month_over_month": "monthly_growth",
    "vs_store_avg": "iot_vs_revenue",
    "device_last_seen": "battery_health",
    "scd_self_lookup": "scd2_apply_store_literal",
}

ORACLES = {name: _with(body) for name, body in _BODIES.items()}
ORACLES.update({name: ORACLES[same] for name, same in _SAME.items()})
ORACLES.update({name: _with(body) for name, body in JOB_ORACLES.items()})
ORACLES["incremental_erp_category"] = ORACLES["rollup_erp_category"]
ORACLES["gold_tables"] = ORACLES["layer_row_counts"]
ORACLES["gold_sales_vs_iot"] = ORACLES["sales_vs_iot"]
ORACLES["scd2_stream"] = ORACLES["scd2_apply_store"]
ORACLES["gold_store_q4"] = ORACLES["store_q4"]
