from __future__ import annotations

import json

from pyspark.sql import functions as F

from storelake import schemas
from storelake.plans import iot
from storelake.sources import landing, tables

HEADER = ",".join(schemas.POS_COLUMNS)
GOOD = 't1,s1,"Main, ""North""",Izmir,West,c1,u1,2024-01-02,10:00:00,p1,Tea,drinks,hot,2,3.5,,7.0,card,1'
BAD = "t2,s1,Main,Izmir,West,c1,u1,2024-01-02,10:00:00,p1,Tea,drinks,hot,two,3.5,0,7.0,card,1"
GOOD_2 = "t3,s2,South,Van,East,c1,,2024-01-03,11:00:00,p2,Jam,food,sweet,1,4,10,3.6,cash,"


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def test_csv_skips_malformed_lines(spark, tmp_path):
    write(tmp_path / "pos_1.csv", HEADER, GOOD, BAD, GOOD_2)
    df = landing.read_csv_landing(spark, str(tmp_path), schemas.pos_schema(), landing.POS_FILES)
    got = {r.transaction_id: r for r in df.collect()}
    assert set(got) == {"t1", "t3"}
    assert got["t1"].store_name == 'Main, "North"'
    assert got["t1"].discount_pct is None and got["t1"].total_amount == 7.0
    assert got["t1"].source_file.endswith("pos_1.csv") and got["t1"].load_ts is not None
    # Whether a line is malformed does not depend on the selected columns.
    assert df.count() == 2
    assert df.select("store_id").distinct().count() == 2


def test_csv_rejects_are_kept_apart(spark, tmp_path):
    write(tmp_path / "pos_1.csv", HEADER, GOOD, BAD, GOOD_2)
    df = landing.read_csv_landing(spark, str(tmp_path), schemas.pos_schema(), on_error="SPLIT")
    loaded, rejected = landing.split_rejects(df)
    assert loaded.count() == 2
    assert [r[landing.CORRUPT] for r in rejected.collect()] == [BAD]


def test_pattern_matches_whole_path(spark, tmp_path):
    write(tmp_path / "pos_1.csv", HEADER, GOOD)
    write(tmp_path / "stock_1.csv", HEADER, GOOD_2)
    write(tmp_path / "pos_1.csv.bak", HEADER, GOOD_2)
    df = landing.read_csv_landing(spark, str(tmp_path), schemas.pos_schema(), landing.POS_FILES)
    assert [r.transaction_id for r in df.collect()] == ["t1"]
    files = landing.list_files(spark, str(tmp_path), landing.POS_FILES)
    assert [r.file_name for r in files.collect()] == ["pos_1.csv"]


def test_positional_columns(spark, tmp_path):
    write(tmp_path / "pos_1.csv", HEADER, GOOD, BAD)
    df = landing.read_csv_positional(spark, str(tmp_path), landing.EXTERNAL_POS)
    assert [(r.transaction_id, r.product_sku, r.total_amount) for r in df.collect()] == [
        ("t1", "p1", 7.0), ("t2", "p1", 7.0),
    ]


def test_parquet_binds_by_name_ignoring_case(spark, tmp_path):
    path = str(tmp_path / "erp_inventory")
    spark.createDataFrame(
        [("p1", 5.0, "2024-01-01", "s1")], "PRODUCT_SKU string, Quantity_On_Hand double, SNAPSHOT_DATE string, extra string"
    ).write.parquet(path)
    (tmp_path / "erp_inventory" / "broken.parquet").write_bytes(b"not a parquet file")
    df = landing.read_parquet_by_name(
        spark, path, schemas.erp_inventory_schema(), landing.ERP_INVENTORY_FILES
    )
    r = df.collect()
    assert len(r) == 1 and df.schema == schemas.erp_inventory_schema()
    assert (r[0].product_sku, r[0].quantity_on_hand, str(r[0].snapshot_date), r[0].store_id) == ("p1", 5, "2024-01-01", None)


def test_parquet_of_two_kinds_lands_in_one_variant(spark, tmp_path, rows):
    spark.createDataFrame([("o1", 5.0)], "order_id string, total_cost double").write.parquet(str(tmp_path / "erp/a"))
    spark.createDataFrame([("p1", 7)], "product_sku string, stock int").write.parquet(str(tmp_path / "erp/b"))
    raw = landing.read_parquet_variant(spark, str(tmp_path / "erp/*"))
    fields = {"order_id": ("order_id", "string"), "stock": ("stock", "int"), "cost": ("total_cost", "double")}
    assert rows(landing.project_paths(raw, fields, variant="raw_data")) == [("o1", None, 5.0), (None, 7, None)]


def test_uniform_parquet_needs_no_footers(spark, tmp_path, rows):
    path, schema = str(tmp_path / "erp_inventory"), schemas.erp_inventory_schema()
    df = spark.createDataFrame([("p1", 5)], "PRODUCT_SKU string, Quantity_On_Hand int")
    df.write.parquet(path)
    got = landing.read_parquet_by_name(spark, path, schema, uniform=True)
    assert rows(got, "product_sku", "quantity_on_hand", "store_id") == [("p1", 5, None)]


EVENTS = [
    {"event_id": "e1", "event_type": "error", "store_id": "s1", "store_name": "Main",
     "timestamp": "2024-01-01T10:00:00", "device_id": "d1",
     "metadata": {"firmware": "v1", "battery_pct": 9, "signal_rssi": -40, "store_floor": 1},
     "alerts": [
         {"alert_type": "temperature", "severity": "high", "triggered_at": "2024-01-01T10:01:00"},
         {"alert_type": "door", "severity": "low", "triggered_at": "2024-01-01T10:02:00"}]},
    {"event_id": "e2", "event_type": "error", "store_id": "s1", "alerts": []},
    {"event_id": "e3", "event_type": "view", "store_id": "s2"},
]


def test_json_arrays_become_rows(spark, tmp_path, rows):
    (tmp_path / "events_1.json").write_text(json.dumps(EVENTS, indent=1))
    (tmp_path / "events_2.json").write_text(json.dumps(EVENTS[2:]))
    (tmp_path / "notes.txt").write_text(json.dumps(EVENTS))
    as_struct = landing.read_json_landing(spark, str(tmp_path), schemas.iot_event_schema())
    as_variant = landing.read_json_variant(spark, str(tmp_path))
    for raw in (as_struct, as_variant):
        assert rows(iot.iot_events(raw), "event_id", "battery_pct", "store_floor") == [
            ("e1", 9, 1), ("e2", None, None), ("e3", None, None), ("e3", None, None),
        ]
        alerts = iot.iot_alerts(raw)
        assert rows(alerts, "event_id", "alert_type", F.col("triggered_at").cast("string")) == [
            ("e1", "door", "2024-01-01 10:02:00"), ("e1", "temperature", "2024-01-01 10:01:00"),
        ]


def test_object_fields_become_rows(spark, rows):
    df = spark.range(1).select(F.parse_json(F.lit('{"a": 1, "b": "x", "c": null}')).alias("v"))
    out = iot.explode_object(df, "v").select(F.col("value").cast("string"))
    assert rows(out) == [("1",), ("x",), (None,)]


def test_append_uses_defaults(spark, tmp_path, rows):
    path, schema = str(tmp_path / "t"), schemas.erp_inventory_schema()
    first = spark.createDataFrame([("p1", 3)], "product_sku string, quantity_on_hand int")
    tables.append_table(first, path, schema)
    out = tables.append_table(first, path, schema, {"reorder_level": 7})
    assert rows(out, "product_sku", "quantity_on_hand", "reorder_level") == [("p1", 3, 7), ("p1", 3, None)]


def test_overwrite_replaces_only_touched_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "fact")
    old = spark.createDataFrame([("a", 1), ("b", 1)], "k string, n int")
    tables.write_table(old, path, partition_by=["k"])
    new = spark.createDataFrame([("b", 2)], "k string, n int")
    assert rows(tables.write_table(new, path, partition_by=["k"]), "k", "n") == [("a", 1), ("b", 2)]


def test_as_of(spark, rows):
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, "2024-01-01 10:01:00")], "n int, t string")
    df = df.withColumn("load_ts", F.col("t").cast("timestamp_ntz"))
    assert rows(tables.as_of(df, "load_ts", "2024-01-01 10:00:30"), "n") == [(1,)]


def test_number_rows(spark, rows):
    assert rows(tables.number_rows(spark, 3)) == [(0,), (1,), (2,)]
