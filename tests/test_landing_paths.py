"""File names that are patterns to a reader, or look otherwise in a URI."""

from __future__ import annotations

import json
import shutil
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelake import schemas
from storelake.sources import footers, landing

ODD = ["orders[1]", "orders1", "with space", "pct%20", "brace{x,y}", "star*", "mark?", "plus+", "naïve", "back\\slash"]


def odd_parquet(spark, folder, kinds=("int", "bigint")):
    """One file a name, its type changing from name to name."""
    folder.mkdir()
    for i, name in enumerate(ODD):
        made = folder.parent / f"made{i}"
        df = spark.createDataFrame([(name, i)], "order_id string, quantity_ordered int")
        df = df.withColumn("quantity_ordered", F.col("quantity_ordered").cast(kinds[i % len(kinds)]))
        df.coalesce(1).write.parquet(str(made))
        shutil.copy(next(made.glob("*.parquet")), folder / f"{name}.parquet")
    return str(folder)


def jobs_of(spark, fn):
    """Number of Spark jobs that ``fn`` runs."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "")
    fn()
    n = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return n


def test_every_file_once_under_its_own_name(spark, tmp_path, rows):
    src = odd_parquet(spark, tmp_path / "erp_orders")
    df = landing.split_parquet(spark, src, schemas.erp_orders_schema())
    name = F.regexp_extract("source_file", r"([^/]*)\.parquet$", 1)
    assert rows(df, "order_id", name) == sorted((n, n) for n in ODD)
    listed = landing.list_files(spark, src)
    assert listed.join(df, F.col("file_id") == F.col("source_file"), "left_anti").count() == 0


@pytest.mark.parametrize("kinds", [("int",), ("int", "bigint"), ("int", "bigint", "string", "double")])
def test_one_job_whatever_the_mix(spark, tmp_path, kinds):
    src = odd_parquet(spark, tmp_path / "erp_orders", kinds)
    paths = [r.file_id for r in landing.list_files(spark, src).collect()]
    found = []
    assert jobs_of(spark, lambda: found.append(landing.footer_groups(spark, paths))) <= 2
    (groups, unreadable), = found
    assert len(groups) == len(kinds) and unreadable == []
    assert sorted(f for _, files in groups for f in files) == sorted(paths)


def test_csv_and_json_by_literal_name(spark, tmp_path, rows):
    for i, name in enumerate(ODD):
        (tmp_path / f"{name}.csv").write_text(f"product_sku,quantity_on_hand\n{i},{i}\n")
        (tmp_path / f"{name}.json").write_text(json.dumps([{"event_id": name}]))
    schema = T.StructType().add("product_sku", "string").add("quantity_on_hand", "integer")
    name = F.regexp_extract("source_file", r"([^/]*)\.(csv|json)$", 1)
    for i, n in enumerate(ODD):
        got = landing.read_csv_landing(spark, [f"file:{tmp_path}/{n}.csv"], schema, on_error="SPLIT")
        assert rows(got, "product_sku", name) == [(str(i), n)]
        got = landing.split_json(spark, [f"file:{tmp_path}/{n}.json"], schemas.iot_event_schema(), None)
        assert rows(got, "data.event_id", name) == [(n, n)]
    whole = landing.read_csv_landing(spark, str(tmp_path), schema, r".*/(pct%20|with space)\.csv")
    assert rows(whole, name) == [("pct%20",), ("with space",)]


def test_unreadable_files_are_told_apart(spark, tmp_path, rows):
    src = odd_parquet(spark, tmp_path / "erp_orders")
    (tmp_path / "erp_orders" / "bad [x].parquet").write_bytes(b"PAR1 no footer")
    raw = landing.split_parquet_variant(spark, src)
    lost = raw.where(F.col("raw_data").isNull())
    assert rows(lost, landing.CORRUPT, F.regexp_extract("source_file", "[^/]*$", 0)) == [("", "bad [x].parquet")]
    assert raw.where(F.col("raw_data").isNotNull()).count() == len(ODD)
    assert landing.read_parquet_variant(spark, src).count() == len(ODD)
    with pytest.raises(ValueError, match="bad"):
        landing.read_parquet_variant(spark, src, on_error="ABORT")


def test_files_with_columns_named_like_load_metadata(spark, tmp_path, rows):
    df = spark.createDataFrame([("o1", "own", "mine")], "order_id string, LOAD_TS string, source_file string")
    df.write.parquet(str(tmp_path / "erp_orders"))
    got = landing.split_parquet(spark, str(tmp_path), schemas.erp_orders_schema())
    assert rows(got, "order_id", F.col("source_file").contains("erp_orders")) == [("o1", True)]
    raw = landing.read_parquet_variant(spark, str(tmp_path))
    fields = {"a": ("LOAD_TS", "string"), "b": ("source_file", "string")}
    assert rows(landing.project_paths(raw, fields, variant="raw_data")) == [("own", "mine")]


def test_columns_of_foreign_files_equal_sparks_own(spark, tmp_path):
    table = pa.table(
        {
            "a": pa.array([1], pa.int8()), "b": pa.array([1], pa.uint16()), "c": pa.array([1], pa.uint32()),
            "d": pa.array([1], pa.uint64()), "e": pa.array(["x"]).dictionary_encode(),
            "f": pa.array([[1.5]], pa.list_(pa.float32())), "g": pa.array([{"x": 1, "y": "z"}]),
            "h": pa.array([[("k", 1)]], pa.map_(pa.string(), pa.int16())), "i": pa.array([b"x"]),
            "j": pa.array([0], pa.timestamp("us")), "k": pa.array([0], pa.timestamp("ms", "UTC")),
            "l": pa.array([0], pa.date32()), "m": pa.array([True]), "n": pa.array([1], pa.decimal128(9, 2)),
            "o": pa.array([b"abcd"], pa.binary(4)),
        }
    )
    pq.write_table(table, tmp_path / "new.parquet")
    pq.write_table(table.select(["a", "j"]), tmp_path / "old.parquet", use_deprecated_int96_timestamps=True)
    for name in ("new", "old"):
        path = str(tmp_path / f"{name}.parquet")
        with open(path, "rb") as f:
            assert footers.columns_of(f) == footers._nullable(spark.read.parquet(path).schema)
    pq.write_table(pa.table({"t": pa.array([1], pa.time32("ms"))}), tmp_path / "time.parquet")
    with pytest.raises(TypeError), open(tmp_path / "time.parquet", "rb") as f:
        footers.columns_of(f)


def test_stores_that_only_spark_reaches_come_whole(spark, tmp_path, monkeypatch):
    src = odd_parquet(spark, tmp_path / "erp_orders")
    paths = [r.file_id for r in landing.list_files(spark, src).collect()]
    near = footers.shapes(footers.read_footers(spark, paths))
    monkeypatch.setattr(footers, "_reachable", lambda path: False)
    assert footers.shapes(footers.read_footers(spark, paths)) == near
