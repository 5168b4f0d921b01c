"""What is derived, shuffled or held once only, or in pieces of bounded size."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from storelake.catalog.jobs import JOBS
from storelake.operators.merge import merge_upsert
from storelake.sources import batches, testbed
from storelake.streaming import orders

SF_DIR = Path("/root/testdata/sf0.001")
WITH_TABLES = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables absent")


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@WITH_TABLES
def test_tasks_of_the_line_join_follow_the_bytes(spark, rows, monkeypatch):
    before = rows(testbed.pos(spark, str(SF_DIR)))
    stored = batches.stored_bytes(spark, f"{SF_DIR}/lineitem.parquet")
    monkeypatch.setattr(testbed, "MANY_BYTES", 0)
    monkeypatch.setattr(testbed, "BYTES_A_TASK", stored // 20)
    spread = testbed.pos(spark, str(SF_DIR))
    tasks = -(-stored // (stored // 20))
    assert tasks > 8 and f", {tasks}" in plan(spread).split("RepartitionByExpression")[1].split("\n")[0]
    assert rows(spread) == before


def test_parts_are_stored_in_one_pass(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a"), (7, "b"), (None, "c"), (8, "d")], "n int, s string")
    parts = [F.col("n") < 5, F.col("n") >= 5, F.col("n") > 100]
    folders = batches.write_parts(df.coalesce(1), parts, str(tmp_path / "parts"), "parquet", {})
    for n, folder in enumerate(folders):
        batches.land_files(spark, folder, str(tmp_path / "landed"))
        landed = spark.read.schema(df.schema).parquet(str(tmp_path / "landed"))
        assert rows(landed) == [[(1, "a")], [(1, "a"), (7, "b"), (8, "d")]][min(n, 1)]
    assert len(list((tmp_path / "landed").glob("*.parquet"))) == 3  # one of them without rows


@WITH_TABLES
@pytest.mark.parametrize(
    ("name", "source", "times"),
    [
        ("append_only_stream", "pos", 1),
        ("incremental_ingest", "pos", 1),
        ("chained_refresh", "pos", 1),
        ("ingest_erp_orders", "erp_orders", 1),
        ("incremental_erp_category", "erp_orders", 1),
    ],
)
def test_lines_are_derived_once(spark, monkeypatch, name, source, times):
    derived, real = [], batches.write_parts

    def counted(df, *args):
        derived.append(df)
        return real(df, *args)

    monkeypatch.setattr(batches, "write_parts", counted)
    joins = []
    line_join = testbed._line_with_store
    monkeypatch.setattr(
        testbed, "_line_with_store", lambda *a: joins.append(1) or line_join(*a)
    )
    JOBS[name](spark, str(SF_DIR))
    assert len(joins) == times and len(derived) == (name != "ingest_erp_orders")


def test_a_single_batch_is_not_grouped_again(spark, tmp_path, rows):
    schema = "order_id string, order_status string, quantity_received int, actual_delivery date, is_late boolean, load_ts timestamp_ntz, note string"
    df = spark.createDataFrame([("1", "x", 1, None, False, None, "n"), ("2", "y", 2, None, True, None, "m")], schema)
    batches.write_batch(df, f"{tmp_path}/changes", 0)
    one = orders._keyed(spark, str(tmp_path), df.schema, None, None)
    assert "Aggregate" not in plan(one) and rows(one) == rows(df)
    batches.write_batch(df.limit(1).withColumns({"order_status": F.lit("z"), "note": F.lit("o")}), f"{tmp_path}/changes", 1)
    two = orders._keyed(spark, str(tmp_path), df.schema, None, None)
    assert rows(two, "order_id", "order_status", "note") == [("1", "z", "n"), ("2", "y", "m")]
    merged = merge_upsert(df, df, ["order_id"], ["order_status"], ["load_ts"], unique=True)
    assert "Aggregate" not in plan(merged) and rows(merged) == rows(df)
