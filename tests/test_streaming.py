from __future__ import annotations

import datetime as dt
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from storelake import schemas
from storelake.operators.changes import diff_changes
from storelake.operators.merge import merge_upsert
from storelake.plans import facts
from storelake.plans.facts import sales_buffer
from storelake.sources import batches, buckets, landing
from storelake.streaming import buffer, distinct, ingest, ledger, orders, rollup, stores
from test_landing import BAD, GOOD, GOOD_2, HEADER, write


def finish(query):
    query.awaitTermination()
    return query


def test_ingest_in_several_runs(spark, tmp_path, rows):
    schema = schemas.pos_schema()
    src, dst, ckpt = (str(tmp_path / n) for n in ("src", "bronze", "ckpt"))

    def run():
        return finish(ingest.ingest_stream(spark, src, "csv", schema, dst, ckpt, landing.POS_FILES))

    write(tmp_path / "src/pos_1.csv", HEADER, GOOD, BAD)
    write(tmp_path / "src/other.csv", HEADER, GOOD_2)
    assert ingest.ran(run())
    write(tmp_path / "src/pos_2.csv", HEADER, GOOD_2)
    run()
    assert not ingest.ran(run())

    loaded = ingest.read_bronze(spark, dst, schema)
    assert rows(loaded, "transaction_id") == [("t1",), ("t3",)]
    assert loaded.where("source_file is null or load_ts is null").count() == 0
    assert rows(ingest.read_rejects(spark, dst, schema), landing.CORRUPT) == [(BAD,)]

    silver, silver_ckpt = str(tmp_path / "silver"), str(tmp_path / "silver_ckpt")
    for _ in range(2):
        finish(
            ingest.stream_append(
                spark, dst, ingest.bronze_schema(schema), silver, silver_ckpt, ingest.pos_to_silver
            )
        )
    assert rows(spark.read.parquet(silver), "transaction_id", "category", "payment_method", "discount_pct") == [
        ("t1", "Drinks", "CARD", 0), ("t3", "Food", "CASH", 10),
    ]


@pytest.mark.parametrize("fmt", ["csv", "parquet", "json"])
def test_a_new_checkpoint_neither_doubles_nor_loses_rows(spark, tmp_path, rows, fmt):
    schema = schemas.erp_inventory_schema()
    src, dst = tmp_path / "src", str(tmp_path / "bronze")
    src.mkdir()

    def land(name):
        made = str(tmp_path / f"made {name}")
        df = spark.createDataFrame([(name, 1)], "product_sku string, quantity_on_hand int").coalesce(1)
        if fmt == "json":
            (src / f"{name}.json").write_text(json.dumps([{"product_sku": name}]))
            return
        if fmt == "csv":
            df = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in schema.names])
        df.write.format(fmt).options(header=True).save(made)
        shutil.copy(next((tmp_path / f"made {name}").glob(f"part*.{fmt}")), src / f"{name}.{fmt}")

    def run(ckpt, pattern=None):
        finish(ingest.ingest_stream(spark, str(src), fmt, schema, dst, str(tmp_path / ckpt), pattern, max_files=1))
        got = ingest.read_bronze(spark, dst, schema, fmt)
        return rows(got, "data.product_sku" if fmt == "json" else "product_sku")

    land("x [0]")
    assert run("one") == [("x [0]",)]
    land("x%201")
    assert run("one") == [("x [0]",), ("x%201",)]
    assert run("two") == [("x [0]",), ("x%201",)]  # the same files under a new checkpoint
    for file in src.iterdir():
        file.unlink()
    land("x2")
    assert run("three") == [("x [0]",), ("x%201",), ("x2",)]
    assert ingest.read_rejects(spark, dst, schema, fmt).count() == 0


def test_known_files_are_one_list_per_run(spark, tmp_path, rows):
    """Twenty batches of another run are read once, when a stream starts."""
    root, schema = str(tmp_path / "ledger"), ingest.taken_schema()
    at = dt.datetime(2024, 1, 1, 10, 0, 0, 123000)
    for n in range(20):
        names = spark.createDataFrame([(f"file:/x/{n} [a].csv", at)], schema)
        batches.write_batch(names, f"{root}/run=old", n)
    known = ingest.known_elsewhere(spark, root, schema, "new")
    assert len(spark.read.parquet(known).inputFiles()) <= 8
    batch = spark.createDataFrame(
        [("file:/x/3 [a].csv", at), ("file:/x/3 [a].csv", dt.datetime(2024, 1, 2)), ("file:/x/n.csv", at)], schema
    )
    assert rows(ingest.not_known(batch, known), "source_file") == [("file:/x/3 [a].csv",), ("file:/x/n.csv",)]
    assert ingest.known_elsewhere(spark, root, schema, "old") is None
    assert ingest.not_known(batch, None).count() == 3
    assert ingest.read_runs(spark, root, schema).count() == 20


def test_a_repeated_batch_keeps_its_files(spark, tmp_path):
    root = str(tmp_path / "t")
    first = batches.write_batch_once(spark.range(3), root, 0).inputFiles()
    assert batches.write_batch_once(spark.range(3), root, 0).inputFiles() == first
    assert batches.write_batch_once(spark.range(3), root, 1).count() == 3


def test_backlog_is_taken_in_steps(spark, tmp_path):
    for n in range(3):
        write(tmp_path / f"src/pos_{n}.csv", HEADER, GOOD)
    query = finish(
        ingest.ingest_stream(
            spark, str(tmp_path / "src"), "csv", schemas.pos_schema(), str(tmp_path / "dst"),
            str(tmp_path / "ckpt"), max_files=1,
        )
    )
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert ingest.read_bronze(spark, str(tmp_path / "dst"), schemas.pos_schema()).count() == 3


def test_ledger_skips_known_files_after_a_lost_checkpoint(spark, tmp_path, rows):
    schema = schemas.pos_schema()
    at = {n: str(tmp_path / n) for n in ("src", "bronze", "ledger")}

    def run(ckpt):
        finish(
            ledger.ingest_with_ledger(
                spark, at["src"], "csv", schema, "pos", at["bronze"], at["ledger"],
                str(tmp_path / ckpt), landing.POS_FILES,
            )
        )

    write(tmp_path / "src/pos_1.csv", HEADER, GOOD, BAD)
    run("a")
    write(tmp_path / "src/pos_2.csv", HEADER, GOOD_2, GOOD_2)
    run("b")

    stored = ledger.read_runs(spark, at["bronze"], ingest.bronze_schema(schema))
    assert rows(stored.where("not rejected"), "transaction_id") == [("t1",), ("t3",), ("t3",)]
    entries = ledger.read_ledger(spark, at["ledger"])
    name = F.element_at(F.split("source_file", "/"), -1)
    assert rows(entries, name, "rows_loaded", "rows_rejected", "status") == [
        ("pos_1.csv", 1, 1, "processed"), ("pos_2.csv", 2, 0, "processed"),
    ]
    assert rows(ledger.load_audit(entries, "2000-01-01")) == [("pos", 2, 3, 1)]
    assert ledger.load_audit(entries, "2000-01-01", "2000-01-02").count() == 0


def test_ledger_has_a_row_per_file_and_takes_changed_files(spark, tmp_path, rows):
    schema = schemas.pos_schema()
    at = {n: str(tmp_path / n) for n in ("src", "bronze", "ledger")}

    def run(ckpt):
        finish(
            ledger.ingest_with_ledger(
                spark, at["src"], "csv", schema, "pos", at["bronze"], at["ledger"],
                str(tmp_path / ckpt), landing.POS_FILES,
            )
        )

    write(tmp_path / "src/pos_1.csv", HEADER, GOOD)
    write(tmp_path / "src/pos_header.csv", HEADER)
    run("a")
    name = F.element_at(F.split("source_file", "/"), -1)
    entries = ledger.read_ledger(spark, at["ledger"])
    assert rows(entries, name, "rows_loaded") == [("pos_1.csv", 1), ("pos_header.csv", 0)]
    write(tmp_path / "src/pos_1.csv", HEADER, GOOD, GOOD_2)
    os.utime(tmp_path / "src/pos_1.csv", (2e9, 2e9))
    run("b")
    entries = ledger.read_ledger(spark, at["ledger"])
    assert rows(entries, name, "rows_loaded") == [
        ("pos_1.csv", 1), ("pos_1.csv", 2), ("pos_header.csv", 0),
    ]


def test_parquet_and_json_streams_lose_no_row(spark, tmp_path, rows):
    stock = schemas.erp_inventory_schema()
    src, dst, ckpt = (str(tmp_path / n) for n in ("erp", "bronze", "ckpt"))
    for n, kind in enumerate(("int", "bigint", "double")):
        df = spark.createDataFrame([(f"p{n}", n)], f"product_sku string, QUANTITY_on_hand {kind}") if (
            kind != "double"
        ) else spark.createDataFrame([("p2", 2.0)], "PRODUCT_SKU string, quantity_on_hand double")
        df.coalesce(1).write.parquet(f"{src}/erp_inventory_{n}")
    bad = spark.createDataFrame([("p9", "many"), ("p3", "3")], "product_sku string, quantity_on_hand string")
    bad.coalesce(1).write.parquet(f"{src}/erp_inventory_3")
    (tmp_path / "erp/erp_inventory_4.parquet").write_bytes(b"no parquet")
    finish(ingest.ingest_stream(spark, src, "parquet", stock, dst, ckpt, landing.ERP_INVENTORY_FILES))
    loaded = ingest.read_bronze(spark, dst, stock)
    assert rows(loaded, "product_sku", "quantity_on_hand") == [(f"p{n}", n) for n in range(4)]
    assert ingest.read_rejects(spark, dst, stock).count() == 2  # one row, one whole file

    events = schemas.iot_event_schema()
    src, dst, ckpt = (str(tmp_path / n) for n in ("iot", "iot_bronze", "iot_ckpt"))
    good, odd = '{"event_id": "a"}', '{"event_id": "b", "metadata": {"battery_pct": "low"}}'
    write(tmp_path / "iot/1.json", f"[{good}, {odd}, {good}]")
    write(tmp_path / "iot/2.json", "[]")
    write(tmp_path / "iot/3.json", "no json")
    finish(ingest.ingest_stream(spark, src, "json", events, dst, ckpt))
    assert ingest.read_bronze(spark, dst, events, "json").count() == 2
    lost = ingest.read_rejects(spark, dst, events, "json")
    assert any("low" in r[landing.CORRUPT] for r in lost.collect())


def test_file_ledger_by_listing(spark, tmp_path, rows):
    write(tmp_path / "a.json", "[]")
    first = ledger.file_ledger(landing.list_files(spark, str(tmp_path), landing.JSON_FILES))
    kept = spark.createDataFrame(first.collect(), first.schema)
    write(tmp_path / "b.json", "[]")
    (tmp_path / "empty.json").touch()
    listed = landing.list_files(spark, str(tmp_path), landing.JSON_FILES)
    assert rows(ledger.new_files(listed, kept), "file_name") == [("b.json",)]
    assert rows(ledger.file_ledger(listed, kept), "file_name", "status") == [
        (n, "processed") for n in ("a.json", "b.json")
    ]


ORDER = "order_id string, quantity_ordered int, quantity_received int, order_status string, " \
        "actual_delivery date, is_late boolean, load_ts timestamp_ntz"


def _order(key, ordered, status, day):
    return (key, ordered, 0, status, None, False, dt.datetime(2024, 1, day))


ORDER_BATCHES = [
    [_order("a", 1, "open", 1), _order("a", 1, "held", 2), _order("b", 2, "open", 1)],
    [_order("a", 99, "sent", 3), _order("c", 3, "open", 3), _order(None, 7, "open", 3)],
    [_order("c", 98, "done", 4), _order("b", 97, "sent", 4), _order("d", 4, "open", 4)],
]


def test_orders_stream_equals_merging_batch_by_batch(spark, tmp_path, rows):
    at = {n: str(tmp_path / n) for n in ("bronze", "orders", "ckpt")}
    schema = spark.createDataFrame([], ORDER).schema
    expected = spark.createDataFrame([], schema)
    for data in ORDER_BATCHES:
        batch = spark.createDataFrame(data, schema)
        batch.write.mode("append").parquet(at["bronze"])
        finish(orders.orders_stream(spark, at["bronze"], schema, at["orders"], at["ckpt"], compact_every=2))
        merged = merge_upsert(
            expected, batch, orders.ORDER_KEYS, [*orders.ORDER_UPDATES, "load_ts"], ["load_ts"]
        )
        expected = spark.createDataFrame(merged.collect(), schema)
    assert batches.newest_base(spark, at["orders"] + "/manifest") == 1
    got = orders.read_orders(spark, at["orders"], schema)
    assert rows(got) == rows(expected)
    assert rows(got, "order_id", "quantity_ordered", "order_status") == [
        ("a", 1, "sent"), ("b", 2, "sent"), ("c", 3, "done"), ("d", 4, "open"), (None, 7, "open"),
    ]


def test_a_batch_runs_again_after_a_lost_commit(spark, tmp_path, rows):
    """Every batch compacts; the last one is repeated before and after older files went."""
    at = {n: str(tmp_path / n) for n in ("bronze", "orders", "ckpt")}
    schema = spark.createDataFrame([], ORDER).schema

    def run():
        finish(
            orders.orders_stream(
                spark, at["bronze"], schema, at["orders"], at["ckpt"], compact_every=1
            )
        )

    for n, data in enumerate(ORDER_BATCHES):
        spark.createDataFrame(data, schema).write.mode("append").parquet(at["bronze"])
        run()
        before = rows(orders.read_orders(spark, at["orders"], schema))
        for name in (f"{n}", f".{n}.crc"):
            (tmp_path / "ckpt/commits" / name).unlink(missing_ok=True)
        if n == 1:  # the crash came before the base was whole
            (tmp_path / "orders/manifest/v=1/_SUCCESS").unlink()
        run()
        assert rows(orders.read_orders(spark, at["orders"], schema)) == before
    assert batches.bases(spark, at["orders"] + "/manifest") == [1, 2]
    left = sorted(p.name for p in (tmp_path / "orders/changes").iterdir() if p.is_dir())
    assert left == ["batch=2"]


def test_a_fold_rewrites_touched_buckets_only(spark, tmp_path, rows):
    """Buckets are counted, the base does not move, and older moments can be read."""
    at = {n: str(tmp_path / n) for n in ("bronze", "it's orders", "ckpt")}
    root, schema = at["it's orders"], spark.createDataFrame([], ORDER).schema

    def land(data):
        spark.createDataFrame(data, schema).write.mode("append").parquet(at["bronze"])
        finish(
            orders.orders_stream(
                spark, at["bronze"], schema, root, at["ckpt"], compact_every=1, buckets=16, keep=3
            )
        )

    land([_order(f"o{i}", i, "open", 1) for i in range(400)] + [_order(None, 5, "open", 1)])
    assert buckets.rewritten(spark, root, 0) == list(range(16))
    first = rows(orders.read_orders(spark, root, schema))
    land([_order("o7", 1, "sent", 2), _order("new", 2, "open", 2), _order(None, 6, "open", 2)])
    keys = spark.createDataFrame([("o7",), ("new",)], "order_id string")
    touched = sorted({r.s for r in keys.select(buckets.slot(["order_id"], 16).alias("s")).collect()})
    assert buckets.rewritten(spark, root, 1) == touched and len(touched) < 3
    second = rows(orders.read_orders(spark, root, schema))
    assert len(second) == len(first) + 2 and ("o7", "sent") in rows(
        orders.read_orders(spark, root, schema), "order_id", "order_status"
    )

    spark.createDataFrame([_order("o9", 1, "held", 3)], schema).write.parquet(f"{root}/changes/batch=2")
    merged = orders.read_orders(spark, root, schema)
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    scan = plan[plan.index("Bucketed: true") - 2000 : plan.index("Bucketed: true")]
    assert "Exchange" not in scan.rsplit("SortMergeJoin", 1)[-1].split("+-")[-1]
    assert ("o9", "held") in rows(merged, "order_id", "order_status")

    (a,), (b,) = rows(batches.read_batches(spark, f"{root}/commits", orders.COMMITS), "committed_at")
    assert a < b
    assert rows(orders.read_orders_as_of(spark, root, schema, str(a))) == first
    assert rows(orders.read_orders_as_of(spark, root, schema, str(b))) == second
    assert orders.read_orders_as_of(spark, root, schema, "2000-01-01").count() == 0


def test_changes_between_versions_read_differing_buckets_only(spark, tmp_path, rows):
    root, schema = str(tmp_path / "orders"), spark.createDataFrame([], ORDER).schema
    first = [_order(f"o{i}", i, "open", 1) for i in range(300)]
    same = [_order("o5", 5, "open", 1)]  # its bucket is rewritten with the rows it has
    second = [_order("o7", 1, "sent", 2), _order("new", 2, "open", 2)]
    for n, data in enumerate((first, same, second)):
        orders.store_changes(spark.createDataFrame(data, schema), root, n)
        orders.compact(spark, root, schema, n, buckets=16, keep=5)
    assert len(buckets.rewritten(spark, root, 1)) == 1
    assert buckets.differing(spark, root, 0, 1) == []
    assert buckets.changes_between(spark, root, schema, ["order_id"], 0, 1).count() == 0
    touched = buckets.rewritten(spark, root, 2)
    assert buckets.differing(spark, root, 0, 2) == touched
    found = buckets.changes_between(spark, root, schema, ["order_id"], 0, 2)
    whole = diff_changes(
        *(buckets.read_buckets(spark, root, schema, ["order_id"], v + 1) for v in (0, 2)), ["order_id"]
    )
    assert rows(found) == rows(whole) and found.count() == 3
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_moments_before_the_oldest_base_are_refused(spark, tmp_path):
    root, schema = str(tmp_path / "orders"), spark.createDataFrame([], ORDER).schema
    moments = []
    for n in range(5):
        orders.store_changes(spark.createDataFrame([_order(f"o{n}", n, "open", 1)], schema), root, n)
        orders.compact(spark, root, schema, n, buckets=4)
        commits = batches.read_batches(spark, f"{root}/commits", orders.COMMITS).where(F.col("batch") == n)
        moments.append(str(commits.first()["committed_at"]))
    assert [orders.read_orders_as_of(spark, root, schema, m).count() for m in moments[3:]] == [4, 5]
    with pytest.raises(ValueError, match="folded"):
        orders.read_orders_as_of(spark, root, schema, moments[1])
    live = buckets.read_manifest(spark, root)[2]
    kept = {(fold, s) for fold in range(5) for s in buckets.rewritten(spark, root, fold)}
    older = buckets.read_manifest(spark, root, before=4)[2]
    assert kept == {(f, s) for s, f in [*live.items(), *older.items()]}


def test_unfinished_base_is_not_read(spark, tmp_path):
    root = str(tmp_path / "base")
    batches.write_base(spark.range(3), root, 4)
    (tmp_path / "base" / "v=9").mkdir()
    assert batches.newest_base(spark, root) == 4


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    root, schema = str(tmp_path / "t"), spark.range(1).schema
    for _ in range(2):
        batches.write_batch(spark.range(5), root, 0)
    batches.write_batch(spark.range(2), root, 1)
    assert batches.read_batches(spark, root, schema).count() == 7
    assert batches.read_batches(spark, root, schema, after=0).count() == 2
    assert batches.read_batches(spark, root, schema, before=1).count() == 5
    assert batches.read_batches(spark, str(tmp_path / "none"), schema).count() == 0


def test_folded_batches_can_go(spark, tmp_path):
    root, schema = str(tmp_path / "t"), spark.range(1).schema
    for n in range(12):
        batches.write_batch(spark.range(n + 1), root, n)
    assert batches.drop_batches(spark, root, 9) == 10
    assert batches.read_batches(spark, root, schema).count() == 11 + 12


def _sales(spark, n):
    """A third of the lines belong to one store and day."""
    hot = F.col("id") % 3 == 0
    df = spark.range(n).select(
        F.concat(F.lit("t"), F.col("id") % 400).alias("transaction_id"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("store_id"),
        F.concat(F.lit("u"), F.col("id") % 90).alias("customer_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.when(hot, 0).otherwise((F.col("id") % 5).cast("int"))).alias("transaction_date"),
        (F.col("id") % 6).cast("int").alias("quantity"),
        (F.col("id") * 1.13 + 1).cast("double").alias("total_amount"),
        F.lit("Food").alias("category"),
    )
    for c in schemas.POS_COLUMNS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None))
    fields = schemas.pos_schema().fields
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def test_incremental_rollup_equals_batch(spark, tmp_path, rows):
    at = {n: str(tmp_path / n) for n in ("bronze", "rollup", "ckpt")}
    lines = _sales(spark, 3000)
    keys = ["store_id", "transaction_date"]
    for low in (0, 1, 2, 3):
        lines.where(F.col("quantity") % 4 == low).write.mode("append").parquet(at["bronze"])
        finish(
            rollup.maintain_rollup(
                spark, at["bronze"], lines.schema, keys, at["rollup"], at["ckpt"], compact_every=3
            )
        )
    got = rollup.read_rollup(spark, at["rollup"], lines.schema, keys)
    expected = lines.groupBy(*keys).agg(
        F.round(F.sum(F.col("total_amount").cast("decimal(18,4)")), 2).cast("double"),
        F.sum("quantity"),
        F.count("*"),
    )
    assert rows(got, *keys, "revenue", "units_sold", "n_lines") == rows(expected)
    exact = lines.groupBy(*keys).agg(F.countDistinct("transaction_id").alias("t"))
    worst = got.join(exact, keys).select(F.max(F.abs(F.col("approx_txns") / F.col("t") - 1))).first()[0]
    assert worst < 0.05


def test_buffer_follows_late_lines(spark, tmp_path, rows):
    at = {n: str(tmp_path / n) for n in ("bronze", "silver", "buffer", "ckpt")}
    lines = _sales(spark, 200)
    undated = lines.limit(1).withColumn("transaction_date", F.lit(None).cast("date"))
    late = F.col("quantity") == 5
    drops = [lines.where(~late), lines.where(late), undated, undated]
    for drop in drops:
        drop.write.mode("append").parquet(at["bronze"])
        finish(
            buffer.sales_buffer_stream(
                spark, at["bronze"], lines.schema, at["silver"], at["buffer"], at["ckpt"]
            )
        )
    expected = sales_buffer(lines.unionByName(undated).unionByName(undated))
    got = spark.read.parquet(at["buffer"]).select(*expected.columns)
    assert rows(got) == rows(expected)


def test_a_batch_lists_the_folders_of_its_periods_only(spark, tmp_path, rows):
    """Thirty batches of a day each: what a batch reads does not grow."""
    silver, buffered = str(tmp_path / "silver"), str(tmp_path / "buffer")
    lines = _sales(spark, 6).withColumn("transaction_date", F.lit("2024-01-01").cast("date"))
    read = []
    for n in range(30):
        day = dt.date(2024, 1, 1) + dt.timedelta(days=n)
        batch = lines.withColumn("transaction_date", F.lit(day)).withColumn("period", F.lit(day))
        assert buffer.store_silver(batch, silver, n) == [day]
        if n in (2, 15, 29):
            buffer.refresh_buffer(spark, silver, batch.schema, buffered, [day])
            found = buffer.read_periods(spark, silver, batch.schema, [day])
            read.append((len(found.inputFiles()), found.count()))
    assert len(set(read)) == 1 and read[0][1] == 6
    assert {p.name for p in (tmp_path / "buffer").glob("period=*")} == {
        "period=2024-01-03", "period=2024-01-16", "period=2024-01-30"
    }
    late = lines.withColumn("period", F.lit("2024-01-16").cast("date"))
    undated = lines.limit(1).withColumn("period", F.lit(None).cast("date"))
    periods = buffer.store_silver(late.unionByName(undated), silver, 30)
    assert periods == [dt.date(2024, 1, 16), None]
    assert buffer.store_silver(late.unionByName(undated), silver, 30) == periods  # again
    assert buffer.read_periods(spark, silver, late.schema, periods).count() == 13
    kept = batches.read_batches(spark, f"{silver}/{buffer.TOUCHED}", buffer.TOUCHED_SCHEMA, after=29)
    assert rows(kept, "period") == [(dt.date(2024, 1, 16),), (None,)]


def deliver(spark, path, day_hour, *keys):
    rows = [(k, day_hour) for k in keys]
    df = spark.createDataFrame(rows, "k string, at string").withColumn("load_ts", F.col("at").cast("timestamp_ntz"))
    df.drop("at").write.mode("append").parquet(path)


def test_repeated_rows_within_the_delay_are_taken_once(spark, tmp_path, rows):
    src, dst, ckpt = (str(tmp_path / n) for n in ("src", "dst", "ckpt"))
    schema = "k string, load_ts timestamp_ntz"
    def run():
        return finish(
            distinct.append_distinct(
                spark, src, _parse_datatype_string(schema), dst, ckpt, ["k"], delay="1 hour"
            )
        )

    deliver(spark, src, "2024-01-01 08:00:00", "a", "a", "b", None, None)
    first = run()
    deliver(spark, src, "2024-01-01 08:30:00", "a", "c", None)
    run()
    got = spark.read.parquet(dst)
    assert rows(got, "k") == [("a",), ("b",), ("c",), (None,)]
    assert distinct.late_rows(first) == 0 and distinct.keys_held(first) == 3

    deliver(spark, src, "2024-01-01 12:00:00", "d")  # the watermark goes to 11:00
    assert distinct.keys_held(run()) == 1  # the state of the first two has ended
    deliver(spark, src, "2024-01-01 12:10:00", "a", "d")  # a is forgotten, d is not
    deliver(spark, src, "2024-01-01 10:00:00", "e", "f")  # late
    last = run()
    assert rows(spark.read.parquet(dst), "k") == [("a",), ("a",), ("b",), ("c",), ("d",), (None,)]
    assert distinct.late_rows(last) == 2
    assert not ingest.ran(run())


def test_a_stored_table_belongs_to_one_checkpoint(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.createDataFrame([(1, 2)], "n int, m int").write.parquet(src)
    lines = spark.read.parquet(src).schema
    kind = rollup.Partials(
        lambda df: df.groupBy("n").agg(F.sum("m").alias("m")),
        lambda df: df.groupBy("n").agg(F.sum("m").alias("m")),
    )

    def run(ckpt, root):
        finish(rollup.maintain(spark, src, lines, kind, str(tmp_path / root), str(tmp_path / ckpt)))
        return [tuple(r) for r in rollup.read_merged(spark, str(tmp_path / root), lines, kind).collect()]

    assert run("one", "r1") == [(1, 2)] == run("one", "r1")
    with pytest.raises(ValueError, match="belongs to checkpoint one"):
        run("two", "r1")
    assert run("two", "r2") == [(1, 2)]


def test_margins_follow_either_feed(spark, tmp_path, rows):
    pos = "store_id string, store_name string, store_city string, category string, total_amount double, quantity int"
    erp = "store_id string, category string, unit_cost double, order_id string"
    schemas_of = {"sales": _parse_datatype_string(pos), "costs": _parse_datatype_string(erp)}
    kinds = {"sales": rollup.MARGIN_SALES, "costs": rollup.MARGIN_COSTS}
    landed = {"sales": [], "costs": []}

    def add(name, *new):
        landed[name] += new
        src = str(tmp_path / f"{name}_src")
        spark.createDataFrame(list(new), schemas_of[name]).write.mode("append").parquet(src)
        finish(
            rollup.maintain(
                spark, src, schemas_of[name], kinds[name], str(tmp_path / name),
                str(tmp_path / f"{name}_ckpt"), compact_every=2,
            )
        )

    def check():
        got = rollup.read_margin_fact(
            spark, str(tmp_path / "sales"), schemas_of["sales"], str(tmp_path / "costs"), schemas_of["costs"]
        )
        whole = facts.gross_margin_unit(
            spark.createDataFrame(landed["sales"], pos).withColumn("unit_price", F.lit(1.0)),
            spark.createDataFrame(landed["costs"], erp),
        )
        assert rows(got) == rows(whole.drop("total_orders"))

    add("sales", ("s1", "n", "c", "food", 10.0, 2), ("s1", "n", "c", "food", -1.0, 9), ("s2", "n", "c", "food", 5.5, 1))
    check()
    add("costs", ("s1", "food", 2.25, "o1"), ("s1", "food", 0.0, "o1"), ("s1", "toys", 1.0, "o2"))
    check()
    add("costs", ("s1", "food", 3.0, "o3"), ("s2", "food", 1.3333, "o4"), ("s2", "food", None, "o4"))
    add("sales", ("s1", "n", "c", "toys", 7.0, 3), ("s1", "n", "c", "food", 1.25, 1))
    check()
    add("costs", ("s1", "toys", 2.0, "o5"))
    check()


def test_store_history_from_two_drops(spark, tmp_path, rows):
    schema = "store_id string, store_name string, store_city string, load_ts timestamp_ntz"
    src, root = str(tmp_path / "updates"), str(tmp_path / "stores")

    def run(day, ckpt, *updates):
        at = dt.datetime.fromisoformat(f"{day}T08:00:00")
        given = spark.createDataFrame([(*u, at) for u in updates], schema)
        given.write.mode("append").parquet(src)
        finish(stores.store_history_stream(spark, src, given.schema, root, str(tmp_path / ckpt)))

    run("2024-01-01", "ckpt", ("s1", "A", "X"), ("s2", "B", "Y"))
    run("2024-02-01", "ckpt", ("s1", "A", "Z"), ("s3", "C", "X"))
    assert rows(stores.read_store_history(spark, root), "store_id", "city_name", "is_current") == [
        ("s1", "X", False), ("s1", "Z", True), ("s2", "Y", True), ("s3", "X", True),
    ]
    with pytest.raises(ValueError, match="belongs to checkpoint ckpt"):
        run("2024-03-01", "other", ("s4", "D", "X"))


def test_a_batch_by_flag_is_neither_moved_nor_sorted(spark, tmp_path):
    df = spark.range(0, 4000, 1, 4).withColumn("rejected", F.col("id") % 2 == 1)
    seen = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("flag", "flag")
    try:
        stored = batches.write_batch(df, str(tmp_path / "t"), 0, ["rejected"])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = [seen.getJobInfo(j) for j in seen.getJobIdsForGroup("flag")]
    assert [len(j.stageIds) for j in jobs] == [1]  # no shuffle
    assert stored.where("rejected").count() == stored.where("not rejected").count() == 2000
    for flag in ("true", "false"):
        assert len(list((tmp_path / f"t/batch=0/rejected={flag}").glob("*.parquet"))) == 4
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_state_holds_one_digest_a_key(spark, tmp_path, rows):
    """Keys that join to the same text differ, nulls are equal, and state is not on the heap."""
    schema = "a string, b string, n int, load_ts timestamp_ntz"
    src, at = str(tmp_path / "src"), dt.datetime(2024, 1, 1, 8)
    given = [("x", "1:y", 1), ("x1:", "y", 1), (None, "y", 1), (None, "y", 1), ("", "y", 1), ("x", "1:y", None)]
    spark.createDataFrame([(*g, at) for g in given], schema).write.parquet(src)
    df = spark.read.parquet(src)
    query = finish(
        distinct.append_distinct(spark, src, df.schema, str(tmp_path / "dst"), str(tmp_path / "ckpt"), ["a", "b", "n"])
    )
    assert rows(spark.read.parquet(str(tmp_path / "dst")), "a", "b", "n") == sorted(
        set(given), key=lambda t: tuple((v is None, str(v)) for v in t)
    )
    assert "rocksdbCommitWriteBatchLatency" in str(query.recentProgress) or "rocksdb" in str(query.recentProgress)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert distinct.key_digest(spark.range(1).select(F.lit(0.0).alias("x")), ["x"]) is None
