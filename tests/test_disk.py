"""Files that no later step reads do not stay on disk."""

from __future__ import annotations

import datetime as dt
import math
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelake.catalog.jobs import JOBS
from storelake.sources import batches, testbed
from storelake.streaming import distinct

DAYS = [dt.datetime(1997, 5, 1), dt.datetime(1998, 8, 1)]
ROWS = {
    "region": [(0, "ASIA"), (1, "EUROPE")],
    "nation": [(n, f"N{n}", n % 2) for n in range(4)],
    "customer": [(c, f"C{c}", c % 4, 1.0, "S") for c in range(6)],
    "supplier": [(1, "s", 1, 1.0)],
    "part": [(p, f"part {p}", "B", "SMALL TIN", 5, 10.0) for p in range(5)],
    "orders": [(o, o % 6, "O", 9.0, DAYS[o % 2], "1-URGENT") for o in range(40)],
    "lineitem": [
        (o, o % 5, 1, n, 2.0 + n, 100.0 + o, 0.05, 0.0, "N", "O", DAYS[o % 2]) for o in range(40) for n in (1, 2)
    ],
}


@pytest.fixture
def sf_dir(spark, tmp_path):
    for name, given in ROWS.items():
        spark.createDataFrame(given, testbed.TABLES[name]).write.parquet(f"{tmp_path}/sf/{name}.parquet")
    return f"{tmp_path}/sf"


def shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(n).getName().startswith("shuffle_") for n in range(files.size()))


def settled(spark, before: int) -> bool:
    """Whether no more shuffle files than before stay; they go beside the next step."""
    for _ in range(50):
        if shuffle_files(spark) <= before:
            return True
        time.sleep(0.1)
    return False


@pytest.mark.parametrize(("name", "landing_goes"), [("append_only_stream", True), ("load_audit", False)])
def test_csv_drops_are_written_in_turn_from_lines_stored_once(
    spark, monkeypatch, sf_dir, name, landing_goes
):
    """The first drop is loaded before the second is text, and a landed part's rows are gone."""
    folders, bytes_of, places, real_parts, real_land = [], [], [], batches.write_parts, batches.land_files

    def parts(*args):
        before = shuffle_files(spark)
        folders.extend(real_parts(*args))
        assert settled(spark, before)
        return folders

    def land(session, src, dst):
        real_land(session, src, dst)
        places.append(dst)
        bytes_of.append([batches.path_exists(session, f) for f in folders])

    monkeypatch.setattr(batches, "write_parts", parts)
    monkeypatch.setattr(batches, "land_files", land)
    stored = JOBS[name](spark, sf_dir)
    assert bytes_of == [[False, True], [False, False]]
    assert [batches.path_exists(spark, p) for p in places] == [not landing_goes] * 2
    if name == "load_audit":
        assert [tuple(r) for r in stored.collect()] == [("pos_transactions", 0, 80, 0)]
    else:
        assert stored.count() == 80


KEYS = "a double, b float, c string, load_ts timestamp_ntz"


def test_state_of_floating_point_keys_is_a_digest_and_leaves_no_old_versions(spark, tmp_path):
    """Numbers equal in a GROUP BY are one key; the store has 32 bytes a key, not the row."""
    src, dst, ckpt = (str(tmp_path / n) for n in ("src", "dst", "ckpt"))
    nan, at = math.nan, dt.datetime(2024, 1, 1, 8)
    rows = [(0.0, 1.5, "x"), (-0.0, 1.5, "x"), (nan, nan, "x"), (nan, nan, "x"), (None, 0.1, None), (None, 0.1, None), (0.1, 0.1, "x")]
    for n in range(4):
        given = [(*r, at + dt.timedelta(minutes=n)) for r in [*rows, (float(n), 2.0, "new")]]
        spark.createDataFrame(given, KEYS).write.mode("append").parquet(src)
        schema = spark.read.parquet(src).schema
        before = shuffle_files(spark)
        query = distinct.append_distinct(spark, src, schema, dst, ckpt, ["a", "b", "c"])
        query.awaitTermination()
        assert settled(spark, before)
    assert distinct.keys_held(query) == 8
    kept = spark.read.parquet(dst)
    assert kept.count() == kept.select("a", "b", "c").distinct().count() == 8
    state = list((tmp_path / "ckpt/state/0/_metadata/schema").rglob("*")) + list((tmp_path / "ckpt/state/0/0").rglob("schema"))
    assert any(b"_key" in f.read_bytes() for f in state if f.is_file())
    for store in (tmp_path / "ckpt/state/0").iterdir():
        assert len(list(store.glob("*.changelog"))) <= 3  # of more than four versions


def test_floats_as_text_follow_group_by(spark):
    values = [0.0, -0.0, math.nan, math.inf, -math.inf, 0.1, 0.1 + 2**-56, 1e300, None]
    df = spark.createDataFrame([(v,) for v in values], T.StructType([T.StructField("x", T.DoubleType())]))
    texts = distinct._floats_as_text(df, ["x"])
    same = df.groupBy("x").count().count()
    assert df.select(*texts.values()).distinct().count() == same
    assert distinct._floats_as_text(df.select(F.lit(1).alias("x")), ["x"]) == {}
