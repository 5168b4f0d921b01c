"""Purchase orders kept current by keyed merge.

Rewriting the whole table for every micro-batch would cost its size each time. A batch
stores its own newest row per order, and readers merge the stored batches into the base.
Now and then the batches fold into the base, which lies in hash buckets of the key: only
the buckets that hold changed orders are rewritten, and a read does not move the base.

Each batch has a commit time, so the orders can be read as of a moment.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from storelake.operators.merge import (
    ORDER_KEYS,
    ORDER_UPDATES,
    all_present,
    latest_per_key,
    merge_upsert,
)
from storelake.functions.dates import instant
from storelake.sources.batches import (
    BATCH,
    batch_numbers,
    claim,
    read_batches,
    write_batch,
    write_batch_once,
)
from storelake.sources.buckets import (
    read_buckets,
    read_manifest,
    retire_buckets,
    slot,
    write_buckets,
)
from storelake.streaming.ingest import each_batch, run_of

#: Buckets of a new table: several times the cores that read it.
BUCKETS = 64
COMMITS = T.StructType([T.StructField("committed_at", T.TimestampNTZType())])
LATEST_BY = ["load_ts"]


def store_changes(batch: DataFrame, root: str, batch_id: int) -> None:
    """The batch's newest row per order; rows without an order id apart, and its time.

    Rows without a key match nothing, so they need no bucket: any number of them would
    fall into the same one.
    """
    keyed = latest_per_key(batch.where(all_present(ORDER_KEYS)), ORDER_KEYS, LATEST_BY)
    write_batch(keyed, f"{root}/changes", batch_id)
    write_batch(batch.where(~all_present(ORDER_KEYS)), f"{root}/unkeyed", batch_id)
    now = batch.sparkSession.range(1).select(
        F.current_timestamp().cast("timestamp_ntz").alias("committed_at")
    )
    write_batch_once(now, f"{root}/commits", batch_id)


def fold_changes(changes: DataFrame, keys: list[str], update_cols: list[str]) -> DataFrame:
    """One row per key: as its first batch inserted it, updated by its last batch."""
    rest = [c for c in changes.columns if c not in (*keys, BATCH)]
    kept, updated = ([c for c in rest if (c in update_cols) == u] for u in (False, True))
    folded = changes.groupBy(*keys).agg(
        *[F.min_by(F.struct(*kept), BATCH).alias("_first")] * bool(kept),
        *[F.max_by(F.struct(*updated), BATCH).alias("_last")] * bool(updated),
    )
    values = [
        F.col(c) if c in keys else F.col(f"_last.{c}" if c in update_cols else f"_first.{c}").alias(c)
        for c in changes.columns
        if c != BATCH
    ]
    return folded.select(*values)


def read_orders(
    spark: SparkSession, root: str, schema: T.StructType, upto: int | None = None
) -> DataFrame:
    """Orders as of the last stored batch, or of batch ``upto``."""
    before = None if upto is None else upto + 1
    keyed = _keyed(spark, root, schema, before, before)
    unkeyed = read_batches(spark, f"{root}/unkeyed", schema, before=before).drop(BATCH)
    return keyed.unionByName(unkeyed)


def _keyed(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    base_before: int | None,
    before: int | None,
    only: list[int] | None = None,
) -> DataFrame:
    """Orders with a key from the newest base and the batches after it; of some buckets
    if given."""
    version, buckets, _ = read_manifest(spark, root, base_before)
    changes = read_batches(spark, f"{root}/changes", schema, after=version, before=before)
    if only is not None and buckets:
        changes = changes.where(slot(ORDER_KEYS, buckets).isin(only))
    if len(batch_numbers(spark, f"{root}/changes", version, before)) > 1:
        folded = fold_changes(changes, ORDER_KEYS, [*ORDER_UPDATES, *LATEST_BY])
    else:  # a batch holds one row per order
        folded = changes.drop(BATCH)
    base = read_buckets(spark, root, schema, ORDER_KEYS, base_before, only)
    if base is None:
        return folded
    updates = [*ORDER_UPDATES, *LATEST_BY]
    return merge_upsert(base, folded, ORDER_KEYS, updates, LATEST_BY, unique=True)


def batch_as_of(spark: SparkSession, root: str, at: dt.datetime | str) -> int | None:
    """The last batch that was stored by a moment; None if there was none."""
    stored = read_batches(spark, f"{root}/commits", COMMITS)
    return stored.where(F.col("committed_at") <= instant(at)).agg(F.max(BATCH)).first()[0]


def read_orders_as_of(
    spark: SparkSession, root: str, schema: T.StructType, at: dt.datetime | str
) -> DataFrame:
    """Orders as they were stored at a moment, as far back as the oldest base that is kept.

    ValueError where the batches of that moment have been folded away.
    """
    upto = batch_as_of(spark, root, at)
    if upto is None:
        return spark.createDataFrame([], schema)
    version, _, _ = read_manifest(spark, root, before=upto + 1)
    if version < 0 and batch_numbers(spark, f"{root}/changes")[:1] != [0]:
        raise ValueError(f"batch {upto} has been folded into a later base")
    return read_orders(spark, root, schema, upto)


def compact(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    version: int,
    buckets: int = BUCKETS,
    keep: int = 2,
) -> None:
    """Folds the batches up to ``version`` into the buckets that they touch.

    It reads a base older than ``version`` only, and leaves a complete one alone, so a
    batch may run again at any point. ``keep`` bases stay, with the batches that the
    oldest of them needs. The first base sets the number of buckets.
    """
    if read_manifest(spark, root, before=version + 1)[0] == version:
        return
    older, stored, _ = read_manifest(spark, root, before=version)
    buckets = stored or buckets
    changes = read_batches(spark, f"{root}/changes", schema, after=older, before=version + 1)
    touched = sorted(
        r["slot"]
        for r in changes.select(slot(ORDER_KEYS, buckets).alias("slot")).distinct().collect()
    )  # at most one number a bucket
    rows = _keyed(spark, root, schema, version, version + 1, touched)
    write_buckets(rows, root, ORDER_KEYS, buckets, version, touched)
    retire_buckets(spark, root, f"{root}/changes", keep)


def orders_stream(
    spark: SparkSession,
    src: str,
    schema: T.StructType,
    root: str,
    ckpt: str,
    compact_every: int = 50,
    max_files: int | None = None,
    interval: str | None = None,
    buckets: int = BUCKETS,
    keep: int = 2,
) -> StreamingQuery:
    """Order rows appended to ``src`` merged into the orders under ``root``."""
    claim(spark, root, run_of(ckpt))
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def step(batch: DataFrame, batch_id: int) -> None:
        store_changes(batch, root, batch_id)
        if (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, root, schema, batch_id, buckets, keep)

    return each_batch(reader.parquet(src), step, ckpt, interval)
