"""Rows that are delivered more than once, taken once.

Uploaders deliver a file again after a restart, often under another name, so the file
log cannot tell. Here a stream keeps the keys it has seen for as long as a repetition may
come, and forgets them as event time moves on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from storelake.session import TIDY, settings
from storelake.sources.batches import claim
from storelake.streaming.ingest import run_of, write_stream

# Fixed value: how long after its first arrival a row may come again.
DELAY = "2 hours"
_EVENT = "_event_time"
_KEY = "_key"
#: State on the local disks of the executors, not in their heap; only its changes are stored.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution."
    "streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    # A version is read again if the batch after it runs again; those before may go.
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.ratioExtraSpaceAllowedInCheckpoint": "0",
    **TIDY,
}
#: For a run that ends by itself: a store is tidied and closed by the task that has committed
#: it. Else this waits for a round of maintenance, and the stores of several runs lie on disk.
#: Compacted, it holds no keys that have ended.
CLOSED = {
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.minDeltasForSnapshot": "1",
    "spark.sql.streaming.stateStore.rocksdb.compactOnCommit": "true",
}
#: Types whose values are equal where their texts are.
_PLAIN = (T.IntegralType, T.DecimalType, T.BooleanType, T.DateType, T.TimestampNTZType)


def _as_text(schema: T.StructType, name: str) -> Column | None:
    """A text that two values share only if a GROUP BY takes them for equal; None where
    there is no such text."""
    kind = schema[name].dataType
    plain_string = isinstance(kind, T.StringType) and kind == T.StringType()
    if not plain_string and not isinstance(kind, _PLAIN):
        return None
    return F.col(f"`{name}`").cast("string")


def key_digest(df: DataFrame, keys: list[str]) -> Column | None:
    """SHA-256 of the keys, nulls included, so that state holds 32 bytes a key; None if
    a key is of a type that has no text of its own, as floating point numbers."""
    texts = [_as_text(df.schema, k) for k in keys]
    if any(t is None for t in texts):
        return None
    marked = [F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*marked), 256))


def _floats_as_text(df: DataFrame, keys: list[str]) -> dict[str, Column]:
    """Of keys that are floating point numbers: texts, equal where a GROUP BY takes the
    numbers for equal. So -0.0 is 0.0, and NaN is one value; others differ as texts do."""
    floats = [k for k in keys if isinstance(df.schema[k].dataType, T.FloatType | T.DoubleType)]
    return {
        f"{_KEY}_{k}": F.when(F.col(f"`{k}`") == 0, "0.0").otherwise(F.col(f"`{k}`").cast("string"))
        for k in floats
    }


def first_arrivals(
    rows: DataFrame, keys: list[str], event_time: str = "load_ts", delay: str = DELAY
) -> DataFrame:
    """The first row of each key; repetitions within ``delay`` of it in event time go.

    Keys are equal as in a GROUP BY, so nulls are. State holds one entry per key and
    ends when the watermark, the newest event time less ``delay``, has passed the entry's
    own time plus ``delay``. A row older than the watermark is late: its key may have
    been forgotten, so it is left out, and counted by ``late_rows``. A row without event
    time is late as well.
    """
    timed = rows.withColumn(_EVENT, F.col(event_time).cast("timestamp"))
    texts = _floats_as_text(rows, keys)
    plain = timed.withColumns(texts)
    digest = key_digest(plain, [f"{_KEY}_{k}" if f"{_KEY}_{k}" in texts else k for k in keys])
    if digest is not None:
        timed, keys = plain.withColumn(_KEY, digest).drop(*texts), [_KEY]
    kept = timed.withWatermark(_EVENT, delay).dropDuplicatesWithinWatermark(keys)
    return kept.drop(_EVENT, _KEY)


def append_distinct(
    spark: SparkSession,
    src: str,
    schema: T.StructType,
    dst: str,
    ckpt: str,
    keys: list[str],
    event_time: str = "load_ts",
    delay: str = DELAY,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    max_files: int | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Rows appended to ``src``, without repeated ones, transformed and appended to ``dst``.

    The keys seen belong to the checkpoint, so ``dst`` takes rows of one checkpoint only.
    They are held as digests in RocksDB, out of the executors' heap, in two state stores
    a core: each costs time in every batch, whatever it holds. The checkpoint has the last two
    versions of them, and a run that ends by itself leaves nothing on the executors' disks.
    """
    claim(spark, dst, run_of(ckpt))
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    kept = first_arrivals(reader.parquet(src), keys, event_time, delay)
    stores = str(2 * spark.sparkContext.defaultParallelism)
    # A stream keeps the settings that it starts with, a checkpoint its number of stores.
    kept_by = {**STATE_STORE, **({} if interval else CLOSED)}
    with settings(spark, {**kept_by, "spark.sql.shuffle.partitions": stores}):
        return write_stream(transform(kept), dst, ckpt, interval=interval)


def _operators(query: StreamingQuery) -> list[dict]:
    return [op for p in query.recentProgress for op in p["stateOperators"]]


def late_rows(query: StreamingQuery) -> int:
    """Rows of this run that came after the watermark and were left out."""
    return sum(op["numRowsDroppedByWatermark"] for op in _operators(query))


def keys_held(query: StreamingQuery) -> int:
    """Keys in state after the last batch of this run."""
    operators = _operators(query)
    return operators[-1]["numRowsTotal"] if operators else 0
