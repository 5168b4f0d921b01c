"""Continuous loading: landing files to bronze, bronze to silver.

The checkpoint of a stream records which files it has taken, so a restart goes on
where the last run ended, and a run without new files does nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from storelake.operators.cleaning import clean_inventory, clean_pos, stamp
from storelake.sources.batches import (
    BATCH,
    names_in,
    path_exists,
    write_batch,
    write_batch_once,
)
from storelake.sources.landing import (
    CORRUPT,
    read_csv_landing,
    split_json,
    split_parquet,
    with_corrupt_column,
)

REJECTED = "rejected"
RUN = "run"
#: Beside the rows of a bronze table: the names of the files that each batch took.
TAKEN = "_taken"
# Fixed value: how often the feeds are picked up when a job keeps running.
INTERVAL = "5 minutes"
#: Files of one micro-batch at most, where a stream carries file names.
MAX_FILES = 1000


def bronze_schema(schema: T.StructType, fmt: str = "csv") -> T.StructType:
    """What a landing stream stores: the row, load metadata, and the reject flag.

    JSON elements are kept as one struct ``data``, other rows as columns.
    """
    if fmt == "json":
        schema = T.StructType([T.StructField("data", schema)])
    return T.StructType(
        [
            *with_corrupt_column(schema).fields,
            T.StructField("load_ts", T.TimestampNTZType()),
            T.StructField("source_file", T.StringType()),
            T.StructField(REJECTED, T.BooleanType()),
        ]
    )


def open_files(
    spark: SparkSession, src: str, pattern: str | None = None, max_files: int = MAX_FILES
) -> DataFrame:
    """Stream of new landing files: source_file, modified_at, file_bytes. Contents stay closed.

    Files of different types need different readers, which one streaming reader cannot
    have, and a sink that counts batches by itself would pass over those of a new
    checkpoint. So the stream carries names, and ``read_files`` opens those of a micro-batch;
    ``max_files`` bounds how many that are.
    """
    reader = spark.readStream.format("binaryFile").option("recursiveFileLookup", "true")
    reader = reader.option("maxFilesPerTrigger", max_files).schema(
        "path string, modificationTime timestamp, length long, content binary"
    )
    files = reader.load(src).select(
        F.col("path").alias("source_file"),
        F.col("modificationTime").cast("timestamp_ntz").alias("modified_at"),
        F.col("length").alias("file_bytes"),
    )
    return files.where(F.col("source_file").rlike(f"^(?:{pattern})$")) if pattern else files


def read_files(spark: SparkSession, paths: list[str], fmt: str, schema: T.StructType) -> DataFrame:
    """Rows of the files in the columns of ``bronze_schema``: every row, loaded or rejected."""
    stored = bronze_schema(schema, fmt)
    if not paths:
        return spark.createDataFrame([], stored)
    if fmt == "csv":
        df = read_csv_landing(spark, paths, schema, on_error="SPLIT")
    elif fmt == "json":
        df = split_json(spark, paths, schema, None)
    else:
        df = split_parquet(spark, paths, schema)
    return df.withColumn(REJECTED, F.col(CORRUPT).isNotNull()).select(*stored.names)


def write_stream(
    df: DataFrame,
    dst: str,
    ckpt: str,
    partition_by: list[str] | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Appends to a Parquet table, each row once. Without an interval: all there is, then stop."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ckpt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _trigger(writer, interval).start(dst)


def each_batch(
    df: DataFrame,
    step: Callable[[DataFrame, int], None],
    ckpt: str,
    interval: str | None = None,
) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(step).option("checkpointLocation", ckpt)
    return _trigger(writer, interval).start()


def _trigger(writer, interval: str | None):
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)


def run_of(ckpt: str) -> str:
    """The name of a checkpoint, under which its batches are stored."""
    return ckpt.rstrip("/").rsplit("/", 1)[-1]


def read_runs(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Rows of all batches of all runs, with ``run`` and ``batch``."""
    placed = T.StructType(
        [*schema.fields, T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType())]
    )
    if not path_exists(spark, root):
        return spark.createDataFrame([], placed)
    return spark.read.schema(placed).parquet(root)


def file_digest() -> Column:
    """One key for a file as it was at its time of change."""
    return F.md5(F.concat_ws("|", F.col("modified_at").cast("string"), "source_file")).alias("digest")


def known_elsewhere(
    spark: SparkSession, root: str, schema: T.StructType, run: str
) -> str | None:
    """Stores the digests of all files that other runs have booked under ``root``; None if
    there is no other run.

    A stream does this when it starts, and its batches read the one stored list: what
    they read does not grow with the batches of any run. Runs that share a root must not
    run at the same time.
    """
    if not any(name.startswith(f"{RUN}=") and name != f"{RUN}={run}" for name in names_in(spark, root)):
        return None
    path = f"{root}/_known/{RUN}={run}"
    booked = read_runs(spark, root, schema).where(F.col(RUN) != run)
    booked.select(file_digest()).distinct().write.mode("overwrite").parquet(path)
    return path


def not_known(files: DataFrame, known: str | None) -> DataFrame:
    """The files that are not in a list of ``known_elsewhere``."""
    if known is None:
        return files
    listed = files.sparkSession.read.schema("digest string").parquet(known)
    return files.withColumn("digest", file_digest()).join(listed, "digest", "left_anti").drop("digest")


def taken_schema() -> T.StructType:
    return T.StructType(
        [
            T.StructField("source_file", T.StringType()),
            T.StructField("modified_at", T.TimestampNTZType()),
        ]
    )


def ingest_stream(
    spark: SparkSession,
    src: str,
    fmt: str,
    schema: T.StructType,
    dst: str,
    ckpt: str,
    pattern: str | None = None,
    max_files: int | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """New landing files to bronze; what cannot be loaded goes to its own partition.

    Files are read by micro-batch. A batch is stored by the name of the checkpoint that
    numbers it, so the batches of a new checkpoint replace nothing; and files that
    another run took, by path and time of change, are not taken again. A batch that
    runs again keeps what it has stored.
    """
    run = run_of(ckpt)
    known = known_elsewhere(spark, f"{dst}/{TAKEN}", taken_schema(), run)

    def step(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        fresh = not_known(batch.select("source_file", "modified_at"), known).collect()
        rows = read_files(session, sorted(r["source_file"] for r in fresh), fmt, schema)
        write_batch_once(rows, f"{dst}/{RUN}={run}", batch_id, [REJECTED])
        names = session.createDataFrame(fresh, taken_schema()).coalesce(1)
        write_batch(names, f"{dst}/{TAKEN}/{RUN}={run}", batch_id)

    files = open_files(spark, src, pattern, max_files or MAX_FILES)
    return each_batch(files, step, ckpt, interval)


def read_bronze(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv"
) -> DataFrame:
    """Loaded rows of a bronze table; the files of rejects are not opened."""
    stored = bronze_schema(schema, fmt)
    df = spark.read.schema(stored).parquet(path).select(*stored.names)
    return df.where(~F.col(REJECTED)).drop(CORRUPT, REJECTED)


def read_rejects(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv"
) -> DataFrame:
    df = spark.read.schema(bronze_schema(schema, fmt)).parquet(path)
    return df.where(REJECTED).select(CORRUPT, "load_ts", "source_file")


def stream_append(
    spark: SparkSession,
    src: str,
    schema: T.StructType,
    dst: str,
    ckpt: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    max_files: int | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Rows appended to a Parquet table since the last run, transformed and appended."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return write_stream(transform(reader.parquet(src)), dst, ckpt, interval=interval)


# Transforms of the silver streams.


def pos_to_silver(df: DataFrame) -> DataFrame:
    if REJECTED in df.columns:
        df = df.where(~F.col(REJECTED))
    return stamp(clean_pos(df))


def inventory_to_silver(df: DataFrame) -> DataFrame:
    return stamp(clean_inventory(df))


def iot_to_silver(df: DataFrame) -> DataFrame:
    return stamp(df.select("data"))


def ran(query: StreamingQuery) -> bool:
    """Whether a finished run found new data."""
    return any(p["numInputRows"] > 0 for p in query.recentProgress)
