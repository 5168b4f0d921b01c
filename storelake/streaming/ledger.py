"""One status row per loaded file, and the load history on top of it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from storelake.functions.dates import instant
from storelake.operators.merge import merge_upsert
from storelake.sources.batches import write_batch, write_batch_once
from storelake.streaming.ingest import (
    MAX_FILES,
    REJECTED,
    RUN,
    each_batch,
    known_elsewhere,
    not_known,
    open_files,
    read_files,
    read_runs,
    run_of,
)

PROCESSED = "processed"  # Fixed value: status of a file that has been loaded


def ledger_schema() -> T.StructType:
    return T.StructType(
        [
            T.StructField("table_name", T.StringType()),
            T.StructField("source_file", T.StringType()),
            T.StructField("modified_at", T.TimestampNTZType()),
            T.StructField("rows_loaded", T.LongType()),
            T.StructField("rows_rejected", T.LongType()),
            T.StructField("loaded_at", T.TimestampNTZType()),
            T.StructField("status", T.StringType()),
        ]
    )


def file_ledger(files: DataFrame, ledger: DataFrame | None = None, status: str = PROCESSED) -> DataFrame:
    """Ledger of landing files (``list_files``) after the given ones, by file id."""
    rows = files.select("file_id", "file_name", "modified_at", F.lit(status).alias("status"))
    if ledger is None:
        return rows
    return merge_upsert(
        ledger, rows, ["file_id"], ["file_name", "modified_at", "status"], ["modified_at"]
    )


def new_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that the ledger lacks, or has with another time of change."""
    return files.join(ledger, ["file_id", "modified_at"], "left_anti")


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    return read_runs(spark, root, ledger_schema())


def ingest_with_ledger(
    spark: SparkSession,
    src: str,
    fmt: str,
    schema: T.StructType,
    table_name: str,
    dst: str,
    ledger: str,
    ckpt: str,
    pattern: str | None = None,
    max_files: int | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """New landing files to bronze with a ledger row each, also for files without rows.

    A file is known by its path and its time of change: files in the ledger are skipped
    even when the stream's own checkpoint is lost, and a file that has changed since is
    loaded again. Start such a run under a new checkpoint name. Batches are stored by
    the name of the checkpoint that numbers them, so the new numbers replace nothing.

    Within a run the checkpoint tells files apart. The files of other runs are listed once
    when the stream starts, so what a batch reads does not grow with the ledger. The
    counts come from the stored batch, reading two columns, not from a second pass over
    the files.
    """
    run = run_of(ckpt)
    known = known_elsewhere(spark, ledger, ledger_schema(), run)

    def step(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        fresh = not_known(batch, known).collect()
        paths = sorted(r["source_file"] for r in fresh)
        stored = write_batch_once(
            read_files(session, paths, fmt, schema), f"{dst}/{RUN}={run}", batch_id
        )
        counts = stored.groupBy("source_file").agg(
            F.count_if(~F.col(REJECTED)).alias("loaded"),
            F.count_if(F.col(REJECTED)).alias("rejected"),
        )
        files = session.createDataFrame(fresh, batch.schema)
        rows = files.join(counts, "source_file", "left").select(
            F.lit(table_name).alias("table_name"),
            "source_file",
            "modified_at",
            F.coalesce("loaded", F.lit(0)).alias("rows_loaded"),
            F.coalesce("rejected", F.lit(0)).alias("rows_rejected"),
            F.current_timestamp().cast("timestamp_ntz").alias("loaded_at"),
            F.lit(PROCESSED).alias("status"),
        )
        write_batch(rows, f"{ledger}/{RUN}={run}", batch_id)

    return each_batch(open_files(spark, src, pattern, max_files or MAX_FILES), step, ckpt, interval)


def load_audit(
    ledger: DataFrame, since: dt.datetime | str, until: dt.datetime | str | None = None
) -> DataFrame:
    """Files and rows per table loaded in a window of time."""
    window = F.col("loaded_at") >= instant(since)
    if until is not None:
        window = window & (F.col("loaded_at") <= instant(until))
    return (
        ledger.where(window)
        .groupBy("table_name")
        .agg(
            F.countDistinct("source_file").alias("n_files"),
            F.sum("rows_loaded").alias("rows_loaded"),
            F.sum("rows_rejected").alias("rows_rejected"),
        )
    )
