"""The store history kept as stored versions behind the feed of store updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from storelake.operators.scd import scd2_apply
from storelake.schemas import store_scd2_schema
from storelake.sources.batches import claim, newest_base, retire, write_base
from storelake.streaming.ingest import each_batch, run_of


def read_store_history(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    """The newest stored version of the dimension, or the newest below ``before``."""
    version = newest_base(spark, f"{root}/base", before)
    if version < 0:
        return spark.createDataFrame([], store_scd2_schema())
    return spark.read.schema(store_scd2_schema()).parquet(f"{root}/base/v={version}")


def store_history_stream(
    spark: SparkSession,
    src: str,
    schema: T.StructType,
    root: str,
    ckpt: str,
    load_ts: str = "load_ts",
    max_files: int | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Store updates appended to ``src`` applied to the dimension under ``root``.

    A batch takes effect on the day of its newest update, and of several updates of a
    store the last one counts. It reads a version older than its own and stores a new
    one, so a batch may run again. The dimension holds a row per store and change, so
    writing it whole is cheap; the last two versions stay.
    """
    claim(spark, root, run_of(ckpt))
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def step(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        day = batch.agg(F.max(F.col(load_ts).cast("date")).alias("day")).first()["day"]
        if day is None:
            return
        dim = read_store_history(session, root, before=batch_id)
        write_base(scd2_apply(dim, batch, day, latest_by=load_ts), f"{root}/base", batch_id)
        retire(session, f"{root}/base", f"{root}/none")

    return each_batch(reader.parquet(src), step, ckpt, interval)
