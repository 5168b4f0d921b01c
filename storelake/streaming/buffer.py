"""Sales buffer refreshed behind the silver load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from storelake.functions.dates import period_start
from storelake.plans.facts import sales_buffer
from storelake.sources.batches import BATCH, claim, write_batch
from storelake.sources.tables import PERIOD, write_table
from storelake.streaming.ingest import each_batch, pos_to_silver, run_of

#: Beside the rows of silver: the periods that each batch touched.
TOUCHED = "_touched"
TOUCHED_SCHEMA = T.StructType([T.StructField(PERIOD, T.DateType())])


def store_silver(cleaned: DataFrame, silver: str, batch_id: int) -> list[dt.date | None]:
    """Writes a batch into the folders of its periods, and returns these.

    Silver lies by period first, so what a period holds is found without a look at any
    other. A batch that runs again replaces its own folders. The periods, at most the
    days of the calendar, are collected while the rows are written.
    """
    spark, seen = cleaned.sparkSession, Observation(f"periods-{batch_id}")
    numbered = cleaned.withColumn(BATCH, F.lit(batch_id).cast("long")).hint("rebalance", PERIOD)
    observed = numbered.observe(
        seen, F.collect_set(PERIOD).alias("dated"), F.count_if(F.col(PERIOD).isNull()).alias("undated")
    )
    (
        observed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PERIOD, BATCH)
        .parquet(silver)
    )
    periods = sorted(seen.get["dated"]) + ([None] if seen.get["undated"] else [])
    rows = spark.createDataFrame([(p,) for p in periods], TOUCHED_SCHEMA).coalesce(1)
    write_batch(rows, f"{silver}/{TOUCHED}", batch_id)
    return periods


def period_folders(silver: str, periods: list[dt.date | None]) -> list[str]:
    names = ("__HIVE_DEFAULT_PARTITION__" if p is None else p.isoformat() for p in periods)
    return [f"{silver}/{PERIOD}={name}" for name in names]


def read_periods(
    spark: SparkSession, silver: str, schema: T.StructType, periods: list[dt.date | None]
) -> DataFrame:
    """Silver rows of some periods; Spark lists the folders of these only."""
    fields = [f for f in schema if f.name not in (PERIOD, BATCH)]
    placed = T.StructType(
        [*fields, T.StructField(PERIOD, T.DateType()), T.StructField(BATCH, T.LongType())]
    )
    if not periods:
        return spark.createDataFrame([], placed)
    reader = spark.read.schema(placed).option("basePath", silver)
    return reader.parquet(*period_folders(silver, periods))


def refresh_buffer(
    spark: SparkSession,
    silver: str,
    schema: T.StructType,
    buffer: str,
    periods: list[dt.date | None],
    grain: str = "day",
) -> None:
    """Recomputes the buffer of some periods from all their silver rows; others stay."""
    fresh = sales_buffer(read_periods(spark, silver, schema, periods))
    write_table(
        fresh.withColumn(PERIOD, period_start("date_key", grain)), buffer, partition_by=[PERIOD]
    )


def sales_buffer_stream(
    spark: SparkSession,
    src: str,
    schema: T.StructType,
    silver: str,
    buffer: str,
    ckpt: str,
    grain: str = "day",
    max_files: int | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Bronze sales to silver, then the buffer, in one micro-batch.

    Both steps overwrite what they write, so running a batch again gives the same
    tables. Silver is partitioned by period and batch, the buffer by period, and a batch
    lists and reads the periods it touched: its cost does not grow with the batches
    before it.
    """
    claim(spark, silver, run_of(ckpt))
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def step(batch: DataFrame, batch_id: int) -> None:
        cleaned = pos_to_silver(batch).withColumn(PERIOD, period_start("transaction_date", grain))
        periods = store_silver(cleaned, silver, batch_id)
        refresh_buffer(batch.sparkSession, silver, cleaned.schema, buffer, periods, grain)

    return each_batch(reader.parquet(src), step, ckpt, interval)
