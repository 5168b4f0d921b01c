"""Writing relations as Parquet tables and reading them back."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelake.functions import dates

PERIOD = "period"  # partition column of dated tables: first day of the period


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    watch: Observation | None = None,
) -> DataFrame:
    """Materialise a query and return the stored table.

    With partition columns, an overwrite replaces only the partitions that occur
    in ``df``. The rebalance hint lets adaptive execution split a partition value
    that holds most of the rows and merge the small ones, so that neither one
    task writes a hot day nor every task writes a file per day.

    ``watch`` gets the number of rows, ``n_rows``, from the tasks that write them, so
    that a stored table need not be read to be counted.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if watch is not None:
        df = df.observe(watch, F.count(F.lit(1)).alias("n_rows"))
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def side_by_side(stores: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Writes of tables that do not need each other, as jobs that share the cluster."""
    with ThreadPoolExecutor(max_workers=max(1, len(stores))) as pool:
        started = {name: pool.submit(write) for name, write in stores.items()}
        return {name: job.result() for name, job in started.items()}


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Columns of ``schema`` by name ignoring case; absent ones take their default."""
    present = {name.lower(): name for name in df.columns}
    defaults = defaults or {}

    def column(field: T.StructField):
        if field.name.lower() in present:
            source = F.col(present[field.name.lower()])
        else:
            value = defaults.get(field.name)
            source = value if not isinstance(value, (str, int, float, bool, type(None))) else F.lit(value)
        return source.cast(field.dataType).alias(field.name)

    return df.select(*[column(field) for field in schema.fields])


def append_table(
    df: DataFrame, path: str, schema: T.StructType, defaults: dict | None = None
) -> DataFrame:
    """Insert with an explicit column list; columns left out take their default."""
    conform(df, schema, defaults).write.mode("append").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def as_of(df: DataFrame, ts_col: str, instant: dt.datetime | str) -> DataFrame:
    """An append-only table as it stood at ``instant``, by its load time."""
    return df.where(F.col(ts_col) <= dates.instant(instant))


def number_rows(spark: SparkSession, n: int, name: str = "row_id") -> DataFrame:
    return spark.range(n).withColumnRenamed("id", name)


def with_literals(df: DataFrame, values: dict) -> DataFrame:
    """Constant columns. A ``(value, type)`` pair gives a typed one, also for NULL."""
    columns = {}
    for name, value in values.items():
        if isinstance(value, tuple):
            columns[name] = F.lit(value[0]).cast(value[1])
        else:
            columns[name] = F.lit(value)
    return df.withColumns(columns)
