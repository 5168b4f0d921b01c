"""Keyed merge on plain Parquet relations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.functions.dates import instant

# What an order update may change.
ORDER_KEYS = ["order_id"]
ORDER_UPDATES = ["order_status", "quantity_received", "actual_delivery", "is_late"]


def latest_per_key(df: DataFrame, keys: list[str], latest_by: list[str]) -> DataFrame:
    """One row per key: the greatest by ``latest_by``, then by the other columns.

    ``max`` over a struct combines before the shuffle. A window by key would
    move every version of a hot key into one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in latest_by]
    newest = F.max(F.struct(*latest_by, *rest)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns]
    )


def all_present(keys: list[str]) -> Column:
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return present


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_cols: list[str],
    latest_by: list[str],
    touch: str | None = None,
    at: dt.datetime | str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Target after a merge: matched rows take ``update_cols``, the rest is inserted.

    Rows with a NULL key match nothing; all of them are inserted. ``touch`` names
    a column that gets ``at``, or the clock, on each updated or inserted row.

    ``unique`` promises a source of one row per key, and none without: it need not be grouped.

    Both sides have one row per key, so a shuffle by key has no hot partition, and one
    full outer join does all the work.
    """
    now = F.current_timestamp().cast("timestamp_ntz") if at is None else instant(at)
    columns = target.columns
    data = [c for c in columns if c != touch]
    keyed = source if unique else latest_per_key(source.where(all_present(keys)), keys, latest_by)
    newest = keyed.select(
        *[F.col(c).alias(f"_s_{c}") for c in data], F.lit(True).alias("_in_source")
    )
    on = [F.col(k) == F.col(f"_s_{k}") for k in keys]
    in_source = F.col("_in_source").isNotNull()

    def updated(c: str) -> Column:
        if c == touch:
            return F.when(in_source, now).otherwise(F.col(c)).alias(c)
        if c in update_cols:
            return F.when(in_source, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c)
        return F.col(c)

    def inserted(c: str) -> Column:
        return (now if c == touch else F.col(f"_s_{c}")).alias(c)

    in_target = F.col("_in_target").isNotNull()
    both = target.withColumn("_in_target", F.lit(True)).join(newest, on, "full_outer")
    merged = both.select(
        *[F.when(in_target, updated(c)).otherwise(inserted(c)).alias(c) for c in columns]
    )
    if unique:
        return merged
    unkeyed = source.where(~all_present(keys)).select(*data)
    if touch:
        unkeyed = unkeyed.withColumn(touch, now)
    return merged.unionByName(unkeyed.select(*columns))
