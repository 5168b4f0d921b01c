"""Slowly changing store dimension: one row per store and period."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.operators.merge import latest_per_key
from storelake.operators.ordering import add_surrogate_key
from storelake.schemas import store_scd2_schema
from storelake.sources.tables import conform

KEY = "store_id"
# Dimension column -> column of the update feed.
TRACKED = {"store_name": "store_name", "city_name": "store_city"}


def scd2_seed(stores: DataFrame, effective_date: str) -> DataFrame:
    """First load: every distinct store becomes a current row."""
    rows = stores.select(
        KEY, *[F.col(src).alias(c) for c, src in TRACKED.items()]
    ).distinct()
    rows = rows.withColumns(
        {
            "effective_date": F.lit(effective_date).cast("date"),
            "end_date": F.lit(None).cast("date"),
            "is_current": F.lit(True),
        }
    )
    keyed = add_surrogate_key(rows, [KEY, *TRACKED], name="store_key")
    return conform(keyed, store_scd2_schema())


def scd2_apply(
    dim: DataFrame,
    updates: DataFrame,
    as_of: dt.date | str,
    literal: bool = False,
    latest_by: str | None = None,
) -> DataFrame:
    """Dimension after a batch of store updates.

    A current row whose tracked values changed is closed at ``as_of`` and a new
    current version opens; a store not seen before opens its first version.
    Of several updates of a store the last by ``latest_by`` counts, a column of the
    feed such as its load time; without one, or in a tie, the greatest values do.
    Applying a batch twice changes nothing more. A NULL is a value like any other.

    ``literal`` follows the two-statement original instead: a row is closed when any
    update has another city, where a NULL never counts, new stores are ignored, and
    every row closed on that day opens one new version per matching update.
    """
    day = F.lit(as_of).cast("date")
    if literal:
        closed, opened = _literal_steps(dim, updates, day)
    else:
        closed, opened = _steps(dim, updates, day, latest_by)
    top = F.coalesce(dim.select(F.max("store_key")).scalar(), F.lit(0))
    opened = opened.withColumns(
        {
            "effective_date": day,
            "end_date": F.lit(None).cast("date"),
            "is_current": F.lit(True),
        }
    )
    keyed = add_surrogate_key(opened, [KEY, *TRACKED], start=top + 1, name="store_key")
    return closed.unionByName(conform(keyed, store_scd2_schema()))


def _incoming(updates: DataFrame, *more: Column) -> DataFrame:
    new = [F.col(src).alias(f"_new_{c}") for c, src in TRACKED.items()]
    return updates.select(F.col(KEY).alias("_id"), *new, *more)


def _close(dim: DataFrame, changed: Column, day: Column) -> DataFrame:
    return dim.select(
        "store_key", KEY, *TRACKED, "effective_date",
        F.when(changed, day).otherwise(F.col("end_date")).alias("end_date"),
        (F.col("is_current") & ~changed).alias("is_current"),
    )


def _steps(
    dim: DataFrame, updates: DataFrame, day: Column, latest_by: str | None
) -> tuple[DataFrame, DataFrame]:
    when = F.col(latest_by) if latest_by else F.lit(0)
    incoming = _incoming(updates.where(F.col(KEY).isNotNull()), when.alias("_when"))
    incoming = latest_per_key(incoming, ["_id"], ["_when", *[f"_new_{c}" for c in TRACKED]])
    incoming = incoming.drop("_when").withColumn("_sent", F.lit(True))
    matched = (F.col(KEY) == F.col("_id")) & F.col("is_current")
    joined = dim.join(incoming, matched, "left")
    differs = F.lit(False)
    for c in TRACKED:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_new_{c}"))
    changed = F.col("_sent").isNotNull() & differs
    closed = _close(joined, changed, day)

    current = dim.where("is_current").select(F.col(KEY).alias("_have"), *TRACKED)
    same = F.col("_id") == F.col("_have")
    for c in TRACKED:
        same = same & F.col(c).eqNullSafe(F.col(f"_new_{c}"))
    opened = incoming.join(current, same, "left_anti").select(
        F.col("_id").alias(KEY), *[F.col(f"_new_{c}").alias(c) for c in TRACKED]
    )
    return closed, opened


def _literal_steps(dim: DataFrame, updates: DataFrame, day: Column) -> tuple[DataFrame, DataFrame]:
    incoming = _incoming(updates)
    # Least and greatest city tell whether any update differs, at one row per store.
    sent = incoming.where(F.col("_id").isNotNull()).groupBy("_id").agg(
        F.min("_new_city_name").alias("_least"), F.max("_new_city_name").alias("_greatest")
    )
    matched = (F.col(KEY) == F.col("_id")) & F.col("is_current")
    joined = dim.join(sent, matched, "left")
    city = F.col("city_name")
    changed = F.coalesce((city != F.col("_least")) | (city != F.col("_greatest")), F.lit(False))
    closed = _close(joined, changed, day)

    closed_today = closed.where(~F.col("is_current") & (F.col("end_date") == day)).select(
        F.col(KEY).alias("_closed")
    )
    opened = incoming.join(closed_today, F.col("_id") == F.col("_closed")).select(
        F.col("_id").alias(KEY), *[F.col(f"_new_{c}").alias(c) for c in TRACKED]
    )
    return closed, opened
