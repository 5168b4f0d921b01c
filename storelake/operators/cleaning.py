"""Landing to silver."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.functions.dates import instant
from storelake.functions.scalars import clamp_min, default_to, normalize_code, title_case
from storelake.schemas import INVENTORY_COLUMNS, POS_COLUMNS
from storelake.sources.tables import PERIOD


def clean_pos(df: DataFrame) -> DataFrame:
    """Valid sales lines with tidy categories, codes and quantities."""
    cleaned = {
        "category": title_case("category"),
        "quantity": clamp_min("quantity"),
        "unit_price": clamp_min("unit_price"),
        "discount_pct": default_to("discount_pct", 0),
        "payment_method": normalize_code("payment_method"),
        "loyalty_points": default_to("loyalty_points", 0),
    }
    return (
        df.where(F.col("transaction_id").isNotNull() & (F.col("total_amount") > 0))
        .select(*POS_COLUMNS)
        .withColumns(cleaned)
    )


def clean_inventory(df: DataFrame) -> DataFrame:
    return df.select(*INVENTORY_COLUMNS).withColumn(
        "quantity_on_hand", clamp_min("quantity_on_hand")
    )


def stamp(
    df: DataFrame, name: str = "processed_ts", at: dt.datetime | str | None = None
) -> DataFrame:
    """Processing time; injected by tests, the clock otherwise."""
    now = F.current_timestamp().cast("timestamp_ntz") if at is None else instant(at)
    return df.withColumn(name, now)


def between(df: DataFrame, col: str, lo: str, hi: str) -> DataFrame:
    """Closed date range. Of a table stored by period only the periods in range are read."""
    first, last = F.lit(lo).cast("date"), F.lit(hi).cast("date")
    if PERIOD in df.columns:
        # The longest period is a year, so one that holds `lo` starts at most a year before.
        df = df.where(F.col(PERIOD).between(F.trunc(first, "year"), last))
    return df.where(F.col(col).between(first, last))


def recent_rows(
    df: DataFrame, ts: str, at: dt.datetime, minutes: int, n: int, order: list[str]
) -> DataFrame:
    """The newest n rows of the last minutes, for a look at a running feed."""
    since = at - dt.timedelta(minutes=minutes)
    recent = df.where(F.col(ts) >= instant(since))
    return recent.orderBy(F.col(ts).desc(), *order).limit(n)


def since_latest(df: DataFrame, col: str, days: int, of: DataFrame | None = None) -> DataFrame:
    """Rows from the last ``days`` before the latest date of ``of`` (or of ``df``)."""
    latest = (df if of is None else of).select(F.date_sub(F.max(col), days)).scalar()
    return df.where(F.col(col) >= latest)


def with_global_max(df: DataFrame, col: str, name: str) -> DataFrame:
    return df.withColumn(name, df.select(F.max(col)).scalar())


def order_by(df: DataFrame, *columns: str) -> DataFrame:
    """``-name`` sorts descending with NULLs first, ``name`` ascending with NULLs last."""
    return df.orderBy(
        *[
            F.col(c[1:]).desc_nulls_first() if c.startswith("-") else F.col(c).asc_nulls_last()
            for c in columns
        ]
    )


def top_n(df: DataFrame, columns: list[str], n: int) -> DataFrame:
    return order_by(df, *columns).limit(n)


def layer_row_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """One labelled row count per table, ordered by label."""
    out = None
    for label, df in layers.items():
        row = df.agg(F.count("*").alias("n_rows")).select(F.lit(label).alias("layer_table"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out.orderBy("layer_table")
