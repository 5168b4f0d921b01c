"""Data rules checked in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quality_checks(
    df: DataFrame, rules: dict[str, Column] | None = None, unique: dict[str, list[str]] | None = None
) -> DataFrame:
    """One row per rule: rows checked and rows that fail.

    ``rules`` are row conditions, where NULL fails. ``unique`` names key columns;
    each row beyond the first of its key fails. All rules share one aggregate.
    """
    failed = {name: F.count_if(~F.coalesce(ok, F.lit(False))) for name, ok in (rules or {}).items()}
    for name, keys in (unique or {}).items():
        failed[name] = F.count("*") - F.countDistinct(F.struct(*keys))
    counted = df.agg(
        F.count("*").alias("_checked"), *[agg.alias(name) for name, agg in failed.items()]
    )
    entries = F.array(
        *[F.struct(F.lit(n).alias("rule"), F.col(n).cast("bigint").alias("n")) for n in failed]
    )
    return counted.select(F.explode(entries).alias("e"), "_checked").select(
        F.col("e.rule").alias("rule"),
        F.col("_checked").alias("rows_checked"),
        F.col("e.n").alias("rows_failed"),
    )
