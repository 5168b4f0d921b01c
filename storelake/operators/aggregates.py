"""Grouped aggregation helpers.

Sums and counts combine before the shuffle. Distinct counts shuffle on the group
key together with the counted value, so a hot group is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.functions.numeric import ColumnOrName, as_col, exact_sum


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def sum_by(df: DataFrame, keys: list[ColumnOrName], measures: dict[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in measures.items()])


def distinct_by(
    df: DataFrame, keys: list[ColumnOrName], cols: dict[str, str], rsd: float | None = None
) -> DataFrame:
    """Distinct values per group. With ``rsd`` an estimate of that relative error."""
    if rsd is None:
        aggs = [F.countDistinct(c).alias(name) for name, c in cols.items()]
    else:
        aggs = [F.approx_count_distinct(c, rsd).alias(name) for name, c in cols.items()]
    return df.groupBy(*keys).agg(*aggs)


def sum_if(cond: Column, col: ColumnOrName) -> Column:
    return exact_sum(F.when(cond, as_col(col)))


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def distinct_if(cond: Column, col: ColumnOrName) -> Column:
    return F.countDistinct(F.when(cond, as_col(col)))


def summary(df: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """One row of checks over the whole relation."""
    return df.agg(*[agg.alias(name) for name, agg in measures.items()])


def distinct_rows(df: DataFrame, cols: list[str], not_null: str | None = None) -> DataFrame:
    if not_null:
        df = df.where(F.col(not_null).isNotNull())
    return df.select(*cols).distinct()
