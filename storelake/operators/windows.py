"""Window operators over daily and monthly aggregates.

The windows partition by store, and their input has one row per store and day
(or per store, day and category), so the calendar bounds the rows of a partition
whatever the volume of raw lines behind a store.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelake.functions.numeric import money, percent, ratio, round_dec


def _exact_avg(col: str, w, digits: int) -> Column:
    return ratio(F.sum(money(col)).over(w), F.count(F.col(col)).over(w), digits)


def moving_avg(
    df: DataFrame, part: str, order: str, col: str, n: int, name: str, by: str = "rows"
) -> DataFrame:
    """Average of the current and the n-1 preceding rows, or calendar days."""
    w = Window.partitionBy(part)
    if by == "rows":
        w = w.orderBy(order).rowsBetween(-(n - 1), 0)
    else:
        w = w.orderBy(F.unix_date(order)).rangeBetween(-(n - 1), 0)
    return df.withColumn(name, _exact_avg(col, w, 2))


def pct_change(
    df: DataFrame, part: list[str], order: list[str], col: str, name: str, digits: int = 1
) -> DataFrame:
    """Change against the preceding row in percent; NULL for the first and after zero."""
    w = Window.partitionBy(*part).orderBy(*order)
    previous = F.lag(col).over(w)
    step = money(col) - money(previous)
    return df.withColumn(name, percent(step, previous, digits))


def vs_group_mean(
    df: DataFrame, part: str, col: str, delta: str, delta_pct: str
) -> DataFrame:
    """Distance of each row from the mean of its group, absolute and in percent.

    Sums and counts combine before the shuffle and are joined back, so the rows of a
    group need not meet in one task. ``df`` is read twice.
    """
    means = df.groupBy(F.col(part).alias("_group")).agg(
        F.try_divide(
            F.sum(money(col)).cast("double"), F.count(F.col(col)).cast("double")
        ).alias("_mean")
    )
    mean = F.col("_mean")
    gap = F.col(col).cast("double") - mean
    return df.join(means, F.col(part).eqNullSafe(F.col("_group"))).select(
        *df.columns,
        round_dec(gap, 2).alias(delta),
        round_dec(F.try_divide(F.lit(100.0) * gap, mean), 1).alias(delta_pct),
    )


def days_since_seen(
    df: DataFrame, device: str, attributes: list[str], ts: str, latest: Column, name: str
) -> DataFrame:
    """Distinct attribute rows with the days from the device's last reading to ``latest``.

    Readings collapse to one row per attribute combination before the window, so
    a device that sends a third of all readings adds only its few combinations.
    """
    seen = df.groupBy(*attributes).agg(F.max(F.col(ts).cast("date")).alias("_seen"))
    last = F.max("_seen").over(Window.partitionBy(device))
    return seen.select(*attributes, F.datediff(latest, last).alias(name))
