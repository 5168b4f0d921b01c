"""Exact money arithmetic, guarded division and rounding.

Sums run over ``decimal(18,4)``, so they do not depend on the order in which
partitions arrive, and a total over any number of rows stays exact.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"
# A quotient is snapped to nine decimals before it is rounded, so that a value
# such as x.xx5, which a double cannot hold exactly, rounds away from zero.
SNAP = "decimal(38,9)"

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: ColumnOrName) -> Column:
    return as_col(c).cast(MONEY)


def exact_sum(c: ColumnOrName) -> Column:
    return F.sum(money(c))


def round_dec(c: ColumnOrName, n: int) -> Column:
    """Half-up rounding in decimal, handed back as a double."""
    return F.round(as_col(c).cast(SNAP), n).cast("double")


def sum_rounded(c: ColumnOrName, n: int = 2) -> Column:
    return round_dec(exact_sum(c), n)


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Quotient as a double; NULL where the divisor is zero or NULL."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def ratio(num: ColumnOrName, den: ColumnOrName, n: int) -> Column:
    return round_dec(safe_div(num, den), n)


def percent(part: ColumnOrName, whole: ColumnOrName, n: int) -> Column:
    return round_dec(safe_div(F.lit(100.0) * as_col(part).cast("double"), whole), n)


def mean(c: ColumnOrName, n: int) -> Column:
    """Average of the non-NULL values from an exact sum."""
    return ratio(exact_sum(c), F.count(as_col(c)), n)


def to_whole(c: ColumnOrName) -> Column:
    """Number to integer, rounding half away from zero instead of truncating."""
    return F.round(as_col(c).cast(SNAP), 0).cast("bigint")
