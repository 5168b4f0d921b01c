"""Calendar helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from storelake.functions.numeric import ColumnOrName, as_col


def instant(at: dt.datetime | dt.date | str) -> Column:
    """Literal point in time, free of any time zone."""
    return F.lit(str(at)).cast("timestamp_ntz")


def as_date(c: ColumnOrName) -> Column:
    return as_col(c).cast("date")


def iso_weekday(c: ColumnOrName) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(as_col(c)) + 1


def sunday_weekday(c: ColumnOrName) -> Column:
    """Sunday 0 to Saturday 6."""
    return F.dayofweek(as_col(c)) - 1


def is_weekend(c: ColumnOrName) -> Column:
    return iso_weekday(c).isin(6, 7)


def fmt_date(c: ColumnOrName, pattern: str) -> Column:
    return F.date_format(as_col(c), pattern)


def quarter_label(c: ColumnOrName, prefix: str, with_year: bool = False) -> Column:
    parts = [F.lit(prefix), F.quarter(as_col(c)).cast("string")]
    if with_year:
        parts += [F.lit("-"), F.year(as_col(c)).cast("string")]
    return F.concat(*parts)


def shift_date(c: ColumnOrName, n: ColumnOrName | int, unit: str = "day") -> Column:
    """``c`` moved by n days, hours or minutes; whole days keep a DATE a DATE."""
    c = as_col(c)
    n = F.lit(n) if isinstance(n, int) else as_col(n)
    if unit == "day":
        return F.date_add(c, n)
    if unit == "hour":
        return c + F.make_dt_interval(hours=n)
    if unit == "minute":
        return c + F.make_dt_interval(mins=n)
    raise ValueError(f"unit {unit!r}")


def period_start(c: ColumnOrName, grain: str) -> Column:
    """First day of the day, month, quarter or year: the partition a dated row is stored in."""
    return as_col(c) if grain == "day" else F.trunc(as_col(c), grain)


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    return F.datediff(as_col(end), as_col(start))


def date_parts(c: ColumnOrName) -> dict[str, Column]:
    """Calendar attributes of a date, by name."""
    c = as_col(c)
    return {
        "day_of_week": iso_weekday(c),
        "day_name": F.dayname(c),
        "day_of_month": F.dayofmonth(c),
        "day_of_year": F.dayofyear(c),
        "week_of_year": F.weekofyear(c),
        "month_number": F.month(c),
        "month_name": F.monthname(c),
        "quarter": F.quarter(c),
        "quarter_name": quarter_label(c, "q"),
        "year": F.year(c),
        "is_weekend": is_weekend(c),
        "month_year": fmt_date(c, "MMM-yyyy"),
        "quarter_year": quarter_label(c, "q", with_year=True),
    }
