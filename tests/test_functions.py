from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from storelake.functions import bands, dates, numeric, scalars, variants


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


@pytest.mark.parametrize(
    "text,expected",
    [
        ("HOME garden", "Home Garden"),
        ("health-beauty", "Health-Beauty"),
        ("food&drink/fresh", "Food&Drink/Fresh"),
        ("baker's best", "Baker's Best"),
        ("a[b]c d", "A[B]C D"),
        ("", ""),
        (None, None),
    ],
)
def test_title_case(spark, text, expected):
    assert one(spark, t=scalars.title_case(F.lit(text).cast("string"))).t == expected


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(-3,), (0,), (5,), (None,)], "x int")
    got = [r.x for r in df.select(scalars.clamp_min("x").alias("x")).collect()]
    assert got == [0, 0, 5, None]


def test_clamp_keeps_type(spark):
    df = spark.createDataFrame([(-1.5, 1)], "d double, i int")
    out = df.select(scalars.clamp_min("d").alias("d"), scalars.clamp_min("i").alias("i"))
    assert [f.dataType.simpleString() for f in out.schema] == ["double", "int"]


def test_casts_round_and_tolerate_dirt(spark):
    r = one(
        spark,
        half=scalars.to_type(F.lit(2.5), "int"),
        neg=scalars.to_type(F.lit(-2.5), "int"),
        text=scalars.to_type(F.lit("17"), "int"),
        dirt=scalars.to_type(F.lit("n/a"), "int"),
        date=scalars.to_type(F.lit("2024-02-30"), "date"),
        total=numeric.to_whole(F.lit(7.5)),
    )
    assert (r.half, r.neg, r.text, r.dirt, r.date, r.total) == (3, -3, 17, None, None, 8)


def test_division_by_zero_and_null(spark):
    r = one(
        spark,
        a=numeric.ratio(F.lit(1), F.lit(0), 2),
        b=numeric.ratio(F.lit(None).cast("int"), F.lit(2), 2),
        c=numeric.ratio(F.lit(1), F.lit(3), 2),
        d=numeric.percent(F.lit(1), F.lit(8), 1),
    )
    assert (r.a, r.b, r.c, r.d) == (None, None, 0.33, 12.5)


@pytest.mark.parametrize("x,n,expected", [(1.005, 2, 1.01), (2.675, 2, 2.68), (-1.005, 2, -1.01), (0.5, 0, 1.0)])
def test_ties_round_away_from_zero(spark, x, n, expected):
    assert one(spark, r=numeric.round_dec(F.lit(x), n)).r == expected


def test_sums_do_not_depend_on_order(spark):
    df = spark.createDataFrame([(0.1,), (1e9,), (0.2,), (-1e9,)] * 50, "x double")
    for parts in (1, 7):
        assert df.repartition(parts).select(numeric.sum_rounded("x", 4).alias("s")).first().s == 15.0


@pytest.mark.parametrize("pct,band", [(35.0, "high"), (34.9, "medium"), (30.0, "medium"), (25.0, "low"), (24.9, "loss risk"), (None, "loss risk")])
def test_margin_band(spark, pct, band):
    assert one(spark, b=bands.margin_band(F.lit(pct).cast("double"))).b == band


@pytest.mark.parametrize("pct,status", [(9, "CRITICAL"), (10, "LOW"), (19, "LOW"), (20, "OK"), (None, "OK")])
def test_battery_status(spark, pct, status):
    label = bands.battery_status(F.lit(pct).cast("int"), bands.BATTERY_LABELS_UPPER)
    assert one(spark, b=label).b == status


@pytest.mark.parametrize(
    "temp,occupancy,weight,status",
    [
        (26.0, 90.0, 1.0, "temp_breach"),
        (25.0, 90.0, 1.0, "overcrowd"),
        (None, 80.0, 4.9, "low_stock"),
        (None, None, None, "normal"),
    ],
)
def test_operational_status(spark, temp, occupancy, weight, status):
    args = [F.lit(v).cast("double") for v in (temp, occupancy, weight)]
    assert one(spark, s=bands.operational_status(*args)).s == status


def test_calendar_parts(spark):
    day = F.lit("2023-01-01").cast("date")  # a Sunday, in the last ISO week of 2022
    r = one(spark, **dates.date_parts(day), sunday=dates.sunday_weekday(day))
    assert (r.day_of_week, r.sunday, r.day_name, r.week_of_year) == (7, 0, "Sun", 52)
    assert (r.month_name, r.quarter_name, r.quarter_year, r.month_year) == ("Jan", "q1", "q1-2023", "Jan-2023")
    assert r.is_weekend is True


def test_shifting_days_keeps_dates(spark):
    day = F.lit("2024-03-01").cast("date")
    ts = F.lit("2024-03-01 00:10:00").cast("timestamp_ntz")
    r = one(
        spark,
        d=dates.shift_date(day, -1),
        m=dates.shift_date(ts, -15, "minute"),
        h=dates.shift_date(ts, 24, "hour"),
        n=dates.days_between(day, F.lit("2024-02-01").cast("date")),
    )
    assert r.d == dt.date(2024, 2, 29)
    assert r.m == dt.datetime(2024, 2, 29, 23, 55)
    assert r.h == dt.datetime(2024, 3, 2, 0, 10)
    assert r.n == -29


def test_variant_paths(spark):
    df = spark.range(1).select(
        F.parse_json(F.lit('{"id": "e1", "metadata": {"battery_pct": "x", "floor": 2}}')).alias("v")
    )
    got = variants.variant_fields(
        df, "v", {"id": ("id", "string"), "battery": ("metadata.battery_pct", "int"),
                  "floor": ("metadata.floor", "int"), "absent": ("nope.deep", "string")}
    ).first()
    assert tuple(got) == ("e1", None, 2, None)
