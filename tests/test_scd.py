from __future__ import annotations

import datetime as dt

import pytest

from storelake.operators import scd
from storelake.schemas import store_scd2_schema

D0, D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 3, 1), dt.date(2024, 6, 1)
UPDATE = "store_id string, store_name string, store_city string"


@pytest.fixture
def dim(spark):
    data = [
        (1, "s1", "Main", "Izmir", D0, None, True),
        (2, "s2", "South", "Van", D0, None, True),
        (3, "s3", "East", None, D0, None, True),
        (4, "s4", "Old", "Bursa", D0, D1, False),
        (5, "s4", "Old", "Konya", D1, None, True),
    ]
    return spark.createDataFrame(data, store_scd2_schema())


def updates(spark, *data):
    return spark.createDataFrame(list(data), UPDATE)


def batch(spark):
    """Changed city, unchanged, a value for a NULL, a NULL for a value, a new store, a repeat."""
    return updates(
        spark,
        ("s1", "Main", "Ankara"), ("s1", "Main", "Ankara"), ("s2", "South", "Van"),
        ("s3", "East", "Mersin"), ("s4", "Old", None), ("s9", "New", "Rize"), (None, "No key", "X"),
    )


def test_apply(spark, dim, rows):
    got = rows(scd.scd2_apply(dim, batch(spark), D2))
    assert got == [
        (1, "s1", "Main", "Izmir", D0, D2, False),
        (2, "s2", "South", "Van", D0, None, True),
        (3, "s3", "East", None, D0, D2, False),
        (4, "s4", "Old", "Bursa", D0, D1, False),
        (5, "s4", "Old", "Konya", D1, D2, False),
        (6, "s1", "Main", "Ankara", D2, None, True),
        (7, "s3", "East", "Mersin", D2, None, True),
        (8, "s4", "Old", None, D2, None, True),
        (9, "s9", "New", "Rize", D2, None, True),
    ]


def test_applying_twice_changes_nothing(spark, dim, rows):
    once = scd.scd2_apply(dim, batch(spark), D2)
    assert rows(scd.scd2_apply(once, batch(spark), D2)) == rows(once)


def test_one_current_row_per_store(spark, dim):
    step = scd.scd2_apply(dim, batch(spark), D2)
    step = scd.scd2_apply(step, updates(spark, ("s1", "Main", "Sivas"), ("s9", "Newer", "Rize")), D2)
    current = step.where("is_current")
    assert current.count() == current.select("store_id").distinct().count() == 5
    assert step.select("store_key").distinct().count() == step.count()


def test_literal_form(spark, dim, rows):
    got = rows(scd.scd2_apply(dim, batch(spark).dropDuplicates(), D2, literal=True))
    assert [r for r in got if r[4] == D2] == [(6, "s1", "Main", "Ankara", D2, None, True)]
    assert [r[0] for r in got if r[5] == D2] == [1]


def test_literal_form_opens_another_version_when_run_twice(spark, dim):
    moved = updates(spark, ("s1", "Main", "Ankara"))
    once = scd.scd2_apply(dim, moved, D2, literal=True)
    twice = scd.scd2_apply(once, moved, D2, literal=True)
    assert twice.where("store_id = 's1' and is_current").count() == 2


def test_seed(spark, rows):
    stores = updates(spark, ("s2", "B", "Y"), ("s1", "A", "X"), ("s1", "A", "X"))
    assert rows(scd.scd2_seed(stores, "2024-01-01"), "store_key", "store_id", "city_name", "is_current") == [
        (1, "s1", "X", True), (2, "s2", "Y", True),
    ]


@pytest.mark.parametrize("cities", [("Lyon", "Paris"), ("Paris", "Lyon"), ("Paris", "Oslo")])
def test_the_last_update_in_time_counts(spark, cities):
    dim = spark.createDataFrame([(1, "s1", "Main", "Paris", D0, None, True)], store_scd2_schema())
    feed = spark.createDataFrame(
        [("s1", "Main", c, n) for n, c in enumerate(cities)], UPDATE + ", load_ts int"
    )
    now = scd.scd2_apply(dim, feed, D2, latest_by="load_ts").where("is_current").collect()
    assert [r.city_name for r in now] == [cities[-1]]
    closed = scd.scd2_apply(dim, feed, D2, literal=True).where("store_key = 1").first()
    assert not closed.is_current  # one of the updates has another city
