"""Banding of margins, battery levels and store conditions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from storelake.functions.numeric import ColumnOrName, as_col

# Limits and labels of the bands.
MARGIN_LIMITS = (35, 30, 25)
MARGIN_LABELS = ("high", "medium", "low", "loss risk")
MARGIN_LABELS_TITLE = ("High", "Medium", "Low", "Loss Risk")
BATTERY_LIMITS = (10, 20)
BATTERY_LABELS = ("critical", "low", "ok")
BATTERY_LABELS_UPPER = ("CRITICAL", "LOW", "OK")
MAX_TEMP_C = 25
MAX_OCCUPANCY_PCT = 80
MIN_SHELF_WEIGHT_KG = 5
STATUS_LABELS = ("temp_breach", "overcrowd", "low_stock", "normal")


def _first_match(conditions: list[Column], labels: tuple[str, ...]) -> Column:
    """Label of the first condition that holds, else the last label."""
    *named, fallback = labels
    out = F
    for condition, label in zip(conditions, named, strict=True):
        out = out.when(condition, label)
    return out.otherwise(fallback)


def margin_band(c: ColumnOrName, labels: tuple[str, ...] = MARGIN_LABELS) -> Column:
    c = as_col(c)
    return _first_match([c >= limit for limit in MARGIN_LIMITS], labels)


def battery_status(c: ColumnOrName, labels: tuple[str, ...] = BATTERY_LABELS) -> Column:
    c = as_col(c)
    return _first_match([c < limit for limit in BATTERY_LIMITS], labels)


def temp_breach(temp: ColumnOrName) -> Column:
    return as_col(temp) > MAX_TEMP_C


def overcrowded(occupancy: ColumnOrName) -> Column:
    return as_col(occupancy) > MAX_OCCUPANCY_PCT


def low_stock(weight: ColumnOrName) -> Column:
    return as_col(weight) < MIN_SHELF_WEIGHT_KG


def operational_status(
    temp: ColumnOrName, occupancy: ColumnOrName, weight: ColumnOrName
) -> Column:
    """Condition of a store-day; an absent reading never raises a flag."""
    return _first_match(
        [temp_breach(temp), overcrowded(occupancy), low_stock(weight)], STATUS_LABELS
    )
