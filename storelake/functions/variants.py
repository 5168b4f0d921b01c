"""Typed access to semi-structured columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.functions.numeric import ColumnOrName, as_col

Paths = dict[str, tuple[str, str]]


def variant_path(c: ColumnOrName, path: str, dtype: str) -> Column:
    """Value at ``path`` cast to ``dtype``; NULL where absent or not castable."""
    return F.try_variant_get(as_col(c), f"$.{path}", dtype)


def variant_fields(df: DataFrame, column: str, fields: Paths) -> DataFrame:
    """One typed column per ``name: (path, type)``, in the given order."""
    return df.select(
        *[variant_path(column, path, t).alias(name) for name, (path, t) in fields.items()]
    )
