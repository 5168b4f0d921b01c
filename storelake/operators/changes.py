"""Change feeds between two versions of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACTION, IS_UPDATE = "_action", "_is_update"
INSERT, DELETE = "INSERT", "DELETE"


def diff_changes(
    old: DataFrame, new: DataFrame, keys: list[str], null_keys: bool = True
) -> DataFrame:
    """Change rows that lead from ``old`` to ``new``; each has one row per key.

    An update is a DELETE of the old and an INSERT of the new row, both flagged
    ``_is_update``. The two versions meet in a single null-safe join, and each
    joined pair emits its zero to two rows in place. ``null_keys=False`` promises keys
    without nulls: sides that already lie by hash of the keys then meet where they are.
    """
    columns = new.columns
    left = old.select(F.struct(*columns).alias("_old"), *[F.col(k).alias(f"_o_{k}") for k in keys])
    right = new.select(F.struct(*columns).alias("_new"), *[F.col(k).alias(f"_n_{k}") for k in keys])
    ends = [(F.col(f"_o_{k}"), F.col(f"_n_{k}")) for k in keys]
    same_key = [a.eqNullSafe(b) if null_keys else a == b for a, b in ends]
    pairs = left.join(right, same_key, "full_outer").where(~F.col("_old").eqNullSafe(F.col("_new")))
    updated = F.col("_old").isNotNull() & F.col("_new").isNotNull()

    def change(side: str, action: str):
        row = F.struct(F.col(side).alias("row"), F.lit(action).alias("action"))
        return F.when(F.col(side).isNotNull(), row)

    rows = F.filter(F.array(change("_old", DELETE), change("_new", INSERT)), lambda r: r.isNotNull())
    return pairs.select(F.explode(rows).alias("c"), updated.alias(IS_UPDATE)).select(
        "c.row.*", F.col("c.action").alias(ACTION), IS_UPDATE
    )


def inserts_only(changes: DataFrame) -> DataFrame:
    """New and updated rows of a change feed, without its bookkeeping columns."""
    return changes.where(F.col(ACTION) == INSERT).drop(ACTION, IS_UPDATE)
