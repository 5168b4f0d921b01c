"""Row positions, tiles, ranks and dense keys over a whole relation.

A window without a partition key puts all rows into one task. These operators
sort by range instead: each task holds one slice of the order, the slices are
counted, and the counts before a slice are added to the positions inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelake.session import shared_root

_SLICE_BITS = 33  # monotonically_increasing_id: slice number above, row in slice below


def stage(df: DataFrame) -> DataFrame:
    """Cut lineage at a checkpoint in the shared folder, which outlives lost executors."""
    shared_root(df.sparkSession)
    return df.checkpoint()


def _slices(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rows sorted by range, with their slice and their place ``_row`` in the order.

    The sorted slices are checkpointed: counting and numbering must see the same
    slices, also after a retry.
    """
    sorted_rows = stage(df.repartitionByRange(*order).sortWithinPartitions(*order))
    tagged = sorted_rows.withColumn("_row", F.monotonically_increasing_id())
    return tagged.withColumn("_slice", F.shiftright("_row", _SLICE_BITS))


def _with_rows_before_slice(slices: DataFrame, weight: Column) -> DataFrame:
    """Adds ``_before``: the weight of all earlier slices.

    The weights are one row per slice, so they are the one thing here that may
    pass through a single task or be broadcast.
    """
    weights = slices.groupBy(F.col("_slice").alias("_of")).agg(weight.alias("_w"))
    earlier = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    before = weights.select("_of", F.coalesce(F.sum("_w").over(earlier), F.lit(0)).alias("_before"))
    return slices.join(F.broadcast(before), F.col("_slice") == F.col("_of")).drop("_of")


def global_positions(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """Adds the 1-based position of every row in ``order``.

    ``order`` should end in columns that break ties; rows equal in all of them
    get neighbouring positions in no set order.
    """
    placed = _with_rows_before_slice(_slices(df, order), F.count("*"))
    in_slice = F.col("_row").bitwiseAND(F.lit((1 << _SLICE_BITS) - 1))
    return placed.select(*df.columns, (F.col("_before") + in_slice + 1).alias(name))


def ntile_global(df: DataFrame, order: list[Column], n: int, name: str = "tile") -> DataFrame:
    """Splits all rows into n tiles of equal size; the first ones take the remainder."""
    placed = global_positions(df, order, "_position")
    total = placed.select(F.count("*")).scalar()
    size, extra = F.expr("_total div {0}".format(int(n))), F.col("_total") % n
    # The first `extra` tiles have one row more.
    in_large = extra * (size + 1)
    zero_based = F.col("_position") - 1
    tile = F.when(
        zero_based < in_large, F.floor(zero_based / (size + 1))
    ).otherwise(extra + F.floor((zero_based - in_large) / F.greatest(size, F.lit(1))))
    return placed.withColumn("_total", total).select(*df.columns, (tile + 1).cast("int").alias(name))


#: Slices of a part's order values; a task sorts the values of one slice.
RANK_SLICES = 100


def rank_within(
    df: DataFrame, part: list[str], order: str, name: str = "rank", descending: bool = True
) -> DataFrame:
    """Rank with gaps by a number or date ``order`` inside each ``part``, NULLs first when
    descending and last when not.

    A rank is one plus the number of rows of the part that sort before. Rows are
    first counted per order value, with a partial count before the shuffle, so what
    is ranked is values, not rows. Approximate percentiles cut the values of a part
    into slices; counts before a slice and counts inside it add up to the rank. How
    good the cuts are decides about balance only, never about the result.
    """
    key, value = [f"_k{i}" for i in range(len(part))], "_v"
    named = [F.col(p).alias(k) for p, k in zip(part, key, strict=True)]
    counted = (
        df.select(*named, F.col(order).alias(value)).groupBy(*key, value).agg(F.count("*").alias("_n"))
    )
    number = F.col(value).cast("timestamp").cast("double") if _is_time(df, order) else (
        F.col(value).cast("double")
    )
    shares = F.array(*[F.lit(i / RANK_SLICES) for i in range(1, RANK_SLICES)])
    cut_key = [f"_c{k}" for k in key]
    cuts = counted.groupBy(*[F.col(k).alias(c) for k, c in zip(key, cut_key, strict=True)]).agg(
        F.percentile_approx(number, shares, F.lit(10_000)).alias("_cuts")
    )
    passed = F.filter("_cuts", lambda c: c > number if descending else c < number)
    last = F.lit(-1 if descending else RANK_SLICES)  # where NULLs go
    slices = counted.join(cuts, _same(key, cut_key)).select(
        *key, value, "_n", F.when(F.col(value).isNull(), last).otherwise(F.size(passed)).alias("_slice")
    )
    held = slices.groupBy(*key, "_slice").agg(F.sum("_n").alias("_held"))
    earlier = Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    other = [f"_f{k}" for k in key]
    before = held.select(
        *[F.col(k).alias(o) for k, o in zip(key, other, strict=True)],
        F.col("_slice").alias("_of"),
        F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before"),
    )
    direction = F.col(value).desc_nulls_first() if descending else F.col(value).asc_nulls_last()
    inside = Window.partitionBy(*key, "_slice").orderBy(direction)
    ahead = F.coalesce(
        F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    ranks = (
        slices.withColumn("_ahead", ahead)
        .join(before, _same([*key, "_slice"], [*other, "_of"]))
        .select(*key, value, (F.col("_before") + F.col("_ahead") + 1).cast("int").alias(name))
    )
    return df.join(ranks, _same([*part, order], [*key, value])).select(*df.columns, name)


def _is_time(df: DataFrame, column: str) -> bool:
    return df.select(column).schema[0].dataType.typeName() in ("date", "timestamp", "timestamp_ntz")


def _same(left: list[str], right: list[str]) -> Column:
    """Null-safe equality of two lists of columns."""
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def rank_rows(df: DataFrame, order: str, name: str = "rank") -> DataFrame:
    """Rank over a small aggregate: one row per category, store or month.

    The window runs in one task, so ``df`` must be a result whose row count a
    dimension bounds; use ``rank_within`` for anything else.
    """
    return df.withColumn(name, F.rank().over(Window.orderBy(F.col(order).desc_nulls_first())))


def pct_of_total(df: DataFrame, col: str, name: str, digits: int = 2) -> DataFrame:
    """Share of each row in the column total, the total being a scalar subquery."""
    from storelake.functions.numeric import exact_sum, percent

    total = df.select(exact_sum(col)).scalar()
    return df.withColumn("_total", total).withColumn(name, percent(col, "_total", digits)).drop("_total")


def add_surrogate_key(
    df: DataFrame, order_cols: list[str], start: int | Column = 1, name: str = "surrogate_key"
) -> DataFrame:
    """Dense integer key in a repeatable order, beginning at ``start``."""
    start = F.lit(start) if isinstance(start, int) else start
    placed = global_positions(df, [F.col(c).asc_nulls_first() for c in order_cols], "_position")
    return placed.select(
        (start + F.col("_position") - 1).cast("bigint").alias(name), *df.columns
    )
