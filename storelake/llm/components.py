"""Connected components of a link table, without any component in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.llm.common import few_tasks
from storelake.operators.ordering import stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step: hang the neighbours of every node on the smallest of them.

    The minimum combines before the shuffle and is joined back by node, so the rows of
    a node of very high degree stay rows of a join, which adaptive execution splits.
    """
    if large:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        hung = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        low = links.groupBy("a").agg(F.min("b").alias("m"))
        hung = (
            links.join(low, "a")
            .where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b")))
        )
    return hung.where("a <> b").distinct()


def connected_components(links: DataFrame, most_links: int | None = None) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b): the smallest node it reaches.

    Alternates large-star and small-star steps until nothing changes; the number of
    rounds grows with the logarithm of the longest chain. Each round is checkpointed in
    the shared folder; a count and a checksum are all that the driver sees. Links of a
    node to itself and nulls are left out; without links the result is empty. A round is
    written by tasks that follow the links of the one before; ``most_links``, if known,
    does the same for the first.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    pairs = links.where("a <> b").select(high.alias("a"), low.alias("b")).distinct()
    state, mark = stage(pairs if most_links is None else few_tasks(pairs, most_links)), None
    while True:
        seen = state.agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")
        ).first()
        if seen["n"] == 0 or (seen["n"], seen["x"]) == mark:
            break
        mark = (seen["n"], seen["x"])
        state = stage(few_tasks(_star(_star(state, large=True), large=False), seen["n"]))
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
