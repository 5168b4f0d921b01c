"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelake.llm.common import TEXTS_A_TASK, WORD, few_tasks, text_of, written
from storelake.operators.ordering import global_positions, stage

#: Hash cells of each source. The extra repetition goes to whole cells up to the one
#: in which the target is met; documents of that cell get a fraction of theirs.
CELLS = 256
SEED = 7


def _draw(id_col: str, seed: int, first: int, digits: int) -> Column:
    """A whole number of so many hex digits from the seeded md5 of the id."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")).cast("binary"))
    return F.conv(F.substring(digest, first, digits), 16, 10).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """Per source: source, source_size, target.

    Sources are numbered by code point with null last and take ``weights`` in turn.
    Water-filling: as long as a source's share of what is left is above
    ``max_epochs`` times its size, it is clamped there and the rest is shared anew by
    weight. Each round is one aggregate over the sources; two sums reach the driver.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = global_positions(sizes, [F.col("source").asc_nulls_last()], "position")
    choices = F.array(*[F.lit(w).cast("long") for w in weights])
    turn = F.pmod(F.col("position") - 1, F.lit(len(weights))).cast("int")
    weighed = numbered.select(
        "source",
        "source_size",
        F.get(choices, turn).alias("weight"),
        (F.col("source_size") * max_epochs).alias("cap"),
    )
    sources = stage(few_tasks(weighed, sized.count()))
    whole = sources.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
    total, left, weight = whole["s"] or 0, whole["s"] or 0, whole["w"] or 0
    clamped = F.lit(False)
    while weight:
        clamped = F.col("weight") * F.lit(left) > F.col("cap") * F.lit(weight)
        found = (
            sources.where(clamped).agg(F.sum("cap").alias("s"), F.sum("weight").alias("w")).first()
        )
        now = (total - (found["s"] or 0), whole["w"] - (found["w"] or 0))
        if now == (left, weight):
            break
        left, weight = now
    share = F.col("weight") * F.lit(left) / F.lit(max(weight, 1))
    target = F.when(clamped, F.col("cap").cast("double")).otherwise(share)
    return sources.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    max_epochs: int = 3,
    seed: int = SEED,
    id_col: str = "doc_id",
) -> DataFrame:
    """One row per row of ``docs``: id, source, size, source_size, target, taken.

    ``size`` is the number of words, ``taken`` the words that the mix takes with
    repeats counted. A source whose target is r times its size gives every document
    floor(r) whole repetitions. The rest goes by seeded hash cells of the id: whole
    documents of the first cells, and a fraction of the documents of the cell in
    which the target is met. So a source misses its target by rounding only.

    Null texts have size 0, a null source is a source, a null id draws like any id.
    Rows that repeat an id are separate documents with the same draw. A source of
    size 0 gets target 0. Nothing depends on partitioning, so reruns agree.
    """
    return _mix(docs, weights, max_epochs, seed, id_col)[0]


def _mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    max_epochs: int = 3,
    seed: int = SEED,
    id_col: str = "doc_id",
) -> tuple[DataFrame, int]:
    """The result of ``mix`` and how many rows it has."""
    sized = written(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.col("source"),
            F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"),
        ).withColumn("cell", _draw("id", seed, 1, 2)),
        "mix-sizes",
    )
    targets = source_targets(sized, weights, max_epochs)
    # Pre-aggregated to at most CELLS rows a source, which bounds the window.
    cells = sized.groupBy("source", "cell").agg(F.sum("size").alias("held"))
    earlier = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
    t = targets.withColumnRenamed("source", "_source")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    plan = (
        cells.join(t, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("whole", F.coalesce(whole, F.lit(0)).cast("long"))
        .withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn(
            "part",
            F.when(F.col("held") == 0, F.lit(0.0)).otherwise(
                F.greatest(
                    F.lit(0.0),
                    F.least(F.lit(1.0), (F.col("extra") - F.col("before")) / F.col("held")),
                )
            ),
        )
        .select(
            F.col("source").alias("_source"),
            F.col("cell").alias("_cell"),
            "source_size",
            "target",
            "whole",
            "part",
        )
    )
    # The cell salts the join: a source with a third of all rows is spread by it.
    at = F.col("source").eqNullSafe(F.col("_source")) & (F.col("cell") == F.col("_cell"))
    round_up = _draw("id", seed, 3, 8) / F.lit(float(16**8))
    mixed = sized.join(plan, at).select(
        F.col("id").alias(id_col),
        "source",
        "size",
        "source_size",
        "target",
        (
            F.col("whole") * F.col("size")
            + F.floor(F.col("size") * F.col("part") + round_up).cast("long")
        ).alias("taken"),
    )
    return mixed, sized.count()


def mixed_rows(docs: DataFrame, **parameters) -> DataFrame:
    """The mix as rows with the columns of ``docs``: whole repetitions, no text is cut.

    A document taken 2.4 times becomes two rows, and a third with a seeded chance of
    0.4. Only documents of one hash cell of a source have such a fraction, so its words
    stay near the target. Documents without words hold nothing to repeat: they stay
    once, so that no clean document is lost for being empty. Documents whose source
    needs less than its size may be left out.
    """
    names = docs.columns
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        F.col("doc_id").alias("_of"),
        F.col("source").alias("_from"),
        F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("words"),
    )
    # Rows with one id, source and size take the same number of words.
    mixed, many = _mix(docs, **parameters)
    amounts = mixed.groupBy("doc_id", "source", "size").agg(F.first("taken").alias("taken"))
    joined = rows.join(
        amounts,
        F.col("_of").eqNullSafe(F.col("doc_id"))
        & F.col("_from").eqNullSafe(F.col("source"))
        & (F.col("words") == F.col("size")),
    )
    full = F.greatest(F.col("words"), F.lit(1))
    drawn = (_draw("_of", parameters.get("seed", SEED), 11, 8) + 0.5) / F.lit(float(16**8))
    times = F.floor(F.col("taken") / full + F.lit(1.0) - drawn)
    copies = F.when(F.col("words") == 0, F.lit(1)).otherwise(times).cast("int")
    return few_tasks(joined, many, TEXTS_A_TASK).select(
        "row", F.explode(F.array_repeat(F.lit(True), copies))
    ).select(*[F.col("row").getField(c).alias(c) for c in names])
