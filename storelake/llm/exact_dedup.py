"""Exact duplicates by an extendible-hash index on shared files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.llm.common import TEXTS_A_TASK, few_tasks, text_of, written
from storelake.operators.ordering import stage

#: The directory never has more than 2 ** MAX_DEPTH cells; a bucket that is still
#: overfull there keeps all its entries, as a longer chain.
MAX_DEPTH = 16


def _prefix(cell: Column, depth: Column) -> Column:
    """The leading ``depth`` bits of a cell number of MAX_DEPTH bits."""
    return F.floor(cell / F.pow(F.lit(2.0), F.lit(MAX_DEPTH) - depth)).cast("long")


def directory(keys: DataFrame, capacity: int) -> DataFrame:
    """Cells of the key space with the bucket that holds them: cell, depth, bucket.

    ``keys`` has a column ``cell``, one row per key. The directory starts with one
    bucket. As long as a bucket holds more than ``capacity`` keys and can be split,
    the directory doubles and such buckets are split by one more bit; the others
    keep their depth, so several cells point at them. Only the number of overfull
    buckets comes to the driver.
    """
    most = 1 << MAX_DEPTH
    start = keys.groupBy("cell").agg(F.count("*").alias("n")).withColumn("depth", F.lit(0))
    cells = stage(few_tasks(start, most))
    while True:
        placed = cells.withColumn("prefix", _prefix(F.col("cell"), F.col("depth")))
        overfull = stage(
            few_tasks(
                placed.groupBy("depth", "prefix")
                .agg(F.sum("n").alias("held"))
                .where((F.col("held") > capacity) & (F.col("depth") < MAX_DEPTH))
                .select("depth", "prefix", F.lit(1).alias("split")),
                most,
            )
        )
        if overfull.count() == 0:
            return placed.select("cell", "depth", F.col("prefix").alias("bucket"))
        cells = stage(
            few_tasks(
                placed.join(overfull, ["depth", "prefix"], "left").select(
                    "cell", "n", (F.col("depth") + F.coalesce("split", F.lit(0))).alias("depth")
                ),
                most,
            )
        )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 65_536
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    1. Every row becomes an entry (64-bit key, SHA-256, id, row tag) in shared files.
    2. Entries chain by key and digest: collisions of the key stay apart on one chain.
       Copies are counted before the shuffle, so a hot text costs each task one row.
    3. The directory doubles until no bucket holds more than ``capacity`` chains, and
       the index is written by ranges of buckets: each owner task sorts its key range.
    4. Texts of chains with more than one entry are read again and compared byte for
       byte, grouped with a combine before the shuffle. Different bytes under one
       digest stop the job: there is no silent wrong group.

    Nulls count as the empty text, and empty texts equal each other. Of equal texts
    the row with the largest id stays; a null id is the smallest. Rows that repeat
    id and text are one group of which one row stays. Other columns are ignored.
    """
    return _marked(docs, id_col, text_col, capacity)[0]


def _marked(
    docs: DataFrame, id_col: str, text_col: str, capacity: int = 65_536
) -> tuple[DataFrame, int]:
    """The result of ``exact_dedup`` and how many rows it has."""
    keyed = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).select(
        "id", F.xxhash64("text").alias("key"), F.sha2("text", 256).alias("digest"), "text"
    )
    entries = written(
        keyed.select("id", "key", "digest").withColumn("tag", F.monotonically_increasing_id()),
        "dedup-entries",
    )
    rows = entries.count()
    chained = entries.groupBy("key", "digest").agg(
        F.max(F.struct("id", "tag")).alias("top"), F.count("*").alias("size")
    )
    chains = stage(few_tasks(chained, rows)).withColumn("cell", F.shiftrightunsigned("key", 64 - MAX_DEPTH))
    index = written(
        chains.join(directory(chains.select("cell"), capacity), "cell")
        .repartitionByRange("bucket", "key")
        .sortWithinPartitions("bucket", "key", "digest")
        .select("bucket", "key", "digest", "top", "size"),
        "dedup-index",
    )
    several = index.where(F.col("size") > 1)
    compared = (
        keyed.join(several.select("key", "digest"), ["key", "digest"], "left_semi")
        .groupBy("key", "digest", "text")
        .agg(F.count("*").alias("copies"))
        .groupBy("key", "digest")
        .agg(F.count("*").alias("texts"))
    )
    # Stored, so that the join below shuffles both sides itself: then adaptive execution
    # can split the rows of a hot text, which it cannot behind an aggregate by that key.
    groups = several.join(compared, ["key", "digest"]).select(
        F.col("key").alias("_key"),
        F.col("digest").alias("_digest"),
        "top",
        F.when(F.col("texts") == 1, F.col("size"))
        .otherwise(F.raise_error(F.lit("different texts under one digest")).cast("long"))
        .alias("size"),
    )
    groups = written(few_tasks(groups, rows), "dedup-groups")
    found = entries.join(
        groups, (F.col("key") == F.col("_key")) & (F.col("digest") == F.col("_digest")), "left"
    ).select(
        F.col("id").alias(id_col),
        F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("top.id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("top").isNull() | (F.col("top.tag") == F.col("tag"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
    return found, rows


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` drops; all columns stay as they are.

    Rows that repeat both id and text become one of these rows.
    """
    found, many = _marked(docs, id_col, text_col)
    marked = (
        found.where(F.col("group_size") > 1)
        .groupBy(F.col(id_col).alias("_id"), F.col("text_sha256").alias("_digest"))
        .agg(F.bool_or("kept").alias("_kept"), F.count("*").alias("_rows"))
        .where(~F.col("_kept") | (F.col("_rows") > 1))
    )
    names = docs.columns
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),
        F.col(f"`{id_col}`").alias("_of"),
        F.sha2(text_of(text_col), 256).alias("_sha"),
    ).join(
        marked, F.col("_of").eqNullSafe(F.col("_id")) & (F.col("_sha") == F.col("_digest")), "left"
    )
    once = rows.where(F.col("_kept").isNull()).select("_row")
    repeated = (
        rows.where("_kept").groupBy("_of", "_sha").agg(F.first("_row").alias("_row")).select("_row")
    )
    # Not the union: its small partitions would put several large ones into one task.
    return few_tasks(once, many, TEXTS_A_TASK).unionByName(repeated).select(
        *[F.col("_row").getField(c).alias(c) for c in names]
    )
