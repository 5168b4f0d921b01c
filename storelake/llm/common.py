"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.session import new_folder

#: A word: the longest run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Short rows (ids, numbers, digests) or texts that a task writes at least, once there are
#: more than LEAST_TASKS tasks.
ROWS_A_TASK, TEXTS_A_TASK, LEAST_TASKS = 100_000, 5_000, 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str, *by: str) -> DataFrame:
    """The same rows read back from a Parquet folder under ``spark.checkpoint.dir``.

    ``by`` names columns with few values that become folders, which filters then skip.
    """
    return saved(df, label, *by)[1]


def saved(df: DataFrame, label: str, *by: str) -> tuple[str, DataFrame]:
    """A new folder under ``spark.checkpoint.dir`` and the same rows read back from it."""
    folder = new_folder(df.sparkSession, label)
    (df.write.partitionBy(*by) if by else df.write).parquet(folder)
    return folder, df.sparkSession.read.schema(df.schema).parquet(folder)


def few_tasks(df: DataFrame, rows: int, each: int = ROWS_A_TASK) -> DataFrame:
    """``df`` in tasks that follow its ``rows``, about ``each`` at least; no shuffle.

    A cluster's shuffle partitions may be many times what a small table needs, and each would
    be a file; every file costs an executor calls of its file system, on some of them a
    process of its own. More tasks than ``df`` has are never made, and ``rows``, if wrong,
    decides about balance only.
    """
    return df.coalesce(max(LEAST_TASKS, -(-rows // each)))


def forget(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of ``saved``, or one value's part of it, that no later step reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_of(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def fold(doc_id: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id counts as the empty text."""
    digits = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(digits.cast("binary")), F.lit(of)).cast("int")


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    train: Column,
    max_docs: int,
    max_chars: int,
) -> list[tuple[str, int]]:
    """At most ``max_docs`` labelled training texts, the ones with the smallest id hash.

    Half of the places are kept for either class, so that a rare one is not lost. The
    ids are chosen in the label table alone. Texts longer than ``max_chars`` code points
    are left out, not cut: this bounds what the driver fits on, and nothing else.
    Scoring reads every text whole. ``train`` is a condition on ``doc_id``.
    """
    order = F.xxhash64(F.col("doc_id"))
    marked = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & train)
        .groupBy("doc_id")
        .agg(F.max(label).alias("_label"))
    )
    half = [
        marked.where(F.col("_label") == v).orderBy(order, "doc_id").limit(max_docs // 2)
        for v in (0, 1)
    ]
    # At most max_docs ids, so a broadcast is bounded whatever the size of the tables.
    chosen = F.broadcast(half[0].unionByName(half[1]).limit(max_docs))
    texts = (
        docs.select("doc_id", text_of().alias("_text"))
        .where(F.length("_text") <= max_chars)
        .join(chosen, "doc_id")
        .orderBy(order, "doc_id", "_text")
        .limit(max_docs)
    )
    return [(r["_text"], r["_label"]) for r in texts.select("_text", "_label").collect()]
