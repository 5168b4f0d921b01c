"""Tables kept as one folder per micro-batch, with an occasional folded base.

A batch writes its own folder and overwrites it when it runs again, so a retry
after a failure changes nothing. The cost of a batch follows its own size, never
that of the table. ``write_base`` stores a folded state up to some batch; readers
take the newest complete base and the batches after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelake.session import TIDY, settings

BATCH, PART = "batch", "_part"
# Fixed value: files that a task may have open; with more partitions it sorts its rows.
OPEN_FILES = "8"


def _files(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = _files(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    """A folder that no later step reads goes."""
    fs, where = _files(spark, path)
    fs.delete(where, True)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files of a folder."""
    fs, where = _files(spark, path)
    return fs.getContentSummary(where).getLength()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if there is no folder."""
    fs, where = _files(spark, path)
    return [e.getPath().getName() for e in fs.listStatus(where)] if fs.exists(where) else []


def claim(spark: SparkSession, root: str, run: str) -> None:
    """Binds a stored table to the checkpoint that numbers its batches.

    A new checkpoint starts over with batch 0 and with all rows of its source, so under
    the same root it would replace some batches and count the others twice. ValueError
    names the checkpoint that the root belongs to: give a new checkpoint a new root.
    """
    fs, where = _files(spark, root)
    marks = [e.getPath().getName() for e in fs.listStatus(where)] if fs.exists(where) else []
    owners = [name.removeprefix("_run-") for name in marks if name.startswith("_run-")]
    if not owners:
        fs.mkdirs(_files(spark, f"{root}/_run-{run}")[1])
    elif owners != [run]:
        raise ValueError(f"{root} belongs to checkpoint {owners[0]}, not {run}")


def write_batch(
    df: DataFrame, root: str, batch_id: int, partition_by: list[str] | None = None
) -> DataFrame:
    """Stores a batch; ``partition_by`` is for columns of a few values, such as a flag.

    Each task has a file open for each value that it meets, so rows neither move nor are
    sorted before they are written.
    """
    path = f"{root}/{BATCH}={batch_id}"
    with settings(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": OPEN_FILES}):
        df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_batch_once(
    df: DataFrame, root: str, batch_id: int, partition_by: list[str] | None = None
) -> DataFrame:
    """As ``write_batch``, but a complete folder of this batch stays as it is.

    A repeated batch holds the same rows, and a stream that reads the folder has taken
    the files that are there: other files with the same rows would be new to it.
    """
    path = f"{root}/{BATCH}={batch_id}"
    if path_exists(df.sparkSession, f"{path}/_SUCCESS"):
        return df.sparkSession.read.schema(df.schema).parquet(path)
    return write_batch(df, root, batch_id, partition_by)


def write_parts(
    df: DataFrame, parts: list[Column], path: str, fmt: str, options: dict[str, str]
) -> list[str]:
    """Stores the rows of each condition in a folder of its own, all in one pass; the folders.

    Rows of no condition are left out; a condition without rows gets a file without any. Each
    task has a file open for each part that it meets. The shuffle files behind ``df`` go with
    the write.
    """
    number = F.lit(None).cast("int")
    for n, part in reversed(list(enumerate(parts))):
        number = F.when(part, n).otherwise(number)
    spark = df.sparkSession
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": OPEN_FILES, **TIDY}):
        numbered = df.withColumn(PART, number).where(F.col(PART).isNotNull())
        numbered.write.partitionBy(PART).options(**options).format(fmt).save(path)
    folders = [f"{path}/{PART}={n}" for n in range(len(parts))]
    for folder in folders:
        if not path_exists(spark, folder):
            df.limit(0).write.options(**options).format(fmt).save(folder)
    return folders


def land_files(spark: SparkSession, src: str, dst: str) -> None:
    """Moves the files of a part into another folder, as a feed hands over finished files.

    The number of the part goes before their names: a task names its files alike in all parts.
    """
    fs, into = _files(spark, dst)
    fs.mkdirs(into)
    number = src.rsplit("=", 1)[-1]
    for entry in fs.listStatus(_files(spark, src)[1]):
        name = entry.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        if not fs.rename(entry.getPath(), _files(spark, f"{dst}/{number}-{name}")[1]):
            raise OSError(f"cannot move {src}/{name} to {dst}")


def batch_numbers(
    spark: SparkSession, root: str, after: int = -1, before: int | None = None
) -> list[int]:
    """The batches that ``read_batches`` reads, in order."""
    names = [n for n in names_in(spark, root) if n.startswith(f"{BATCH}=")]
    numbers = sorted(int(n.removeprefix(f"{BATCH}=")) for n in names)
    return [n for n in numbers if n > after and (before is None or n < before)]


def read_batches(
    spark: SparkSession, root: str, schema: T.StructType, after: int = -1, before: int | None = None
) -> DataFrame:
    """Rows of the batches with their number; other batches' files are not opened."""
    schema = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    if not path_exists(spark, root):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).parquet(root).where(F.col(BATCH) > after)
    return df if before is None else df.where(F.col(BATCH) < before)


def is_complete(spark: SparkSession, root: str, version: int) -> bool:
    return path_exists(spark, f"{root}/v={version}/_SUCCESS")


def write_base(df: DataFrame, root: str, version: int) -> None:
    """Stores a base under a name of its own first, and renames it when it is whole.

    A complete base of this version stays as it is: a batch that runs again after a
    failure never overwrites what it may be reading.
    """
    spark = df.sparkSession
    if is_complete(spark, root, version):
        return
    fs, unfinished = _files(spark, f"{root}/_unfinished-v={version}")
    df.write.mode("overwrite").parquet(str(unfinished))
    final = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/v={version}")
    fs.delete(final, True)  # the rest of an attempt that failed
    if not fs.rename(unfinished, final):
        raise OSError(f"cannot rename {unfinished} to {final}")


def bases(spark: SparkSession, root: str) -> list[int]:
    """Versions whose write finished, in order."""
    fs, where = _files(spark, root)
    if not fs.exists(where):
        return []
    names = [entry.getPath().getName() for entry in fs.listStatus(where)]
    versions = [int(n[2:]) for n in names if n.startswith("v=")]
    return sorted(v for v in versions if is_complete(spark, root, v))


def newest_base(spark: SparkSession, root: str, before: int | None = None) -> int:
    """Newest complete base, below version ``before`` if given; -1 if there is none."""
    return max([-1, *[v for v in bases(spark, root) if before is None or v < before]])


def drop_batches(spark: SparkSession, root: str, upto: int) -> int:
    """Deletes the folders of batches that a base of version ``upto`` has taken in.

    Call it when no reader still works from an older base. Returns how many went.
    """
    fs, where = _files(spark, root)
    dropped = 0
    for entry in fs.listStatus(where) if fs.exists(where) else []:
        name = entry.getPath().getName()
        if name.startswith(f"{BATCH}=") and int(name.removeprefix(f"{BATCH}=")) <= upto:
            dropped += bool(fs.delete(entry.getPath(), True))
    return dropped


def retire(spark: SparkSession, base_root: str, batch_root: str, keep: int = 2) -> None:
    """Deletes all but the newest ``keep`` bases, and the batches that the oldest of
    those has taken in. Readers that started from the base before the newest go on."""
    stored = bases(spark, base_root)
    if len(stored) < keep:
        return
    fs, _ = _files(spark, base_root)
    for version in stored[:-keep]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{base_root}/v={version}"), True)
    drop_batches(spark, batch_root, stored[-keep])
