"""A keyed table in hash buckets, each with a version of its own.

A fold rewrites the buckets that its changes fall into and leaves the files of all others
where they are. A manifest says which fold each bucket is at. Spark reads the buckets of
a manifest as a bucketed table, so a join by key moves the other side only.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelake.operators.changes import diff_changes
from storelake.sources.batches import (
    _files,
    bases,
    drop_batches,
    newest_base,
    write_base,
)

SLOT = "_slot"
MANIFEST = T.StructType(
    [
        T.StructField("slot", T.IntegerType()),
        T.StructField("fold", T.LongType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("checksum", T.LongType()),
    ]
)


def slot(keys: list[str], buckets: int) -> Column:
    """The number of the bucket in which Spark stores a row."""
    return F.pmod(F.hash(*keys), F.lit(buckets)).cast("int")


def manifest_rows(spark: SparkSession, root: str, before: int | None = None) -> tuple[int, list[Row]]:
    """The newest version, below ``before`` if given, and its row for each bucket that holds
    rows; -1 and none if there is no manifest yet. One row a bucket comes to the driver."""
    version = newest_base(spark, f"{root}/manifest", before=before)
    if version < 0:
        return version, []
    return version, spark.read.schema(MANIFEST).parquet(f"{root}/manifest/v={version}").collect()


def read_manifest(
    spark: SparkSession, root: str, before: int | None = None
) -> tuple[int, int | None, dict[int, int]]:
    """Version, number of buckets, and the fold of each bucket that holds rows."""
    version, rows = manifest_rows(spark, root, before)
    return version, rows[0]["buckets"] if rows else None, {r["slot"]: r["fold"] for r in rows}


def _table(root: str, label: str) -> str:
    return f"storelake_{hashlib.md5(root.encode()).hexdigest()[:16]}_{label}"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def read_buckets(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    keys: list[str],
    before: int | None = None,
    only: list[int] | None = None,
) -> DataFrame | None:
    """Rows of the newest manifest, below ``before`` if given; of some buckets if given.

    The files are registered once a manifest as an external table, under a name made of
    the root: that is how Spark knows that they lie by hash of the keys.
    """
    version, buckets, folds = read_manifest(spark, root, before)
    if version < 0 or not folds:
        return None
    name = _table(root, f"v{version}")
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, `{SLOT}` INT) USING parquet "
            f"PARTITIONED BY (`{SLOT}`) CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS "
            f"LOCATION {_quoted(f'{root}/base')}"
        )
        where = [
            f"PARTITION (`{SLOT}` = {s}) LOCATION {_quoted(f'{root}/base/fold={fold}/{SLOT}={s}')}"
            for s, fold in sorted(folds.items())
        ]
        for at in range(0, len(where), 500):
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(where[at : at + 500]))
    stored = spark.table(name)
    if only is not None:
        stored = stored.where(F.col(SLOT).isin(only))
    return stored.select(*schema.names)


def write_buckets(
    rows: DataFrame, root: str, keys: list[str], buckets: int, version: int, touched: list[int]
) -> None:
    """Stores the rows of the touched buckets as fold ``version``, and then its manifest.

    Nothing points at the fold before the manifest is complete, so a repeated fold may
    write it anew.
    """
    spark = rows.sparkSession
    _, older = manifest_rows(spark, root, before=version)
    name = _table(root, f"fold{version}")
    for stale in (name, _table(root, f"v{version}")):  # of an attempt that failed
        spark.sql(f"DROP TABLE IF EXISTS {stale}")
    (
        rows.withColumn(SLOT, slot(keys, buckets))
        .write.format("parquet")
        .mode("overwrite")
        .partitionBy(SLOT)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", f"{root}/base/fold={version}")
        .saveAsTable(name)
    )
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay
    stored = {r["slot"]: r for r in older if r["slot"] not in touched}
    manifest = [*stored.values(), *_sums(spark, rows.schema, root, buckets, version)]
    write_base(spark.createDataFrame(manifest, MANIFEST).coalesce(1), f"{root}/manifest", version)


def _sums(
    spark: SparkSession, schema: T.StructType, root: str, buckets: int, version: int
) -> list[Row]:
    """Manifest rows of a fold: rows and checksum of each of its buckets."""
    placed = T.StructType([*schema.fields, T.StructField(SLOT, T.IntegerType())])
    stored = spark.read.schema(placed).parquet(f"{root}/base/fold={version}")
    return (
        stored.groupBy(F.col(SLOT).alias("slot"))
        .agg(F.count("*").alias("n_rows"), F.bit_xor(F.xxhash64(*schema.names)).alias("checksum"))
        .select(
            "slot", F.lit(version).cast("long").alias("fold"),
            F.lit(buckets).alias("buckets"), "n_rows", "checksum",
        )
        .collect()
    )


def differing(spark: SparkSession, root: str, old: int, new: int) -> list[int]:
    """Buckets that two versions do not share: other files, and other rows or checksum."""
    kept = [
        {r["slot"]: r for r in manifest_rows(spark, root, before=v + 1)[1]} for v in (old, new)
    ]

    def same(a: Row | None, b: Row | None) -> bool:
        if a is None or b is None:
            return a is b
        return a["fold"] == b["fold"] or (a["n_rows"], a["checksum"]) == (b["n_rows"], b["checksum"])

    slots = sorted(kept[0].keys() | kept[1].keys())
    return [s for s in slots if not same(kept[0].get(s), kept[1].get(s))]


def changes_between(
    spark: SparkSession, root: str, schema: T.StructType, keys: list[str], old: int, new: int
) -> DataFrame:
    """Change rows (``diff_changes``) that lead from one stored version to a later one.

    Only buckets that differ are read, and as both versions lie in the same buckets, no
    row moves to meet its other version. Two contents of one bucket with equal count and
    64-bit checksum are taken for the same.
    """
    slots = differing(spark, root, old, new)
    sides = [read_buckets(spark, root, schema, keys, v + 1, slots) for v in (old, new)]
    empty = spark.createDataFrame([], schema)
    old_rows, new_rows = (empty if side is None else side for side in sides)
    return diff_changes(old_rows, new_rows, keys, null_keys=False)


def rewritten(spark: SparkSession, root: str, version: int) -> list[int]:
    """The buckets that a fold has stored."""
    fs, where = _files(spark, f"{root}/base/fold={version}")
    names = [e.getPath().getName() for e in fs.listStatus(where)] if fs.exists(where) else []
    return sorted(int(n.removeprefix(f"{SLOT}=")) for n in names if n.startswith(f"{SLOT}="))


def retire_buckets(spark: SparkSession, root: str, batch_root: str, keep: int = 2) -> None:
    """Deletes all but the newest ``keep`` manifests, bucket files that none of these names,
    and the batches that the oldest of them has taken in."""
    versions = bases(spark, f"{root}/manifest")
    if len(versions) < keep:
        return
    kept, gone = versions[-keep:], versions[:-keep]
    used = set()
    for v in kept:
        _, _, folds = read_manifest(spark, root, before=v + 1)
        used |= {(fold, s) for s, fold in folds.items()}
    fs, _ = _files(spark, root)
    for v in gone:
        spark.sql(f"DROP TABLE IF EXISTS {_table(root, f'v{v}')}")
        fs.delete(_files(spark, f"{root}/manifest/v={v}")[1], True)
    _, base = _files(spark, f"{root}/base")
    for entry in fs.listStatus(base):
        fold = entry.getPath().getName()
        if not fold.startswith("fold=") or int(fold[5:]) >= kept[0]:
            continue
        held = rewritten(spark, root, int(fold[5:]))
        for s in held:
            if (int(fold[5:]), s) not in used:
                fs.delete(_files(spark, f"{root}/base/{fold}/{SLOT}={s}")[1], True)
    drop_batches(spark, batch_root, kept[0])
