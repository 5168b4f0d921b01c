"""Readers of the landing files: CSV, Parquet and JSON arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelake.functions.scalars import to_type
from storelake.functions.variants import Paths, variant_fields
from storelake.sources.footers import literal, read_footers, shapes
from storelake.sources.tables import conform

CORRUPT = "_corrupt_record"
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "enforceSchema": "true",
    "columnPruning": "false",
}

# Which landing files belong to which feed, matched on the whole path.
POS_FILES = ".*pos.*[.]csv"
ERP_ORDER_FILES = ".*erp_orders.*[.]parquet"
ERP_INVENTORY_FILES = ".*erp_inventory.*[.]parquet"
JSON_FILES = ".*[.]json"


def file_path() -> Column:
    """The path of a row's file as the file is named, as file listings have it.

    Spark's own column has it as a URI, with spaces and percent signs encoded.
    """
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def filter_files(df: DataFrame, regex: str) -> DataFrame:
    """Rows of the files whose whole path matches; other files are not opened."""
    return df.where(file_path().rlike(f"^(?:{regex})$"))


def with_load_metadata(df: DataFrame, load_ts: Column | None = None) -> DataFrame:
    """Load time and source file of each row."""
    return df.select("*", *load_metadata(load_ts))


def load_metadata(load_ts: Column | None = None) -> list[Column]:
    if load_ts is None:
        load_ts = F.current_timestamp().cast("timestamp_ntz")
    return [load_ts.alias("load_ts"), file_path().alias("source_file")]


def _to_read(path: str | list[str]) -> str | list[str]:
    """A folder or pattern as given; the files of a list by their literal names."""
    return path if isinstance(path, str) else [literal(p) for p in path]


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def _parse_whole(df: DataFrame, schema: T.StructType) -> DataFrame:
    """All rows, by a condition that always holds and needs every column.

    The text readers convert only the columns a query selects, and a bad value in
    any other column goes unnoticed. Here every column is converted, so that which
    rows are malformed is the same in every query.
    """
    return df.where(F.pmod(F.xxhash64(*schema.names), F.lit(2)) < 2)


def read_csv_landing(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    pattern: str | None = None,
    on_error: str = "CONTINUE",
) -> DataFrame:
    """CSV rows with load metadata; ``path`` is a folder or pattern, or a list of files.

    ``on_error``: CONTINUE leaves malformed rows out, ABORT fails on the first
    one, SPLIT keeps all rows and puts the text of the malformed ones into
    ``_corrupt_record``, for ``split_rejects``.
    """
    mode = {"CONTINUE": "DROPMALFORMED", "ABORT": "FAILFAST", "SPLIT": "PERMISSIVE"}[on_error]
    if on_error == "SPLIT":
        schema = with_corrupt_column(schema)
    df = spark.read.schema(schema).options(**CSV_OPTIONS, mode=mode).csv(_to_read(path))
    if pattern:
        df = filter_files(df, pattern)
    return with_load_metadata(_parse_whole(df, schema))


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Loaded rows and rejected lines of a SPLIT read."""
    loaded = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    rejected = df.where(F.col(CORRUPT).isNotNull()).select(CORRUPT, "load_ts", "source_file")
    return loaded, rejected


def _paths(spark: SparkSession, path: str | list[str], pattern: str | None) -> list[str]:
    """The matching files of a folder; a list of files stays as it is."""
    if not isinstance(path, str):
        return list(path)
    return sorted(r["file_id"] for r in list_files(spark, path, pattern).select("file_id").collect())


def footer_groups(
    spark: SparkSession, paths: list[str], on_error: str = "CONTINUE"
) -> tuple[list[tuple[T.StructType, list[str]]], list[str]]:
    """Parquet files grouped by columns that go together, and the unreadable ones.

    One job reads the footers of all files, however many kinds there are. ABORT raises
    on an unreadable file.
    """
    if not paths:
        return [], []
    groups, problems = shapes(read_footers(spark, paths))
    if problems and on_error == "ABORT":
        name, problem = min(problems.items())
        raise ValueError(f"{len(problems)} unreadable files, the first {name}: {problem}")
    return groups, sorted(problems)


def _parquet(spark: SparkSession, schema: T.StructType, files: list[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*map(literal, files))


def _cast_or_reject(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name ignoring case; a row with a value that fits its type nowhere is
    kept as text in ``_corrupt_record``."""
    present = {name.lower(): name for name in df.columns if name not in ("load_ts", "source_file")}
    values, bad = [], F.lit(False)
    for field in schema.fields:
        if field.name.lower() not in present:
            values.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        own = df.schema[present[field.name.lower()]].dataType
        source = F.col(f"`{present[field.name.lower()]}`")
        # Types between which there is no cast at all meet as text.
        as_is = isinstance(own, T.StringType | T.DatetimeType | T.TimestampNTZType) or (
            isinstance(own, T.NumericType | T.BooleanType)
            and not isinstance(field.dataType, T.DatetimeType | T.TimestampNTZType)
        )
        value = (source if as_is else source.cast("string")).try_cast(field.dataType)
        values.append(value.alias(field.name))
        bad = bad | (source.isNotNull() & value.isNull())
    text = F.when(bad, F.to_json(F.struct(*[F.col(f"`{c}`") for c in present.values()])))
    return df.select(*values, text.alias(CORRUPT), "load_ts", "source_file")


def _landed_schema(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [
            *with_corrupt_column(schema).fields,
            T.StructField("load_ts", T.TimestampNTZType()),
            T.StructField("source_file", T.StringType()),
        ]
    )


def _union(spark: SparkSession, parts: list[DataFrame], schema: T.StructType) -> DataFrame:
    out = parts[0] if parts else spark.createDataFrame([], schema)
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def split_parquet(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    pattern: str | None = None,
    on_error: str = "CONTINUE",
) -> DataFrame:
    """Parquet rows with load metadata; what does not fit ``schema`` as in a SPLIT read.

    Files are listed and matched first, so other feeds of the folder play no part.
    Files of different types, as of two integer widths, are read under their own and
    cast. An unreadable file gives one rejected row without text.
    """
    groups, unreadable = footer_groups(spark, _paths(spark, path, pattern), on_error)
    parts = []
    for own, files in groups:  # columns of these names would clash with the load metadata
        fields = [f for f in own if f.name.lower() not in ("load_ts", "source_file")]
        rows = with_load_metadata(_parquet(spark, T.StructType(fields), files))
        parts.append(_cast_or_reject(rows, schema))
    return _union(spark, [*parts, *_lost(spark, unreadable, schema)], _landed_schema(schema))


def _lost(spark: SparkSession, unreadable: list[str], schema: T.StructType) -> list[DataFrame]:
    """One rejected row without text for each unreadable file."""
    if not unreadable:
        return []
    lost = spark.createDataFrame([(f,) for f in unreadable], "source_file string")
    lost = lost.withColumns(
        {
            **{f.name: F.lit(None).cast(f.dataType) for f in schema.fields},
            CORRUPT: F.lit(""),
            "load_ts": F.current_timestamp().cast("timestamp_ntz"),
        }
    )
    return [lost.select(*_landed_schema(schema).names)]


def read_parquet_by_name(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    pattern: str | None = None,
    on_error: str = "CONTINUE",
    uniform: bool = False,
) -> DataFrame:
    """Parquet columns matched by name ignoring case, cast to ``schema``.

    CONTINUE leaves out unreadable files and rows with a value that cannot be cast;
    ``split_parquet`` keeps both. ABORT fails on the first one. ``uniform`` promises
    that the files hold the types of ``schema``; their footers are then not read
    beforehand, which matters for folders of very many files, and a file that breaks
    the promise fails the read.
    """
    if uniform:
        df = spark.read.schema(schema).parquet(path)
        return filter_files(df, pattern) if pattern else df
    if on_error == "ABORT":
        groups, _ = footer_groups(spark, _paths(spark, path, pattern), on_error)
        parts = [conform(_parquet(spark, own, files), schema) for own, files in groups]
        return _union(spark, parts, schema)
    df = split_parquet(spark, path, schema, pattern)
    return df.where(F.col(CORRUPT).isNull()).select(*schema.names)


VARIANT = T.StructType([T.StructField("raw_data", T.VariantType())])


def split_parquet_variant(
    spark: SparkSession,
    path: str | list[str],
    pattern: str | None = None,
    on_error: str = "CONTINUE",
) -> DataFrame:
    """Every Parquet row as one variant ``raw_data``, with load metadata.

    An unreadable file gives one row with an empty ``_corrupt_record`` and no data.
    """
    groups, unreadable = footer_groups(spark, _paths(spark, path, pattern), on_error)
    stored = _landed_schema(VARIANT)
    parts = []
    for own, files in groups:
        whole = F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in own.names]))
        lost = F.lit(None).cast("string").alias(CORRUPT)
        parts.append(_parquet(spark, own, files).select(whole.alias("raw_data"), lost, *load_metadata()))
    return _union(spark, [*parts, *_lost(spark, unreadable, VARIANT)], stored)


def read_parquet_variant(
    spark: SparkSession,
    path: str | list[str],
    pattern: str | None = None,
    on_error: str = "CONTINUE",
) -> DataFrame:
    """Every Parquet row as one variant column ``raw_data``, whatever its columns.

    CONTINUE leaves out unreadable files, which ``split_parquet_variant`` keeps; ABORT
    fails on the first one.
    """
    df = split_parquet_variant(spark, path, pattern, on_error)
    return df.where(F.col(CORRUPT).isNull()).select("raw_data")


def _json_elements(spark: SparkSession, path: str | list[str], pattern: str | None) -> DataFrame:
    """Elements of the array in each JSON file; a file without an array is one element.

    A file that is no JSON gives one row without element.
    """
    raw = spark.read.options(multiLine="true", singleVariantColumn="doc").json(_to_read(path))
    if pattern:
        raw = filter_files(raw, pattern)
    listed = F.coalesce(F.try_variant_get("doc", "$", "array<variant>"), F.array("doc"))
    return with_load_metadata(raw).select(
        F.explode_outer(listed).alias("element"), "load_ts", "source_file"
    )


def split_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    pattern: str | None = JSON_FILES,
) -> DataFrame:
    """One row per element of each file's array, as struct ``data``; an element with a
    value of the wrong type keeps its text in ``_corrupt_record`` and no ``data``."""
    df = _json_elements(spark, path, pattern)
    # The parser tells a value of the wrong type, at any depth, from an absent one.
    checked = df.withColumn(
        "parsed",
        F.from_json(
            F.to_json("element"),
            with_corrupt_column(schema),
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
        ),
    )
    bad = F.col("parsed").isNull() | F.col(f"parsed.{CORRUPT}").isNotNull()
    data = F.struct(*[F.col(f"parsed.{c}").alias(c) for c in schema.names])
    return checked.select(
        F.when(~bad, data).alias("data"),
        F.when(bad, F.coalesce(F.to_json("element"), F.lit(""))).alias(CORRUPT),
        "load_ts",
        "source_file",
    )


def read_json_landing(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    pattern: str | None = JSON_FILES,
) -> DataFrame:
    """One row per element of the array each JSON file holds, as struct ``data``.

    An element with a value of the wrong type is left out, alone; ``split_json`` keeps
    it. One task parses a file as a whole: land many files of moderate size.
    """
    df = split_json(spark, path, schema, pattern)
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def read_json_variant(spark: SparkSession, path: str, pattern: str | None = JSON_FILES) -> DataFrame:
    """As ``read_json_landing``, with ``data`` a variant and no schema needed."""
    return _json_elements(spark, path, pattern).select(F.col("element").alias("data"))


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Files of a landing folder, but for those of zero bytes. Contents are not read.

    ``file_id`` is the path as the file is named, equal to ``source_file`` of its rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    if pattern:
        files = files.where(F.col("path").rlike(f"^(?:{pattern})$"))
    return files.select(
        F.col("path").alias("file_id"),
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("file_bytes"),
        F.col("modificationTime").alias("modified_at"),
    )


def read_csv_positional(
    spark: SparkSession, path: str, columns: dict[str, tuple[int, str]], pattern: str | None = None
) -> DataFrame:
    """Typed columns by 1-based position over headed CSV files."""
    width = max(position for position, _ in columns.values())
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(1, width + 1)])
    df = spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)
    if pattern:
        df = filter_files(df, pattern)
    return df.select(*[to_type(f"c{i}", t).alias(name) for name, (i, t) in columns.items()])


def project_paths(df: DataFrame, columns: Paths, variant: str | None = None) -> DataFrame:
    """Typed columns by field path, over plain columns or inside a variant column."""
    if variant:
        return variant_fields(df, variant, columns)
    return df.select(*[F.col(path).try_cast(t).alias(name) for name, (path, t) in columns.items()])


# The virtual columns of the external tables.
EXTERNAL_POS = {
    "transaction_id": (1, "string"),
    "store_id": (2, "string"),
    "store_region": (5, "string"),
    "transaction_date": (8, "date"),
    "product_sku": (10, "string"),
    "total_amount": (17, "double"),
}
EXTERNAL_ERP_ORDERS = {
    "order_id": ("order_id", "string"),
    "store_id": ("store_id", "string"),
    "order_date": ("order_date", "date"),
    "category": ("category", "string"),
    "total_cost": ("total_cost", "double"),
}
EXTERNAL_ERP_INVENTORY = {
    "store_id": ("store_id", "string"),
    "product_sku": ("product_sku", "string"),
    "snapshot_date": ("snapshot_date", "date"),
    "quantity_on_hand": ("quantity_on_hand", "int"),
}
