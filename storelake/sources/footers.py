"""Columns of Parquet files from their footers: one Spark job, whatever the mix of types."""

from __future__ import annotations

import io
import json
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Where Spark keeps the columns of a file it wrote.
SPARK_COLUMNS = b"org.apache.spark.sql.parquet.row.metadata"
FOOTER = "source_file string, columns string, problem string"
_UNSIGNED = {
    "uint8": T.ShortType(), "uint16": T.IntegerType(),
    "uint32": T.LongType(), "uint64": T.DecimalType(20, 0),
}
_PLAIN = {
    "bool": T.BooleanType(), "int8": T.ByteType(), "int16": T.ShortType(),
    "int32": T.IntegerType(), "int64": T.LongType(), "float": T.FloatType(),
    "double": T.DoubleType(), "string": T.StringType(), "large_string": T.StringType(),
    "binary": T.BinaryType(), "large_binary": T.BinaryType(), "date32[day]": T.DateType(),
    **_UNSIGNED,
}


def spark_type(kind: pa.DataType, int96: bool = False) -> T.DataType:
    """The type under which Spark reads a Parquet column; TypeError if there is none."""
    if plain := _PLAIN.get(str(kind)):
        return plain
    if pa.types.is_dictionary(kind):
        return spark_type(kind.value_type)
    if pa.types.is_fixed_size_binary(kind):
        return T.BinaryType()
    if pa.types.is_decimal128(kind):
        return T.DecimalType(kind.precision, kind.scale)
    if pa.types.is_timestamp(kind) and (int96 or kind.unit in ("ms", "us")):
        return T.TimestampType() if int96 or kind.tz else T.TimestampNTZType()
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        return T.ArrayType(spark_type(kind.value_type))
    if pa.types.is_struct(kind):
        return T.StructType([T.StructField(f.name, spark_type(f.type)) for f in kind])
    if pa.types.is_map(kind):
        return T.MapType(spark_type(kind.key_type), spark_type(kind.item_type))
    raise TypeError(f"no type for {kind}")


def columns_of(source) -> T.StructType:
    """The columns of an open Parquet file."""
    file = pq.ParquetFile(source)
    stored = (file.metadata.metadata or {}).get(SPARK_COLUMNS)
    if stored:
        return _nullable(T.StructType.fromJson(json.loads(stored)))
    leaves = [file.schema.column(i) for i in range(len(file.schema))]
    old = {c.path for c in leaves if c.physical_type == "INT96"}
    fields = file.schema_arrow
    return T.StructType([T.StructField(f.name, spark_type(f.type, f.name in old)) for f in fields])


def _nullable(schema: T.StructType) -> T.StructType:
    """Files hold what they hold: whether nulls were allowed tells nothing apart."""
    text = schema.json()
    for flag in ("nullable", "containsNull", "valueContainsNull"):
        text = text.replace(f'"{flag}":false', f'"{flag}":true')
    return T.StructType.fromJson(json.loads(text))


def _opened(path: str):
    """The file at a plain path, in any store that pyarrow reaches."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return pafs.LocalFileSystem().open_input_file(rest.removeprefix("//") if colon else path)
    store, inside = pafs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")
    return store.open_input_file(inside)


def _reachable(path: str) -> bool:
    scheme, colon, _ = path.partition(":")
    return not colon or scheme in ("file", "hdfs", "s3", "gs", "gcs", "abfs", "abfss")


def _each(open_one: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            names, columns, problems = batch.column(0).to_pylist(), [], []
            for i in range(batch.num_rows):
                found = problem = None
                try:
                    found = columns_of(open_one(batch, i)).json()
                except (OSError, ValueError, TypeError, pa.ArrowException) as error:
                    problem = str(error)[:500]
                columns.append(found)
                problems.append(problem)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.string()) for x in (names, columns, problems)],
                names=["source_file", "columns", "problem"],
            )

    return run


def read_footers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(source_file, columns, problem) of each Parquet file, read by the executors.

    ``columns`` is the schema as JSON, null where ``problem`` says why there is none. Only
    footers are fetched, but in a store that only Spark reaches a file comes whole.
    """
    near = [p for p in paths if _reachable(p)]
    listed = spark.createDataFrame([(p,) for p in near], "source_file string")
    out = listed.mapInArrow(_each(lambda b, i: _opened(b.column(0)[i].as_py())), FOOTER)
    if len(near) == len(paths):
        return out
    far = [literal(p) for p in paths if not _reachable(p)]
    whole = spark.read.format("binaryFile").load(far).select("path", "content")
    return out.unionByName(
        whole.mapInArrow(_each(lambda b, i: io.BytesIO(b.column(1)[i].as_py())), FOOTER)
    )


def literal(path: str) -> str:
    """A path that stands for itself: Spark's readers take ``* ? [ ] { } \\`` for patterns."""
    return "".join("\\" + c if c in "*?[]{}\\" else c for c in path)


def shapes(footers: DataFrame) -> tuple[list[tuple[T.StructType, list[str]]], dict[str, str]]:
    """Files by columns that go together, and the problem of each file without columns.

    One row per kind of footer comes to the driver, with the names of its files, which
    the driver lists anyway. Kinds that agree in the types of their common columns
    become one group.
    """
    kinds = (
        footers.groupBy("columns", "problem")
        .agg(F.sort_array(F.collect_list("source_file")).alias("files"))
        .collect()
    )
    kinds.sort(key=lambda r: r["files"])
    problems = {f: r["problem"] for r in kinds if r["columns"] is None for f in r["files"]}
    groups: list[tuple[dict[str, T.StructField], list[str]]] = []
    for r in kinds:
        if r["columns"] is None:
            continue
        own = {f.name: f for f in T.StructType.fromJson(json.loads(r["columns"]))}
        for known, files in groups:
            if _agree(known, own):
                known.update(own)
                files.extend(r["files"])
                break
        else:
            groups.append((own, list(r["files"])))
    return [(T.StructType(list(known.values())), files) for known, files in groups], problems


def _agree(one: dict[str, T.StructField], other: dict[str, T.StructField]) -> bool:
    by_case = {name.lower(): field for name, field in one.items()}
    return all(
        by_case.get(name.lower(), field) == field for name, field in other.items()
    )
