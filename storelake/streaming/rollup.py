"""Rollups kept current from mergeable partial results.

A batch stores sums, counts and distinct-count sketches per key. Reading merges
the stored partials, so the lines of earlier batches are never read again. Sums
and counts are exact; distinct counts are estimates and named so. What needs two
feeds keeps partials of each, and joins them merged.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from storelake.functions.numeric import exact_sum, ratio, round_dec
from storelake.plans.facts import STORE_GRAIN, cost_of_units, margin_rows, sales_lines, unit_cost
from storelake.plans.rollups import erp_cost_lines, margin_store
from storelake.sources.batches import (
    BATCH,
    claim,
    newest_base,
    read_batches,
    retire,
    write_base,
    write_batch,
)
from storelake.streaming.ingest import each_batch, run_of

SKETCH_LG_K = 14  # about one percent error

STORE_DAY = ["store_id", "store_name", "store_city", "store_region", "transaction_date"]
CATEGORY_REGION = ["category", "store_region"]


@dataclass(frozen=True)
class Partials:
    """Partial results of one feed: how lines become some, and how some become one per key.

    ``merge`` gives rows of the same columns, so that merged rows can be stored and
    merged again.
    """

    make: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]

    def schema(self, spark: SparkSession, lines: T.StructType) -> T.StructType:
        return self.make(spark.createDataFrame([], lines)).schema


def partials(lines: DataFrame, keys: list[str]) -> DataFrame:
    return sales_lines(lines).groupBy(*keys).agg(
        exact_sum("total_amount").alias("revenue"),
        F.sum("quantity").cast("bigint").alias("units"),
        F.count("*").alias("lines"),
        F.hll_sketch_agg("transaction_id", SKETCH_LG_K).alias("txn_sketch"),
        F.hll_sketch_agg("customer_id", SKETCH_LG_K).alias("customer_sketch"),
    )


def merge_partials(stored: DataFrame, keys: list[str]) -> DataFrame:
    return stored.groupBy(*keys).agg(
        _sum("revenue"),
        F.sum("units").alias("units"),
        F.sum("lines").alias("lines"),
        F.hll_union_agg("txn_sketch").alias("txn_sketch"),
        F.hll_union_agg("customer_sketch").alias("customer_sketch"),
    )


def _sum(name: str) -> Column:
    """Exact sums added up, in the type of ``exact_sum``."""
    return F.sum(name).cast("decimal(28,4)").alias(name)


def sales_by(keys: list[str]) -> Partials:
    return Partials(lambda lines: partials(lines, keys), lambda rows: merge_partials(rows, keys))


#: What margins need of sales: revenue and units by store and category.
MARGIN_SALES = Partials(
    lambda lines: lines.where(F.col("total_amount") > 0)
    .groupBy(*STORE_GRAIN)
    .agg(exact_sum("total_amount").alias("revenue"), F.sum("quantity").cast("bigint").alias("units")),
    lambda rows: rows.groupBy(*STORE_GRAIN).agg(_sum("revenue"), F.sum("units").alias("units")),
)
#: What margins need of purchases: unit costs, as sum and count, by store and category.
MARGIN_COSTS = Partials(
    lambda lines: lines.where(F.col("unit_cost") > 0)
    .groupBy("store_id", "category")
    .agg(exact_sum("unit_cost").alias("unit_costs"), F.count("unit_cost").alias("lines")),
    lambda rows: rows.groupBy("store_id", "category").agg(_sum("unit_costs"), F.sum("lines").alias("lines")),
)
#: Purchase cost per category, from variant rows.
CATEGORY_COST = Partials(
    lambda raw: erp_cost_lines(raw).groupBy("category").agg(exact_sum("total_cost").alias("cost")),
    lambda rows: rows.groupBy("category").agg(_sum("cost")),
)


def _stored(
    spark: SparkSession, root: str, schema: T.StructType, upto: int | None = None
) -> DataFrame:
    """The newest base, below batch ``upto`` if given, and the partials after it."""
    version = newest_base(spark, f"{root}/base", before=upto)
    last = None if upto is None else upto + 1
    rows = read_batches(spark, f"{root}/partials", schema, version, last).drop(BATCH)
    if version < 0:
        return rows
    return rows.unionByName(spark.read.schema(schema).parquet(f"{root}/base/v={version}"))


def read_merged(spark: SparkSession, root: str, lines: T.StructType, kind: Partials) -> DataFrame:
    """One row per key of what ``maintain`` has stored under ``root``."""
    return kind.merge(_stored(spark, root, kind.schema(spark, lines)))


def maintain(
    spark: SparkSession,
    src: str,
    lines: T.StructType,
    kind: Partials,
    root: str,
    ckpt: str,
    compact_every: int = 200,
    max_files: int | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Lines appended to ``src`` added to the partial results under ``root``.

    Every ``compact_every`` batches the partials fold into a base. ``root`` belongs to one
    checkpoint, which numbers its batches.
    """
    claim(spark, root, run_of(ckpt))
    schema = kind.schema(spark, lines)
    reader = spark.readStream.schema(lines)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def step(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        write_batch(kind.make(batch), f"{root}/partials", batch_id)
        if (batch_id + 1) % compact_every == 0:
            stored = _stored(session, root, schema, upto=batch_id)
            write_base(kind.merge(stored), f"{root}/base", batch_id)
            retire(session, f"{root}/base", f"{root}/partials")

    return each_batch(reader.parquet(src), step, ckpt, interval)


def read_rollup(spark: SparkSession, root: str, lines: T.StructType, keys: list[str]) -> DataFrame:
    merged = read_merged(spark, root, lines, sales_by(keys))

    def distinct(sketch: str) -> Column:
        return F.hll_sketch_estimate(sketch)

    return merged.select(
        *keys,
        round_dec("revenue", 2).alias("revenue"),
        F.col("units").alias("units_sold"),
        F.col("lines").alias("n_lines"),
        ratio("revenue", "lines", 2).alias("avg_basket"),
        distinct("txn_sketch").alias("approx_txns"),
        distinct("customer_sketch").alias("approx_customers"),
    )


def maintain_rollup(
    spark: SparkSession,
    src: str,
    lines: T.StructType,
    keys: list[str],
    root: str,
    ckpt: str,
    compact_every: int = 200,
    max_files: int | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Sales lines appended to ``src`` added to the rollup by ``keys`` under ``root``."""
    return maintain(
        spark, src, lines, sales_by(keys), root, ckpt, compact_every, max_files, interval
    )


def read_margin_fact(
    spark: SparkSession, sales: str, pos: T.StructType, costs: str, erp: T.StructType
) -> DataFrame:
    """Margins by store and category from the partials of sales and of purchases.

    The two feeds meet when read, at one row per store and category each, so a margin
    follows whichever of them has grown, and neither feed's lines are read again.
    """
    sold = read_merged(spark, sales, pos, MARGIN_SALES).select(
        *STORE_GRAIN,
        round_dec("revenue", 2).alias("total_revenue"),
        F.col("units").alias("total_units_sold"),
    )
    bought = read_merged(spark, costs, erp, MARGIN_COSTS).select(
        "store_id", "category", unit_cost(F.col("unit_costs"), F.col("lines"))
    )
    return margin_rows(sold, bought, cost_of_units())


def read_margin_store(
    spark: SparkSession, sales: str, pos: T.StructType, costs: str, erp: T.StructType
) -> DataFrame:
    """``rollups.margin_store`` of the margins kept current."""
    return margin_store(read_margin_fact(spark, sales, pos, costs, erp))


def read_erp_category(spark: SparkSession, root: str, raw: T.StructType) -> DataFrame:
    """``rollups.erp_category`` of the costs kept current."""
    merged = read_merged(spark, root, raw, CATEGORY_COST)
    return merged.select("category", F.col("cost").cast("double").alias("total_sales"))
