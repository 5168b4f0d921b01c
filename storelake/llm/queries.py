"""The queries of this package, by the name under which they are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.llm import (
    collocations,
    exact_dedup,
    html_extract,
    license_scan,
    lm,
    mixing,
    packing,
    pii,
    quality,
    simhash,
    topk,
    toxicity,
    vector_codes,
)
from storelake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op2_pack_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_extract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op4_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(table(spark, sf_dir, "documents"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op8_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.language_scores(table(spark, sf_dir, "documents"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op10_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_toxicity_grammar,
        op2_pack_patterns,
        op3_extract_pages,
        op4_ball_tree_top_k,
        op5_simhash_components,
        op6_mix_sources,
        op7_exact_dedup,
        op8_attention_scores,
        op9_personal_data,
        op10_quality_lines,
        op11_vector_codes,
        op12_collocations,
        op13_license_scan,
    )
}
