"""A training corpus from raw documents: filter, dedup, mix, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. Between stages rows are
written as Parquet in the shared folder and read again, so a lost executor costs one stage
at most. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from storelake.llm import exact_dedup, mixing, packing, quality, simhash
from storelake.llm.common import fold, table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line CRF rejects go."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    return quality.keep_good(docs, model)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints within two bits the one with the smallest doc_id stays.

    Fingerprints of three-word shingles, as the SimHash operator has them.
    """
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks; the last time maybe in part."""
    return mixing.mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every row in sequences of 4096 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_exact),
    ("near_dedup", drop_near),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: SQL cannot express the CRF, the fingerprints or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
