"""From raw documents to packed training sequences, stage by stage over written tables.

Rows without an id pass filters by id, are compared by their text as copies and near copies, and are packed like others. Empty and null texts are equal
to each other, so one of them stays. All stages but the last keep the columns they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockcast.llm import exact_dedup, packing, pii, shingle_join, toxicity
from stockcast.llm.text import materialize, read_documents


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at or above the toxicity threshold go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised texts, the one with the smallest id stays."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.75 on five-word shingles, the one with the smallest id stays."""
    return shingle_join.keep_one_per_group(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; personal data in it is replaced by its kind."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and place."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("PII", mask_personal_data),
    ("best-fit packing", pack),
]

#: learned stages, trees and packing are not expressible in SQL; tests/llm compares the stages with plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
