"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockcast.llm import (
    bpe, class_lm, conversation_repair, exact_dedup, language, line_dedup, metric_tree, packing, periodic_runs, pii, quality,
    shingle_join, toxicity,
)
from stockcast.llm.text import read_documents

Query = Callable[[SparkSession, str], DataFrame]


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_documents(spark, sf_dir))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_languages(read_documents(spark, sf_dir))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.near_duplicates(read_documents(spark, sf_dir))


def op4_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.class_scores(read_documents(spark, sf_dir))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read_documents(spark, sf_dir))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_spans(read_documents(spark, sf_dir))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_documents(spark, sf_dir), _labels(spark, sf_dir))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read_documents(spark, sf_dir))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(read_documents(spark, sf_dir), _labels(spark, sf_dir))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return line_dedup.drop_boilerplate(pages, "page_id", line_dedup.host_of("url"), line_dedup.page_text("html"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(periodic_runs.find_runs(read_documents(spark, sf_dir), periodic_runs.with_planted_run))


def op12_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = metric_tree.whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
    return metric_tree.top_products(vectors, F.col("id") % 50 == 0, 5)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversation_repair.repair(conversation_repair.damaged(conversations), conversations)


QUERIES = (
    op1_packing, op2_language, op3_ngram_jaccard, op4_class_lm, op5_bpe, op6_pii, op7_toxicity, op8_exact_dedup,
    op9_quality_rules, op10_line_dedup, op11_periodic_runs, op12_top_products,
    op13_conversation_repair,
)
REGISTRY: dict[str, Query] = {f.__name__: f for f in QUERIES}
