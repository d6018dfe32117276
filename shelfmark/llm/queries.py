"""One query per operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import decontamination, duplicates, extraction, fingerprints, languages, oracles, packing, phrases, shards, substrings, tokens, topk, toxicity, tries
from .common import documents


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.near_duplicates(documents(spark, sf_dir))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(documents(spark, sf_dir))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(documents(spark, sf_dir))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.identify(documents(spark, sf_dir))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_bytes(documents(spark, sf_dir))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign_shards(documents(spark, sf_dir))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_near_duplicates, op2_main_text, op3_toxicity, op4_packing, op5_fingerprints, op6_token_counts, op7_language, op8_repeats, op9_shards, op10_decontamination, op11_prefix_trie, op12_collocations, op13_top_k, pipeline)
}
ORACLES: dict[str, str] = {"op11_prefix_trie": oracles.PREFIX_TRIE, "op12_collocations": oracles.COLLOCATIONS, "op13_top_k": oracles.TOP_K}
