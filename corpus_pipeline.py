"""From raw documents to packed training sequences: five stages, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import decontamination, duplicates, languages, packing, substrings
from shelfmark.llm.common import documents, stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language; those without letters go. The models are learned from the documents themselves."""
    return languages.identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words a shingle, likeness 0.8."""
    return duplicates.deduplicated(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of 200 bytes and more that repeat."""
    return substrings.without_repeats(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece with its sequence and place."""
    return packing.pack(docs)


STAGES = [
    ("language", identify_language), ("near_duplicates", drop_near_duplicates), ("repeats", cut_repeats), ("decontamination", drop_leaks), ("packing", pack_sequences),
]
ORACLE_SQL = None  # tokens, learned models and sketches are beyond SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
