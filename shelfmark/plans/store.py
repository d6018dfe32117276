"""Saving a collection run: keyed merge of the stored tables with the new ones, into a new folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import content
from ..operators.keyed import insert_absent, latest_per_key, upsert, upsert_findings
from ..session import staged
from ..sources.tables import CONTENT_BUCKETS, write_content
from .maintain import score_all

_KEYS = {
    "sources": ["repository_id", "source_repository", "source_section"],
    "categories": ["name"],
    "bridge": ["repository_id", "category"],
}


def save_records(spark: SparkSession, records: DataFrame, new_path: str, old_path: str | None = None) -> int:
    """Scored or refreshed records by id over the stored ones; returns how many were processed."""
    incoming = staged(records if "seq" in records.columns else records.withColumn("seq", F.lit(0).cast("bigint")), "records")
    merged = upsert(spark.read.parquet(f"{old_path}/records"), incoming, ["id"]) if old_path else latest_per_key(incoming, ["id"]).drop("seq")
    merged.write.mode("errorifexists").parquet(f"{new_path}/records")
    return incoming.count()


def save_scores(spark: SparkSession, path: str, new_path: str, facts: DataFrame | None, as_of, weights: dict | None = None) -> int:
    """Score all stored records and save them under the new path; returns how many."""
    scored = score_all(spark.read.parquet(f"{path}/records"), facts, as_of, weights)
    scored.write.mode("errorifexists").parquet(f"{new_path}/records")
    return spark.read.parquet(f"{new_path}/records").count()


def save_extraction(spark: SparkSession, made: dict[str, DataFrame], path: str, buckets: int = CONTENT_BUCKETS) -> DataFrame:
    """Save the documents of an extraction; statuses and report come from what was saved. Returns the report."""
    write_content(made["documents"], f"{path}/content", buckets)
    saved = spark.read.parquet(f"{path}/content")
    content.statuses(made["selected"], saved).write.mode("overwrite").parquet(f"{path}/statuses")
    return content.report(spark.read.parquet(f"{path}/statuses"))


def save_findings(spark: SparkSession, findings: DataFrame, new_path: str, old_path: str | None = None) -> int:
    """Findings over the stored ones, on a conflict only with new severity, summary and time; returns how many were processed."""
    incoming = staged(findings.withColumn("seq", F.lit(0).cast("bigint")), "findings")
    stored = spark.read.parquet(f"{old_path}/findings") if old_path else findings.limit(0)
    upsert_findings(stored, incoming).write.mode("errorifexists").parquet(f"{new_path}/findings")
    return incoming.count()


def save(spark: SparkSession, made: dict[str, DataFrame], new_path: str, old_path: str | None = None) -> None:
    """Records are replaced by id; edges, categories and bridge rows are added when absent.

    The old folder is only read, so a lost executor or a failed run leaves it usable. A dry run is
    a run that is not saved.
    """
    incoming = made["records"]
    if "seq" not in incoming.columns:
        incoming = incoming.withColumn("seq", F.lit(0).cast("bigint"))
    stored = lambda name: spark.read.parquet(f"{old_path}/{name}")
    if old_path:  # ids alone are counted, so that whole rows are ranked only where an id repeats
        once = incoming.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
        merged = upsert(stored("records"), incoming, ["id"], once=once)
    else:
        merged = incoming.drop("seq")
    merged.write.mode("errorifexists").parquet(f"{new_path}/records")
    for name, keys in _KEYS.items():
        rows = insert_absent(stored(name), made[name], keys) if old_path else made[name].dropDuplicates(keys)
        rows.write.mode("errorifexists").parquet(f"{new_path}/{name}")
