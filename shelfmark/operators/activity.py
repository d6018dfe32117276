"""Activity facts per repository."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.clock import days_since, within_days
from ..schemas import REPOSITORY

COMMIT_DAYS, RELEASE_DAYS, CONTRIBUTOR_DAYS = 30, 90, 90


def rollup(facts: DataFrame, as_of) -> DataFrame:
    """Facts ``(id, kind, ts, who)`` of kind commit, release or contributor -> one row per id.

    One shuffle for all three kinds. The named windows count; there is no page cap.
    """
    kind = lambda k: F.col("kind") == k
    recent_people = F.when(kind("contributor") & within_days("ts", as_of, CONTRIBUTOR_DAYS), F.col("who"))
    grouped = facts.groupBy("id").agg(
        F.max(F.when(kind("commit"), F.col("ts"))).alias("last_commit"),
        F.count_if(kind("commit") & within_days("ts", as_of, COMMIT_DAYS)).alias("commits_30d"),
        F.count_if(kind("release") & within_days("ts", as_of, RELEASE_DAYS)).alias("releases_90d"),
        F.countDistinct(recent_people).alias("contributors_90d"),
        F.max(F.when(kind("release"), F.col("ts"))).alias("__release"),
    )
    return grouped.withColumns({
        "last_push_days": days_since("last_commit", as_of), "release_days": days_since("__release", as_of),
    }).drop("__release")


def estimate(as_of):
    """Activity struct when there are no facts: only the push date is known."""
    values = {"last_commit": F.col("pushed_at"), "last_push_days": days_since("pushed_at", as_of)}
    return F.struct(*[
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in REPOSITORY["activity"].dataType
    ])


def attach(records: DataFrame, facts: DataFrame | None, as_of) -> DataFrame:
    """Fill ``activity`` from facts, or estimate it where a record has none."""
    if facts is None:
        return records.withColumn("activity", estimate(as_of))
    names = [f.name for f in REPOSITORY["activity"].dataType]
    packed = rollup(facts, as_of).select("id", F.struct(*names).alias("__facts"))
    return records.join(packed, "id", "left").withColumn(
        "activity", F.coalesce("__facts", estimate(as_of))).drop("__facts").select(*records.columns)
