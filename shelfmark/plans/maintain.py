"""Scoring, refreshing, enriching and extracting over the stored catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import constants as K
from ..functions.scoring import record_health, record_parts, weigh
from ..operators import activity, catalog, content, findings, refresh
from ..schemas import OSV_RESPONSE, REPOSITORY
from ..session import staged
from ..sources import feeds


def score_all(records: DataFrame, facts: DataFrame | None, as_of, weights: dict | None = None,
              strict_reference: bool = False) -> DataFrame:
    """Records with activity, score and health filled: one join, then narrow projections.

    The components are computed one projection before they are weighed. Each is used twice there,
    so the projections stay apart and each is compiled to a method the JVM still optimizes.
    """
    filled = activity.attach(records, facts, as_of)
    parts = record_parts(strict_reference)
    staged = filled.withColumns({f"__{name}": units for name, units in parts.items()})
    named = {name: F.col(f"__{name}") for name in parts}
    return staged.withColumns({"score": weigh(named, weights), "health": record_health()}).select(*records.columns)


def refresh_due(records: DataFrame, fresh: DataFrame, as_of, policy=None, limit: int | None = None) -> dict[str, DataFrame]:
    """Due records merged with fresh ones, and the report."""
    due = refresh.select_due(records, as_of, policy, limit)
    return {
        "records": refresh.merge(due, fresh, as_of),
        "report": refresh.report(records, fresh, as_of, policy, limit),
    }


def enrich(records: DataFrame, osv, kev, cve, observed_at, min_stars: int = 0,
           errors: DataFrame | None = None) -> dict[str, DataFrame]:
    """Findings and report. The packages and the findings are staged, so the report repeats neither feeds nor joins."""
    owners = staged(findings.package_owners(catalog.min_stars(records, min_stars)), "owners")
    found = staged(findings.enrich(records, osv, kev, cve, observed_at, min_stars, owners=owners), "findings")
    return {"findings": found, "report": findings.report(records, found, errors, min_stars, owners=owners)}


def enrich_feeds(records: DataFrame, paths: dict[str, str], observed_at, min_stars: int = 0,
                 staging: str | None = None) -> dict[str, DataFrame]:
    """Findings of the feeds in files, one message per broken document or feed, and the report.

    A broken document or feed costs its own findings only. ``paths`` names the files of osv, kev and cve, or some of them.
    """
    spark = records.sparkSession
    frames, errors = feeds.load(spark, paths, staging)
    if not any(frame is not None for frame in frames.values()):
        frames["osv"] = spark.createDataFrame([], OSV_RESPONSE)
    made = enrich(records, frames["osv"], frames["kev"], frames["cve"], observed_at, min_stars, errors)
    return made | {"errors": errors}


def extract(records: DataFrame, files: DataFrame, min_score: float = 0.0,
            max_repositories: int = K.MAX_REPOSITORIES, **limits) -> dict[str, DataFrame]:
    """Documents and statuses of the best records."""
    selected = staged(content.select_records(records, min_score, max_repositories), "selected")
    docs = content.documents(selected, files, **limits)
    status = content.statuses(selected, docs)
    return {"selected": selected, "documents": docs, "statuses": status, "report": content.report(status)}


def scored_flat(scored: DataFrame) -> DataFrame:
    return scored.select(
        *[c for c in REPOSITORY.fieldNames() if c not in ("score", "health")],
        F.col("score.overall").alias("score_overall"), F.col("health.status").alias("health_status"))
