"""Records due for a refresh, and merging what came back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import constants as K
from ..functions.clock import days_since
from ..functions.scoring import is_due, push_health
from ..functions.urls import WEB_PREFIX
from ..schemas import REPOSITORY
from .keyed import first_per_key


def with_due(records: DataFrame, as_of, policy: dict[str, int] | None = None) -> DataFrame:
    return records.withColumn("due", is_due(F.col("health.status"), F.col("collected_at"), as_of, policy))


def select_due(records: DataFrame, as_of, policy=None, limit: int | None = None) -> DataFrame:
    """Due records; with a limit the longest unchecked come first."""
    due = with_due(records, as_of, policy).filter("due").drop("due")
    return due.orderBy(F.asc_nulls_first("collected_at"), F.asc("id")).limit(limit) if limit else due


def merge(old: DataFrame, fresh: DataFrame, as_of) -> DataFrame:
    """Fresh facts replace the row; id, owner, name, curated info, sources and score stay.

    Health comes from the push date, the url from the id, and ``collected_at`` is the time of the refresh. Of several
    fresh rows of an id the one collected last is taken. Rows without fresh data are not returned.
    """
    fresh = first_per_key(fresh, ["id"], [F.col("collected_at").desc_nulls_last(), F.col("pushed_at").desc_nulls_last()])
    kept = ["owner", "name", "awesome", "sources", "score"]
    health = F.struct(
        push_health("f.pushed_at", as_of).alias("status"), days_since("f.pushed_at", as_of).alias("last_commit_days"),
        F.lit(None).cast("bigint").alias("release_days"), F.lit(None).cast("bigint").alias("contributors_90d"))
    made = {
        "health": health, "collected_at": F.lit(as_of).cast("timestamp"),
        "url": F.concat(F.lit(WEB_PREFIX), F.substr("o.id", F.lit(len(K.PLATFORM) + 2))),
    }
    pick = lambda n: made[n] if n in made else F.col(f"o.{n}") if n in kept or n == "id" else F.col(f"f.{n}")
    return old.alias("o").join(fresh.alias("f"), F.col("o.id") == F.col("f.id")).select(
        *[pick(n).alias(n) for n in REPOSITORY.fieldNames()])


def report(records: DataFrame, fresh: DataFrame, as_of, policy=None, limit: int | None = None) -> DataFrame:
    """checked, updated, skipped (not due or cut by the limit), failed, due.

    Only ids, check times and two flags go into the join. Without a limit one pass counts everything; with one, the few
    chosen ids are counted by themselves.
    """
    flagged = with_due(records, as_of, policy).select("id", "collected_at", "due")
    found = fresh.select("id").distinct().withColumn("ok", F.lit(True))
    whole = [F.count("*").alias("total"), F.count_if("due").alias("due")]
    if not limit:
        counted = flagged.join(found, "id", "left").agg(*whole, F.count_if(F.col("due") & F.col("ok")).alias("updated")).withColumn("checked", F.col("due"))
    else:
        chosen = flagged.filter("due").orderBy(F.asc_nulls_first("collected_at"), F.asc("id")).limit(limit).select("id")
        counts = chosen.join(found, "id", "left").agg(F.count("*").alias("checked"), F.count_if("ok").alias("updated"))
        counted = counts.withColumn("__w", flagged.agg(F.struct(*whole)).scalar()).select("checked", "updated", "__w.*")
    return counted.select(
        "checked", "updated", (F.col("total") - F.col("checked")).alias("skipped"),
        (F.col("checked") - F.col("updated")).alias("failed"), "due")
