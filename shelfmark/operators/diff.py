"""Change detection between two daily snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import constants as K
from ..functions import compare as C
from .keyed import latest_per_key

DIGEST = "digest"


def _packed(df: DataFrame, order: str | None, name: str) -> DataFrame:
    rows = latest_per_key(df, ["id"], order) if order else df
    star = F.struct(*C.comparable(rows.columns), F.col("name") if "name" in rows.columns else F.lit(None).cast("string").alias("name"))
    return rows.select(F.col("id"), star.alias(name), C.snapshot_status(
        F.col("health_status") if "health_status" in rows.columns else F.lit(None).cast("string"),
        F.col("health.status") if "health" in rows.columns else F.lit(None).cast("string"),
    ).alias(f"{name}_status"))


def align(old: DataFrame, new: DataFrame, order: str | None = None) -> DataFrame:
    """Full outer join on id: ``old`` and ``new`` structs of the compared fields.

    With ``order`` given, the last row of a repeated id wins first; that window and the join
    use the same partitioning, so the rows are shuffled once.
    """
    return _packed(old, order, "old").join(_packed(new, order, "new"), "id", "full_outer")


def changes(old: DataFrame, new: DataFrame, as_of, order: str | None = None) -> DataFrame:
    """One row per id with every change flag; all diff results are filters over it."""
    rows = align(old, new, order)
    here, before = F.col("new").isNotNull(), F.col("old").isNotNull()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    both = here & before
    out = rows.withColumns({
        "presence": F.when(both, "both").when(here, "new").otherwise("removed"),
        "star_gain": F.when(both, zero("new.stars") - zero("old.stars")),
        "changes": F.when(both, C.change_map("old", "new")),
    })
    return out.withColumns({
        "is_trending": F.coalesce(F.col("star_gain") >= K.TRENDING_GAIN, F.lit(False)),
        "is_updated": F.coalesce(F.cardinality("changes") > 0, F.lit(False)),
        "is_stale": here & C.is_stale(F.col("new_status"), F.col("new.pushed_at"), as_of),
        "is_archived": here & C.is_archived(F.col("new_status"), F.col("new.archived")),
    })


def with_digest(rows: DataFrame) -> DataFrame:
    """Add ``digest``, 128 bits of all compared fields as they are compared: stored with a snapshot, it tells whether a row changed."""
    fields = rows.select("*", F.struct(*C.comparable(rows.columns)).alias("__f"))
    texts = F.struct(*[C.as_text(name, F.col(f"__f.{name}")).alias(name) for name in K.DIFF_FIELDS])
    return fields.withColumn(DIGEST, F.md5(F.to_json(texts))).drop("__f")


def flagged(old: DataFrame, new: DataFrame, as_of) -> DataFrame:
    """The rows of :func:`changes` with a flag set or on one side only, from snapshots unique by id.

    Ids and digests are compared first. Whole rows are read again only for ids whose digests differ, and joined among
    themselves; of the others, the new rows that are stale or archived are added as they are.
    """
    old, new = (df if DIGEST in df.columns else with_digest(df) for df in (old, new))
    pairs = old.select("id", F.col(DIGEST).alias("__old")).join(new.select("id", F.col(DIGEST).alias("__new")), "id", "full_outer")
    moved = pairs.filter(~F.col("__old").eqNullSafe(F.col("__new"))).select("id")
    part = lambda df: df.join(moved, "id", "left_semi")
    seen = changes(part(old), part(new), as_of)
    same = _packed(new, None, "new").filter(
        C.is_stale(F.col("new_status"), F.col("new.pushed_at"), as_of) | C.is_archived(F.col("new_status"), F.col("new.archived"))
    ).join(moved, "id", "left_anti")
    as_before = same.withColumns({
        "old": F.col("new"), "old_status": F.col("new_status"), "presence": F.lit("both"), "star_gain": F.lit(0).cast(dict(seen.dtypes)["star_gain"]),
        "changes": F.create_map().cast(dict(seen.dtypes)["changes"]), "is_trending": F.lit(False), "is_updated": F.lit(False),
        "is_stale": C.is_stale(F.col("new_status"), F.col("new.pushed_at"), as_of), "is_archived": C.is_archived(F.col("new_status"), F.col("new.archived")),
    })
    return seen.unionByName(as_before)


def flagged_between(snapshots: DataFrame, date1: str, date2: str, as_of) -> DataFrame:
    """:func:`flagged` for two dates of a date-partitioned snapshot table."""
    return flagged(*_two(snapshots, date1, date2), as_of)


def new_records(old: DataFrame, new: DataFrame) -> DataFrame:
    return new.join(old.select("id"), "id", "left_anti")


def removed_records(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.join(new.select("id"), "id", "left_anti")


def summary(changed: DataFrame) -> DataFrame:
    return changed.agg(
        F.count_if(F.col("presence") == "new").alias("new_count"),
        F.count_if("is_trending").alias("trending_count"),
        F.count_if("is_updated").alias("updated_count"),
        F.count_if("is_stale").alias("stale_count"),
        F.count_if("is_archived").alias("archived_count"),
        F.count_if(F.col("presence") == "removed").alias("removed_count"),
    )


def change_rows(changed: DataFrame) -> DataFrame:
    """``(id, field, from, to)`` for each differing field."""
    return changed.filter("is_updated").select("id", F.explode("changes").alias("field", "v")).select(
        "id", "field", "v.from", "v.to")


def between(snapshots: DataFrame, date1: str, date2: str, as_of, order: str | None = None) -> DataFrame:
    """Changes between two dates of a date-partitioned snapshot table."""
    return changes(*_two(snapshots, date1, date2), as_of, order)


def _two(snapshots: DataFrame, date1: str, date2: str) -> tuple[DataFrame, DataFrame]:
    old = snapshots.filter(F.col("date") == date1)
    new = snapshots.filter(F.col("date") == date2)
    for date, frame in ((date1, old), (date2, new)):
        if frame.isEmpty():
            raise ValueError(f"no snapshot for {date}")
    return old, new
