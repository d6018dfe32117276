"""Keyed tables: first wins, latest wins, upserts and insert-if-absent.

Every ``row_number() == 1`` below is planned with a partial group limit in front of the
shuffle, so one key that holds a third of all rows ships one row per input task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

def _columns(keys) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def with_rank(df: DataFrame, keys, order, n: int, name: str = "rank") -> DataFrame:
    """The first ``n`` rows of each key with their position. Null is a key value of its own."""
    window = Window.partitionBy(*_columns(keys)).orderBy(*_columns(order))
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)


def top_per_key(df: DataFrame, keys, order, n: int = 1) -> DataFrame:
    return with_rank(df, keys, order, n, "__rank").drop("__rank")


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    return top_per_key(df, keys, order, 1)


def latest_per_key(df: DataFrame, keys, order: str = "seq") -> DataFrame:
    return top_per_key(df, keys, [F.col(order).desc_nulls_last()], 1)


def upsert(existing: DataFrame, incoming: DataFrame, keys, order: str = "seq", once: bool = False) -> DataFrame:
    """Whole-row replacement by key; among incoming rows the highest ``order`` wins.

    Only the incoming rows are ranked, or not even these where each key is known to come ``once``. The existing ones, unique
    by key, pass an anti join with the incoming keys as they come, which Spark broadcasts where they are few; they are
    neither sorted nor windowed.
    """
    new = (incoming if once else latest_per_key(incoming, keys, order)).drop(order)
    touched = incoming.select(*[F.col(k).alias(f"__{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    kept = existing.drop(order).join(touched, same, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def insert_absent(existing: DataFrame, incoming: DataFrame, keys) -> DataFrame:
    """Add rows whose key is new; rows already there stay as they are."""
    fresh = incoming.dropDuplicates(list(keys)).join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(fresh)


def upsert_repositories(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Flat repository rows by id; a null status becomes UNKNOWN, a null score 0."""
    filled = incoming.withColumns({
        "health_status": F.coalesce("health_status", F.lit("UNKNOWN")),
        "score_overall": F.coalesce("score_overall", F.lit(0.0)),
    })
    return upsert(existing, filled, ["id"])


def upsert_daily_metrics(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    return upsert(existing, incoming, ["repository_id", "date"])


FINDING_KEY = ["source", "advisory_id", "package", "repository_id"]
_FIRST, _NEWEST = ["ecosystem", "url", "cve_ids"], ["severity", "summary", "observed_at"]


def reduced_findings(incoming: DataFrame) -> DataFrame:
    """One row per key: newest severity, summary and time by ``seq``, and what the first row has of all else."""
    rank = F.coalesce(F.col("seq").cast("bigint"), F.lit(-1))
    merged = incoming.withColumns({k: F.coalesce(k, F.lit("")) for k in FINDING_KEY}).groupBy(*FINDING_KEY).agg(
        F.max_by(F.struct(*_NEWEST), rank).alias("n"), F.min_by(F.struct(*_FIRST), rank).alias("o"))
    return merged.select(*FINDING_KEY, *(f"n.{c}" for c in _NEWEST), *(f"o.{c}" for c in _FIRST))


def merge_findings(existing: DataFrame, reduced: DataFrame) -> DataFrame:
    """Stored findings, unique by key, with reduced new ones: one join, and no aggregate of the stored side.

    On a key conflict only severity, summary and observed_at are replaced.
    """
    stored = existing.select(*(F.coalesce(k, F.lit("")).alias(k) for k in FINDING_KEY), F.struct(*_NEWEST, *_FIRST).alias("s"))
    delta = reduced.select(*FINDING_KEY, F.struct(*_NEWEST, *_FIRST).alias("d"))
    pick = lambda first, then, c: F.when(F.col(first).isNotNull(), F.col(f"{first}.{c}")).otherwise(F.col(f"{then}.{c}")).alias(c)
    columns = {c: pick("d", "s", c) for c in _NEWEST} | {c: pick("s", "d", c) for c in _FIRST}
    columns["cve_ids"] = F.coalesce(columns["cve_ids"], F.array().cast("array<string>")).alias("cve_ids")
    return stored.join(delta, FINDING_KEY, "full_outer").select(
        *FINDING_KEY, *(columns[c] for c in ("ecosystem", "severity", "summary", "url", "cve_ids", "observed_at")))


def upsert_findings(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """On a key conflict only severity, summary and observed_at are replaced."""
    return merge_findings(existing, reduced_findings(incoming))


def category_rows(assigned: DataFrame) -> DataFrame:
    """Category table ``(name, parent)`` from ``(repository_id, category, parent, seq)``.

    Parents become rows of their own without a parent; a leaf keeps the first parent it got. A parent row is written
    before the leaves of the same record, hence the step. ``seq`` may be of any ordered type; null comes first.

    The rows are read once and reduced to one for each category and parent, by hash where ``seq`` is a number; what is
    ordered and compared after that is as small as the taxonomy.
    """
    first = F.when(~F.max(F.col("seq").isNull()), F.min("seq"))
    pairs = assigned.groupBy("category", "parent").agg(first.alias("seq"))
    has_parent = F.coalesce((F.col("parent") != "") & (F.col("parent") != F.col("category")), F.lit(False))
    row = lambda name, step, parent: F.struct(F.col(name).alias("name"), F.struct("seq", F.lit(step).alias("step"), parent.alias("parent")).alias("f"))
    leaf, root = row("category", 1, F.when(has_parent, F.col("parent"))), row("parent", 0, F.lit(None).cast("string"))
    rows = pairs.select(F.explode(F.when(F.col("parent").isNull(), F.array(leaf)).otherwise(F.array(leaf, root))).alias("r"))
    return rows.groupBy("r.name").agg(F.min("r.f").alias("f")).select("name", "f.parent")


def category_bridge(assigned: DataFrame) -> DataFrame:
    return assigned.select("repository_id", "category").dropDuplicates()


def source_edges(records: DataFrame) -> DataFrame:
    """Distinct provenance edges of records with an ``id`` and a ``sources`` array."""
    flat = records.select(F.col("id").alias("repository_id"), F.explode("sources").alias("s"))
    return flat.select(
        "repository_id", F.coalesce("s.repository", F.lit("")).alias("source_repository"),
        F.coalesce("s.section", F.lit("")).alias("source_section"),
    ).dropDuplicates()


def insert_sources(existing: DataFrame, records: DataFrame) -> DataFrame:
    keys = ["repository_id", "source_repository", "source_section"]
    return insert_absent(existing, source_edges(records), keys)
