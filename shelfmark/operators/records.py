"""Building, normalizing, de-duplicating and merging repository records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..functions.text import col, is_set, strip
from ..functions.urls import (
    WEB_PREFIX, id_from_url, normalize_url, repository_id, split_id,
)
from ..schemas import REPOSITORY
from .keyed import first_per_key
from .ranking import position_in_group

_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _typed(name: str) -> Column:
    return F.lit(None).cast(REPOSITORY[name].dataType)


def complete(df: DataFrame) -> DataFrame:
    """All ``REPOSITORY`` columns in order; absent ones take their defaults. Extra columns stay."""
    defaults = {
        "platform": F.lit(K.PLATFORM), "archived": F.lit(False),
        "topics": F.array().cast("array<string>"), "sources": F.array().cast(REPOSITORY["sources"].dataType),
    }
    have = set(df.columns)
    fields = [
        F.coalesce(F.col(n), defaults[n]).alias(n) if n in have and n in defaults
        else F.col(n) if n in have
        else defaults.get(n, _typed(n)).alias(n)
        for n in REPOSITORY.fieldNames()
    ]
    return df.select(*fields, *[c for c in df.columns if c not in REPOSITORY.fieldNames()])


def from_payload(hits: DataFrame, collected_at, payload: str = "repository") -> DataFrame:
    """Search payload -> record; ``forks_count`` wins over ``forks``; other columns are kept."""
    p = lambda name: F.col(f"{payload}.{name}")
    owner, name = F.coalesce(p("owner.login"), F.lit("")), F.coalesce(p("name"), F.lit(""))
    record = hits.select(
        "*", repository_id(owner, name).alias("id"), owner.alias("owner"), name.alias("name"),
        F.coalesce(p("html_url"), F.concat(F.lit(WEB_PREFIX), owner, F.lit("/"), name)).alias("url"),
        p("description").alias("description"), p("stargazers_count").alias("stars"),
        F.coalesce(p("forks_count"), p("forks")).alias("forks"), p("open_issues_count").alias("issues"),
        p("language").alias("language"), p("topics").alias("topics"), p("license.key").alias("license"),
        p("archived").alias("archived"), p("created_at").alias("created_at"),
        p("updated_at").alias("updated_at"), p("pushed_at").alias("pushed_at"),
        (collected_at if isinstance(collected_at, Column) else F.lit(collected_at).cast("timestamp")).alias("collected_at"),
    ).drop(payload)
    return complete(record)


def slim_hits(hits: DataFrame, payload: str = "repository") -> DataFrame:
    """Ten-column record of a hit; hits without owner or name are dropped."""
    p = lambda name: F.col(f"{payload}.{name}")
    return hits.filter(is_set(f"{payload}.owner.login") & is_set(f"{payload}.name")).select(
        repository_id(p("owner.login"), p("name")).alias("id"), p("owner.login").alias("owner"), p("name").alias("name"),
        F.coalesce(p("html_url"), F.concat(F.lit(WEB_PREFIX), p("owner.login"), F.lit("/"), p("name"))).alias("url"),
        p("description").alias("description"), p("stargazers_count").alias("stars"),
        F.coalesce(p("forks_count"), p("forks")).alias("forks"), p("language").alias("language"),
        F.coalesce(p("archived"), F.lit(False)).alias("archived"),
        F.concat_ws("/", p("owner.login"), p("name")).alias("name_with_owner"),
    )


def from_urls(df: DataFrame, url: str, collected_at) -> DataFrame:
    """Record from a bare url; foreign urls give no row."""
    found = df.withColumn("id", id_from_url(url)).filter("id is not null")
    tail = F.substr("id", F.lit(len(K.PLATFORM) + 2))
    owner = F.substring_index(tail, "/", 1)
    name = F.substr(tail, F.length(owner) + 2)
    return complete(found.select(
        "id", owner.alias("owner"), name.alias("name"), F.concat(F.lit(WEB_PREFIX), owner, F.lit("/"), name).alias("url"),
        F.lit(collected_at).cast("timestamp").alias("collected_at"),
    ))


def from_flat(df: DataFrame) -> DataFrame:
    """Flat row -> nested record; a nested score or health that is already there wins."""
    have = set(df.columns)
    blank = lambda n, field, value: F.struct(*[
        (value if f.name == field else F.lit(None).cast(f.dataType)).alias(f.name) for f in REPOSITORY[n].dataType
    ])
    score = blank("score", "overall", F.coalesce("score_overall", F.lit(0.0)))
    health = blank("health", "status", F.when(is_set("health_status"), F.col("health_status")).otherwise("UNKNOWN"))
    nested = df.withColumns({
        "score": F.coalesce(F.col("score"), score) if "score" in have else score,
        "health": F.coalesce(F.col("health"), health) if "health" in have else health,
    })
    return complete(nested.drop("score_overall", "health_status"))


def to_flat(df: DataFrame) -> DataFrame:
    """The sixteen flat columns of nested records."""
    return df.select(
        "id", "owner", "name", "url", "description", "stars", "forks", "language", "license", "archived",
        "created_at", "updated_at", "pushed_at", "collected_at",
        F.coalesce("health.status", F.lit("UNKNOWN")).alias("health_status"),
        F.coalesce("score.overall", F.lit(0.0)).alias("score_overall"),
    )


def normalize(df: DataFrame) -> DataFrame:
    """Id from owner and name, url rebuilt from the id, owner and name trimmed and lower-cased."""
    owner, name = F.lower(strip("owner")), F.lower(strip("name"))
    return df.withColumns({
        "id": repository_id("owner", "name"), "url": F.concat(F.lit(WEB_PREFIX), owner, F.lit("/"), name),
        "owner": owner, "name": name,
    })


def match_key(fields: list[str], types: dict[str, str] | None = None) -> Column:
    """Dedupe key over the given fields, joined by a bar; null, zero, false and empty are the same."""
    parts = []
    for f in fields:
        if f == "id":
            part = F.col("id")
        elif f == "url":
            part = normalize_url("url")
        else:
            kind = (types or {}).get(f, "string")
            empty = F.col(f) == F.lit(False) if kind == "boolean" else F.col(f) == 0 if kind in _NUMBERS or kind.startswith("decimal") else F.lit(False)
            part = F.when(~F.coalesce(empty, F.lit(False)), F.lower(F.col(f).cast("string")))
        parts.append(F.coalesce(part, F.lit("")))
    return F.concat_ws("|", *parts)


def dedupe(df: DataFrame, fields: list[str] | None = None, order: str = "seq") -> DataFrame:
    """One row per key, the first in ``order``.

    On the id alone the rows are partitioned by the id itself, so later joins and windows on it
    need no further shuffle.
    """
    if fields in (None, ["id"]):
        return first_per_key(df, ["id"], [F.col(order).asc()])
    keyed = df.withColumn("__key", match_key(fields or ["id"], dict(df.dtypes)))
    return first_per_key(keyed, ["__key"], [F.col(order).asc()]).drop("__key")


def duplicates(df: DataFrame, fields: list[str] | None = None, order: str = "seq") -> DataFrame:
    """Every dropped row as ``(primary_id, match_type, <row>)``: rows, not one list per group.

    The first row of each key is found by a map-side combined aggregate and joined back, so
    a group of any size is spread by the skew handling of the join. Of rows that tie with the
    first one, all but one are dropped rows too; they are numbered by ranges, so that a key of
    which all rows tie spreads as well.
    """
    keyed = df.withColumn("__key", match_key(fields or ["id"], dict(df.dtypes)))
    primary = keyed.groupBy("__key").agg(
        F.min_by("id", order).alias("primary_id"), F.min(order).alias("__first"), F.count("*").alias("__n")
    ).filter("__n > 1").drop("__n")
    members = keyed.join(primary, "__key").withColumn("__tied", F.col(order).eqNullSafe(F.col("__first")))
    later = members.filter(~F.col("__tied") & F.coalesce(F.col(order) > F.col("__first"), F.lit(True)))
    several = members.filter("__tied").groupBy("__key").agg(F.count("*").alias("__n")).filter("__n > 1").select("__key")
    tied = position_in_group(members.filter("__tied").join(several, "__key", "left_semi"), ["__key"], [F.asc("id")], "__nth").filter("__nth > 1").drop("__nth")
    return later.unionByName(tied).select("primary_id", F.lit("id").alias("match_type"), *df.columns)


def duplicate_counts(df: DataFrame, fields: list[str] | None = None, order: str = "seq") -> DataFrame:
    """``(primary_id, duplicates)`` per primary id with at least one duplicate."""
    keyed = df.withColumn("__key", match_key(fields or ["id"], dict(df.dtypes)))
    groups = keyed.groupBy("__key").agg(F.min_by("id", order).alias("primary_id"), (F.count("*") - 1).alias("n"))
    return groups.filter("n > 0").groupBy("primary_id").agg(F.sum("n").alias("duplicates"))


def merge_sources(existing: Column | str, new: Column | str) -> Column:
    """Append unseen (repository, section) pairs, order kept."""
    none = F.array().cast(REPOSITORY["sources"].dataType)
    return F.array_distinct(F.concat(F.coalesce(col(existing), none), F.coalesce(col(new), none)))


def fold_sources(df: DataFrame) -> DataFrame:
    """``(id, position, repository, section)``: distinct provenance pairs of the primary and all its duplicates.

    The pairs are made distinct first, combined on the map side, so copies of one record ship each
    pair once; positions count from 1 in order of the pairs.
    """
    pairs = df.select("id", F.inline("sources")).select("id", "repository", "section").distinct()
    return position_in_group(pairs, ["id"], [F.asc("repository"), F.asc("section")], "position")


def attach_facts(hits: DataFrame, topics: DataFrame, licenses: DataFrame, contributors: DataFrame) -> DataFrame:
    """Facts per id: topics -> [] when missing, license -> unchanged, contributors -> 0."""
    t = topics.select("id", F.col("topics").alias("__topics"))
    c = contributors.select("id", F.col("contributors").alias("contributors_count"))
    license_key = licenses.select("id", F.coalesce("key", "spdx_id").alias("__license"))
    joined = hits.join(t, "id", "left").join(license_key, "id", "left").join(c, "id", "left")
    return joined.withColumns({
        "topics": F.coalesce("__topics", "topics", F.array().cast("array<string>")),
        "license": F.coalesce("__license", "license"),
        "contributors_count": F.coalesce("contributors_count", F.lit(0)),
    }).drop("__topics", "__license")


def missing_fields() -> Column:
    """Names of required fields that are null or empty."""
    checks = [
        F.when(~is_set(F.col(f).cast("string")), F.lit(f)) for f in K.REQUIRED_FIELDS
    ]
    return F.array_compact(F.array(*checks))


def validate(df: DataFrame) -> DataFrame:
    """One row: total, valid, errors."""
    bad = F.size(missing_fields()) > 0
    return df.agg(
        F.count("*").alias("total"), F.count_if(~bad).alias("valid"), F.count_if(bad).alias("errors"))


def validation_errors(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` messages by id."""
    who = F.when(is_set("id"), F.col("id")).otherwise("unknown")
    bad = df.withColumn("__m", missing_fields()).filter(F.size("__m") > 0)
    text = F.concat(who, F.lit(": missing "), F.array_join("__m", ", "))
    return bad.select("id", text.alias("message")).orderBy(F.asc_nulls_first("id"), "message").limit(n)


def malformed_ids(df: DataFrame, column: str = "id") -> DataFrame:
    return df.filter(F.col(column).isNotNull() & split_id(column).isNull())
