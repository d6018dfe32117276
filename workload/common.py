"""Shared pieces of the queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from shelfmark.operators import records
from shelfmark.session import ensure_checkpoint_dir


def scratch(spark, name: str) -> str:
    """A fresh folder for one query in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/shelfmark-{name}-{uuid.uuid4().hex}"


def csv(c: str, name: str | None = None):
    return F.array_join(c, ",").alias(name or c.split(".")[-1])


def epoch(c: str, name: str | None = None):
    return F.unix_seconds(c).cast("string").alias(name or c)


def text(c: str, name: str | None = None):
    return F.col(c).cast("string").alias(name or c)


def nested(flat: DataFrame) -> DataFrame:
    return records.from_flat(flat)


def hits(flat: DataFrame) -> DataFrame:
    """Search hits with the payload struct, from the flat view."""
    payload = F.struct(
        "name", F.struct(F.col("owner").alias("login")).alias("owner"), "html_url", "description",
        F.col("stars").alias("stargazers_count"), "forks_count", "forks", F.col("issues").alias("open_issues_count"),
        "language", "topics", F.struct(F.col("license").alias("key")).alias("license"), "archived",
        *[F.lit(None).cast("timestamp").alias(c) for c in ("created_at", "updated_at", "pushed_at")])
    return flat.select("seq", "source", "query", payload.alias("repository"))


def duck_id_from_url(u: str) -> str:
    """Repository id of a url in the second engine."""
    path = (f"regexp_replace(trim(regexp_extract(ltrim({u}), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:www\\.)?github\\.com/([^?#]*)', 1), '/'), '\\.git$', '')")
    web = f"case when {path} like '%/%' then 'github:' || lower(split_part({path}, '/', 1)) || '/' || lower(split_part({path}, '/', 2)) end"
    ssh = "'^git@github\\.com:([^/]+)/([^/]+?)(?:\\.git)?$'"
    return (f"coalesce({web}, case when regexp_matches({u}, {ssh}) then 'github:' || lower(regexp_extract({u}, {ssh}, 1)) || '/' || "
            f"lower(regexp_extract({u}, {ssh}, 2)) end)")


def duck_id_from_link(u: str) -> str:
    t = f"trim({u})"
    return duck_id_from_url(f"(case when {t} like 'github:%' then 'https://github.com/' || substr({t}, 8) else {t} end)")


def duck_list_name(n: str) -> str:
    return f"coalesce(lower({n}) like 'awesome%' or lower({n}) like '%-awesome%', false)"


def duck_list_hit(name="name", description="description", topics="topics") -> str:
    d = f"lower(coalesce({description}, ''))"
    return (f"({duck_list_name(name)} or coalesce(list_contains({topics}, 'awesome-list'), false) "
            f"or {d} like '%awesome list%' or {d} like '%awesome repository%')")


def duck_list_url(u: str) -> str:
    path = (f"regexp_replace(trim(regexp_extract(ltrim({u}), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:www\\.)?github\\.com/([^?#]*)', 1), '/'), '\\.git$', '')")
    n = f"lower(split_part({path}, '/', 2))"
    return (f"coalesce({path} like '%/%' and ({n} like 'awesome%' or {n} like '%-awesome%' or list_contains(split({n}, '-'), 'awesome')), false)")
