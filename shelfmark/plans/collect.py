"""Collecting records from search hits and from curated lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..functions.classify import classify, heading_category, parent_of, parents_of, with_section
from ..operators import catalog, discover, keyed, lists, records
from ..schemas import REPOSITORY
from ..session import staged
from ..taxonomy import Taxonomy


def _awesome(is_list: Column, categories: Column) -> Column:
    return F.struct(
        is_list.alias("is_awesome_list"), categories.alias("categories"),
        F.coalesce(F.col("awesome.package_names"), F.array().cast("array<string>")).alias("package_names"))


def classified(normalized: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    found = classify("description", "topics", "name", "language", taxonomy)
    is_list = F.coalesce(F.col("awesome.is_awesome_list"), F.lit(False))
    return normalized.withColumn("awesome", _awesome(is_list, found)).withColumn(
        "categories", F.col("awesome.categories"))


def _staged(df: DataFrame, folder: str | bool | None) -> DataFrame:
    """Under the folder, by default the shared one; ``False`` leaves the plan as it is."""
    if folder is False:
        return df
    if folder is None:
        return staged(df, "collected")
    df.write.mode("errorifexists").parquet(folder)
    return df.sparkSession.read.parquet(folder)


def collect(
    hits: DataFrame, taxonomy: Taxonomy, collected_at, category: str | None = None,
    facts: tuple[DataFrame, DataFrame, DataFrame] | None = None, staging: str | bool | None = None,
) -> dict[str, DataFrame]:
    """Hits -> records, provenance, category rows, bridge, and the run summary.

    Hits are de-duplicated on the id that records get, so the records need no second pass and no
    duplicate groups remain. ``facts`` are tables of topics, licenses and contributor counts by id.
    The id is the one the hits were de-duplicated on, so facts meet them where they are and nothing is computed to match it.
    The category filter limits what is saved, not what is counted. Provenance is one row per edge.
    The classified records are written once, into the ``staging`` folder or the shared one, and every output reads them.
    With ``staging=False`` nothing is written and each output runs the whole chain, for readers of a single output.
    """
    first = discover.dedupe_hits(hits, ident="hit_id")
    raw = records.normalize(records.from_payload(first, collected_at)).withColumn("id", F.col("hit_id"))
    if facts:
        raw = records.attach_facts(raw, *facts)
    survivors = _staged(classified(raw, taxonomy).select(*REPOSITORY.fieldNames(), "seq", "categories"), staging)
    saved = catalog.in_categories(survivors, taxonomy, category)
    edges = keyed.source_edges(saved)
    assigned = assigned_categories(saved, taxonomy)
    return {
        "records": saved.select(*REPOSITORY.fieldNames(), "seq"),
        "sources": edges,
        "categories": keyed.category_rows(assigned),
        "bridge": keyed.category_bridge(assigned),
        "summary": catalog.run_summary(survivors),
    }


def assigned_categories(saved: DataFrame, taxonomy: Taxonomy) -> DataFrame:
    """``(repository_id, category, parent, seq)`` rows of classified records."""
    placed = saved.select(F.col("id").alias("repository_id"), "seq", F.explode("categories").alias("category"))
    return placed.select("repository_id", "category", parent_of("category", taxonomy).alias("parent"), "seq")


def collect_from_lists(
    docs: DataFrame, facts: DataFrame, taxonomy: Taxonomy, collected_at, staging: str | bool | None = None
) -> dict[str, DataFrame]:
    """Members of curated lists, joined to their catalog facts.

    ``docs`` holds ``(list_id, owner, repo, markdown)`` and ``facts`` ``REPOSITORY`` rows by id;
    a member without facts keeps its id, owner, name and url.
    """
    members = lists.list_members(docs)
    known = facts.select("id", "description", "stars", "forks", "issues", "language", "topics", "license",
                         "archived", "created_at", "updated_at", "pushed_at")
    order = F.struct("list_id", "gen", "pos")
    found = members.join(known, members.repo_id == known.id, "left").select(
        F.col("repo_id").alias("id"), "owner", "name", "url", *known.columns[1:],
        F.array(F.struct(
            F.concat(F.lit("github:"), F.col("parent_list")).alias("repository"), F.col("section").alias("section"),
        )).alias("sources"),
        "section", order.alias("seq"), F.lit(collected_at).cast("timestamp").alias("collected_at"))
    raw = _staged(records.normalize(records.complete(found)), staging)
    survivors = records.dedupe(raw)
    own = classify("description", "topics", "name", "language", taxonomy)
    categories = with_section(heading_category("section", taxonomy), own)
    saved = survivors.withColumn("awesome", _awesome(F.lit(True), categories)).withColumn(
        "categories", F.col("awesome.categories"))
    assigned = assigned_categories(saved, taxonomy)  # in list order: seq is (list_id, gen, pos)
    return {
        "records": saved.select(*REPOSITORY.fieldNames()),
        "sources": keyed.source_edges(raw),
        "categories": keyed.category_rows(assigned),
        "bridge": keyed.category_bridge(assigned),
        "summary": catalog.run_summary(saved, records.duplicate_counts(raw)),
    }


def as_hits(found: DataFrame) -> DataFrame:
    """Catalog rows with source and query -> search hits ``(source, query, seq, repository)``.

    ``seq`` orders by kind of search, query, stars and id.
    """
    have = set(found.columns)
    pick = lambda name: F.col(name) if name in have else F.lit(None).cast(REPOSITORY[name].dataType)
    payload = F.struct(
        pick("name").alias("name"), F.struct(pick("owner").alias("login")).alias("owner"), pick("url").alias("html_url"),
        pick("description").alias("description"), pick("stars").alias("stargazers_count"), pick("forks").alias("forks_count"),
        pick("forks").alias("forks"), pick("issues").alias("open_issues_count"), pick("language").alias("language"),
        pick("topics").alias("topics"), F.struct(pick("license").alias("key")).alias("license"), pick("archived").alias("archived"),
        *[pick(n).alias(n) for n in ("created_at", "updated_at", "pushed_at")])
    seq = F.struct(F.col("source") == "topic", F.col("query"), -F.coalesce(pick("stars"), F.lit(0)), F.col("id"))
    return found.select("source", "query", seq.alias("seq"), payload.alias("repository"))


def discover_hits(table: DataFrame, patterns=K.LIST_NAME_PATTERNS, topics=K.LIST_TOPICS, cap: int = K.HITS_PER_QUERY) -> DataFrame:
    """Searches of a catalog table by name pattern and by topic, each query capped at its best hits, in hit shape."""
    found = discover.union_hits(discover.search_names(table, patterns), discover.search_topics(table, topics))
    return as_hits(discover.cap_hits(found, cap))


def discover_lists(hits: DataFrame, collected_at) -> DataFrame:
    """Curated lists among search hits, as list records."""
    return discover.list_records(discover.curated_lists(hits), collected_at)


def search_lists(table: DataFrame, collected_at, patterns=K.LIST_NAME_PATTERNS, topics=K.LIST_TOPICS, cap: int = K.HITS_PER_QUERY) -> DataFrame:
    """Curated lists of a catalog table in one plan: searches, first hit of each repository, curated test, list records."""
    return discover_lists(discover.dedupe_hits(discover_hits(table, patterns, topics, cap)), collected_at)
