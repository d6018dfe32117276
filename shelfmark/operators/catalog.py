"""Lookups, filters and statistics over the stored catalog."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..functions.clock import fractional_days_since
from ..functions.compare import is_archived, is_stale, snapshot_status
from ..functions.text import any_of, literal_alternation, string_array
from ..taxonomy import Taxonomy
from .ranking import position_in_group


def by_id(df: DataFrame, rid: str) -> DataFrame:
    return df.filter(F.col("id") == rid)


def scan(df: DataFrame, limit: int | None = None) -> DataFrame:
    """All rows, or the first ``limit`` by id."""
    return df.orderBy("id").limit(limit) if limit else df


def first_non_empty(first: DataFrame, second: DataFrame) -> DataFrame:
    return second if first.isEmpty() else first


def by_health(df: DataFrame, status: str) -> DataFrame:
    return df.filter(F.col("health_status") == status)


def stale(df: DataFrame, as_of, max_days: float = K.STALE_DAYS) -> DataFrame:
    """Not archived, and never pushed or pushed more than ``max_days`` (fractional) ago."""
    old = F.col("pushed_at").isNull() | (fractional_days_since("pushed_at", as_of) > max_days)
    return df.filter(~F.col("archived") & (F.col("health_status") != "ARCHIVED") & old)


def min_stars(df: DataFrame, n: int) -> DataFrame:
    return df.filter(F.coalesce("stars", F.lit(0)) >= n)


def min_score(df: DataFrame, score: float) -> DataFrame:
    return df.filter(F.coalesce("score_overall", F.lit(0.0)) >= score)


def in_categories(df: DataFrame, taxonomy: Taxonomy, wanted: str | None, column: str = "categories") -> DataFrame:
    """Rows whose categories meet the wanted leaves; None or ``all`` keeps every row."""
    leaves = taxonomy.leaves_for(wanted)
    if leaves is None:
        return df
    if not leaves:
        return df.filter(F.lit(False))
    return df.filter(F.coalesce(F.arrays_overlap(F.col(column), string_array(leaves)), F.lit(False)))


@dataclass(frozen=True)
class Rules:
    """Inclusion and exclusion rules; the fields are independent and an empty one is off."""

    exclude_archived: bool = False
    exclude_fork: bool = False
    min_stars: int = K.MIN_STARS
    min_forks: int = K.MIN_FORKS
    languages: tuple[str, ...] = K.EXCLUDED_LANGUAGES
    licenses: tuple[str, ...] = K.EXCLUDED_LICENSES
    phrases: tuple[str, ...] = K.SPAM_PHRASES
    only_languages: tuple[str, ...] = ()
    only_licenses: tuple[str, ...] = ()
    min_score: float = 0.0


def allowed(rules: Rules, columns) -> Column:
    """One predicate; numeric rules read null as 0, the others read null as no match."""
    listed = lambda name, values: F.coalesce(F.col(name).isin(*values), F.lit(False))
    number = lambda name: F.coalesce(F.col(name), F.lit(0))
    keep = (number("stars") >= rules.min_stars) & (number("forks") >= rules.min_forks)
    if rules.exclude_archived:
        keep = keep & ~F.coalesce("archived", F.lit(False))
    if rules.exclude_fork and "fork" in columns:
        keep = keep & ~F.coalesce("fork", F.lit(False))
    for name, values in (("language", rules.languages), ("license", rules.licenses)):
        if values:
            keep = keep & ~listed(name, values)
    for name, values in (("language", rules.only_languages), ("license", rules.only_licenses)):
        if values:
            keep = keep & listed(name, values)
    if rules.phrases:
        spam = "(?i)" + literal_alternation(rules.phrases)
        keep = keep & ~any_of([F.col("name").rlike(spam), F.col("description").rlike(spam)])
    if rules.min_score > 0:
        keep = keep & (F.coalesce("score_overall", F.lit(0.0)) >= rules.min_score)
    return keep


def filter_catalog(df: DataFrame, rules: Rules = Rules()) -> DataFrame:
    return df.filter(allowed(rules, df.columns))


def with_snapshot_flags(df: DataFrame, as_of) -> DataFrame:
    """Status, stale flag and archived flag of snapshot rows."""
    nested = F.col("health.status") if "health" in df.columns else F.lit(None).cast("string")
    flat = F.col("health_status") if "health_status" in df.columns else F.lit(None).cast("string")
    status = snapshot_status(flat, nested)
    return df.withColumns({
        "status": status, "is_stale": is_stale(status, F.col("pushed_at"), as_of),
        "is_archived": is_archived(status, F.col("archived")),
    })


def records_in_category(df: DataFrame, bridge: DataFrame, category: str) -> DataFrame:
    """The bridge is distinct, so a semi join gives each record once."""
    ids = bridge.filter(F.col("category") == category).select(F.col("repository_id").alias("id"))
    return df.join(ids, "id", "left_semi")


def categories_per_record(bridge: DataFrame, categories: DataFrame) -> DataFrame:
    """Sorted names per record. A record has at most one entry per leaf, so the array is bounded."""
    names = categories.select(F.col("name").alias("category"))
    return bridge.join(names, "category").groupBy("repository_id").agg(
        F.array_sort(F.collect_set("category")).alias("categories"))


def category_parents(categories: DataFrame) -> DataFrame:
    """``(name, parent)`` where the parent is a known category, else null."""
    parents = categories.select(F.col("name").alias("parent_name"))
    return categories.join(parents, categories.parent == parents.parent_name, "left").select(
        "name", F.col("parent_name").alias("parent"))


def category_tree(categories: DataFrame) -> DataFrame:
    """Parent -> sorted children; bounded by the size of the taxonomy."""
    children = categories.filter("parent is not null").select(F.col("parent").alias("p"), F.col("name").alias("child"))
    return children.join(categories.select(F.col("name").alias("p")), "p").groupBy(F.col("p").alias("parent")).agg(
        F.array_sort(F.collect_list("child")).alias("children"))


def placed(records: DataFrame, bridge: DataFrame, categories: DataFrame) -> DataFrame:
    """One row per record and category with its parent; unmatched ones go to Uncategorized.

    Parents are resolved among the categories, then put on the narrow bridge rows; the records take part in one join, on
    their id, and never move by category.
    """
    known = category_parents(categories).withColumnRenamed("name", "category")
    names = bridge.select(F.col("repository_id").alias("id"), "category").join(known, "category")
    unknown = F.lit(K.UNCATEGORIZED)
    joined = records.join(names, "id", "left")
    return joined.withColumns({
        "category": F.coalesce("category", unknown),
        "parent": F.coalesce(F.when(F.col("parent") != "", F.col("parent")), unknown),
    })


def sources_per_record(edges: DataFrame) -> DataFrame:
    """``(repository_id, position, repository, section)``: the edges of each record, numbered in order from 1."""
    rows = edges.select(
        "repository_id", F.col("source_repository").alias("repository"), F.col("source_section").alias("section"))
    return position_in_group(rows, ["repository_id"], [F.asc("repository"), F.asc("section")], "position")


def stats(df: DataFrame) -> DataFrame:
    """``(measure, key, value)``: total, total stars, counts by health and by language, in one pass."""
    wide = df.select(
        F.col("health_status").alias("h"), F.col("language").alias("l"), F.coalesce("stars", F.lit(0)).alias("s"))
    grouped = wide.groupingSets([["h"], ["l"], []], "h", "l").agg(
        F.grouping_id().alias("g"), F.count("*").alias("n"), F.sum("s").alias("stars"))
    measure = F.when(F.col("g") == 1, "health").when(F.col("g") == 2, "language").otherwise("total")
    counted = grouped.filter((F.col("g") != 2) | F.col("l").isNotNull())
    rows = F.when(F.col("g") == 3, F.array(
        F.struct(F.lit("total").alias("measure"), F.lit("").alias("key"), F.col("n").alias("value")),
        F.struct(F.lit("stars").alias("measure"), F.lit("").alias("key"), F.coalesce("stars", F.lit(0)).alias("value")),
    )).otherwise(F.array(F.struct(
        measure.alias("measure"), F.coalesce("h", "l").alias("key"), F.col("n").alias("value"))))
    return counted.select(F.inline(rows))


def count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def category_summary(placed_rows: DataFrame) -> DataFrame:
    return placed_rows.agg(
        F.countDistinct("id").alias("total"), F.countDistinct("category").alias("categories"),
        F.countDistinct("parent").alias("parents"))


def run_summary(classified: DataFrame, duplicate_groups: DataFrame | None = None) -> DataFrame:
    """Collected, duplicate groups merged (none when the ids are known to be unique), categorized."""
    groups = F.lit(0).cast("bigint") if duplicate_groups is None else duplicate_groups.agg(F.count("*")).scalar()
    return classified.agg(
        F.count("*").alias("collected"),
        F.count_if(F.size("categories") > 0).alias("categorized"),
    ).withColumn("duplicates_merged", groups)
