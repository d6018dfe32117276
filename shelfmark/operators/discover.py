"""Search over a catalog table: hits by text, name pattern and topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import constants as K
from ..functions.text import is_set, java_quote, string_array
from ..functions.urls import is_list_hit, repository_id
from .keyed import first_per_key, top_per_key


def search_text(catalog: DataFrame, field: str, phrase: str) -> DataFrame:
    """Rows whose ``field`` contains the phrase, tagged ``search_<field>`` and with the query."""
    return catalog.filter(F.lower(F.col(field)).contains(phrase.lower())).select(
        F.lit(f"search_{field}").alias("source"), F.lit(f'"{phrase}" in:{field}').alias("query"), "*"
    )


def glob_pattern(pattern: str) -> str:
    return "(?i)^" + ".*".join(java_quote(piece) for piece in pattern.split("*")) + "$"


def search_names(catalog: DataFrame, patterns=K.LIST_NAME_PATTERNS) -> DataFrame:
    """One hit per matching pattern: the patterns are tested in one pass over the table."""
    hits = F.array_compact(F.array(*[
        F.when(F.col("name").rlike(glob_pattern(p)), F.lit(p)) for p in patterns
    ]))
    return catalog.select(F.lit("search_pattern").alias("source"), F.explode(hits).alias("query"), "*")


def search_topics(catalog: DataFrame, topics=K.LIST_TOPICS) -> DataFrame:
    """One hit per requested topic of a row; narrow, no join."""
    wanted = F.array_intersect(string_array(topics), F.col("topics"))
    return catalog.select(F.lit("topic").alias("source"), F.explode(wanted).alias("query"), "*")


def matching_topics(catalog: DataFrame, phrase: str = K.LIST_WORD, default=K.DEFAULT_TOPICS) -> DataFrame:
    """Distinct topic names that contain the phrase; the default list when there is none."""
    found = catalog.select(F.explode("topics").alias("topic")).filter(F.col("topic").contains(phrase)).distinct()
    if found.isEmpty():
        return catalog.sparkSession.createDataFrame([(t,) for t in dict.fromkeys(default)], "topic string")
    return found


def cap_hits(hits: DataFrame, n: int = K.HITS_PER_QUERY) -> DataFrame:
    """Best ``n`` hits per query by stars; limited on the map side before the shuffle."""
    return top_per_key(hits, ["source", "query"], [F.col("stars").desc_nulls_last(), F.col("id")], n)


def curated_lists(hits: DataFrame, prefix: str = "repository.") -> DataFrame:
    return hits.filter(is_list_hit(f"{prefix}name", f"{prefix}description", f"{prefix}topics"))


def dedupe_hits(
    hits: DataFrame, owner: str = "repository.owner.login", name: str = "repository.name", ident: str | None = None,
) -> DataFrame:
    """First hit per repository; hits without owner or name are dropped.

    With ``ident`` the id stays, under that name: the rows are partitioned and sorted by it, so joins on it move only the other side.
    """
    usable = hits.filter(is_set(owner) & is_set(name)).withColumn("__id", repository_id(owner, name))
    first = first_per_key(usable, ["__id"], [F.col("seq").asc()])
    return first.withColumnRenamed("__id", ident) if ident else first.drop("__id")


def list_records(hits: DataFrame, collected_at) -> DataFrame:
    """Curated-list records of twelve fields and the collection time."""
    p = lambda n: F.col(f"repository.{n}")
    owner, name = p("owner.login"), p("name")
    path = F.concat(owner, F.lit("/"), name)
    return hits.filter(is_set("repository.owner.login") & is_set("repository.name")).select(
        F.concat(F.lit(K.PLATFORM + ":"), path).alias("id"), name.alias("name"), owner.alias("owner"),
        F.coalesce(p("html_url"), F.concat(F.lit(f"https://{K.HOST}/"), path)).alias("url"),
        p("description").alias("description"), p("stargazers_count").alias("stars"),
        p("language").alias("language"), F.coalesce(p("topics"), F.array().cast("array<string>")).alias("topics"),
        is_list_hit("repository.name", "repository.description", "repository.topics").alias("is_awesome_list"),
        "source", "query", F.lit(collected_at).cast("timestamp").alias("collected_at"),
    )


def union_hits(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
