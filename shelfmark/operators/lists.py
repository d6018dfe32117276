"""Curated Markdown lists: documents ``(list_id, markdown)`` to references and sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import constants as K
from ..functions import markdown as M
from ..functions.text import bind, strip
from ..functions.urls import id_from_link, id_from_url, normalize_url, repository_id
from .keyed import first_per_key

_SMALL_HEADING = r"(?d)^#{5,6}[^\S\n]+.+$"
_HEADING_LINE = r"(?d)^#{1,6}[^\S\n]+(.+)$"


def link_rows(docs: DataFrame) -> DataFrame:
    """``(list_id, pos, text, url)`` of inline links."""
    return docs.select("list_id", F.posexplode(M.links("markdown")).alias("pos", "l")).select(
        "list_id", F.col("pos").cast("bigint").alias("pos"), "l.text", "l.url")


def heading_rows(docs: DataFrame) -> DataFrame:
    return docs.select("list_id", F.posexplode(M.headings("markdown")).alias("pos", "h")).select(
        "list_id", F.col("pos").cast("bigint").alias("pos"), "h.title", "h.level")


def section_rows(docs: DataFrame) -> DataFrame:
    return docs.select("list_id", F.posexplode(M.sections("markdown")).alias("pos", "s")).select(
        "list_id", F.col("pos").cast("bigint").alias("pos"), "s.title", "s.level", "s.match")


def repository_links(docs: DataFrame) -> DataFrame:
    """Links that lead to a repository: trimmed text and id."""
    return link_rows(docs).select("list_id", "pos", strip("text").alias("text"), id_from_link("url").alias("repo_id")).filter(
        "repo_id is not null")


def _tagged(kind: str, generator: int, urls: Column, texts=None) -> Column:
    """Array of ``(generator, pos, type, text, url)``."""
    return F.transform(urls, lambda u, i: F.struct(
        F.lit(generator).alias("gen"), i.cast("bigint").alias("pos"), F.lit(kind).alias("type"),
        (u["text"] if texts else u).alias("text"), (u["url"] if texts else u).alias("url"),
    ))


def _mentions(docs: DataFrame, arrays: list[Column], to_id) -> DataFrame:
    everything = F.concat(*arrays) if len(arrays) > 1 else arrays[0]
    keep = [c for c in docs.columns if c != "markdown"]
    rows = docs.select(*keep, F.explode(everything).alias("m")).select(*keep, "m.*")
    return rows.withColumn("repo_id", to_id("url")).filter("repo_id is not null")


def _all_mentions(docs: DataFrame) -> DataFrame:
    md = "markdown"
    return _mentions(docs, [
        _tagged("link", 0, M.links(md), True), _tagged("raw_url", 1, M.bare_urls(md)),
        _tagged("ossfuzz", 2, M.bracket_urls(md)),
    ], id_from_link)


def references(docs: DataFrame) -> DataFrame:
    """Every link, then bare and bracketed urls of repositories not seen before in the document."""
    window = Window.partitionBy("list_id", "repo_id").orderBy("gen", "pos")
    rows = _all_mentions(docs).withColumn("__n", F.row_number().over(window))
    return rows.filter((F.col("gen") == 0) | (F.col("__n") == 1)).drop("__n")


def distinct_repositories(docs: DataFrame) -> DataFrame:
    """Repositories of a document: bullet links first, then bare urls; the first text wins."""
    md = "markdown"
    rows = _mentions(docs, [
        _tagged("link", 0, M.bullet_links(md), True),
        _tagged("raw_url", 1, F.regexp_extract_all(md, F.lit(K.BARE_URL_PATTERN_EXACT), F.lit(1))),
    ], id_from_url)
    firsts = first_per_key(rows, ["list_id", "repo_id"], [F.asc("gen"), F.asc("pos")])
    return firsts.select(
        "list_id", "repo_id", strip("text").alias("name"), normalize_url("url").alias("url"),
        F.col("type").alias("source"), "gen", "pos")


def parsed(docs: DataFrame, source: str = "source") -> DataFrame:
    """One row per list: sections, categories and the number of distinct repositories.

    The repositories themselves stay rows (:func:`distinct_repositories`).
    """
    totals = distinct_repositories(docs).groupBy("list_id").agg(F.count("*").alias("total_repositories"))
    origin = F.col(source) if source in docs.columns else F.lit("")
    heads = docs.select(
        "list_id", F.lit(True).alias("is_awesome_list"), origin.alias("source_repository"),
        M.sections("markdown").alias("sections"), M.category_titles("markdown").alias("categories"))
    return heads.join(totals, "list_id", "left").fillna(0, ["total_repositories"])


def sectioned_repositories(docs: DataFrame) -> DataFrame:
    """Sections (H1-H3) with at most one repository per line; empty sections give one null row.

    The document is split in front of its headings inside the row, so nothing is shuffled.
    """
    blocks = docs.select("list_id", F.posexplode(M.section_blocks("markdown")).alias("section_no", "block"))
    title = strip(F.regexp_extract(M.first_line(F.col("block")), r"(?d)^#{1,3}[^\S\n]+(.+)$", 1))
    opened = blocks.filter(F.col("block").rlike(r"(?d)^#{1,3}[^\S\n]+.+")).select(
        "list_id", F.col("section_no").cast("bigint").alias("section_no"), title.alias("section"),
        F.split(M.after_first_line(F.col("block")), "\n").alias("lines"))

    def item(line: Column, i: Column) -> Column:
        url = F.regexp_extract(line, K.BARE_URL_PATTERN, 1)
        trimmed = strip(line)
        name = F.when(trimmed.rlike(K.ITEM_LINK_PATTERN), strip(F.regexp_extract(trimmed, K.ITEM_LINK_PATTERN, 1))).otherwise(url)
        useful = (url != "") & ~line.rlike(_SMALL_HEADING)
        return F.when(useful, F.struct(i.cast("bigint").alias("line_no"), normalize_url(url).alias("url"), name.alias("name")))

    found = opened.withColumn("items", F.array_compact(F.transform("lines", item)))
    return found.select("list_id", "section_no", "section", F.explode_outer("items").alias("r")).select(
        "list_id", "section_no", "section", "r.line_no", "r.url", "r.name")


def _read_once(docs: DataFrame) -> DataFrame:
    """Mentions with ids and names as ``found``, and ``hits``: names of each section's body behind a slash.

    Works from hash sets instead of pairing lines with names: every text piece behind a slash is
    cut to the lengths that occur among the document's names, and the cuts are intersected with
    the names. The work is linear in the text, every pattern runs once, and nothing leaves the row.
    """
    md = "markdown"
    mentions = F.concat(
        _tagged("link", 0, M.links(md), True), _tagged("raw_url", 1, M.bare_urls(md)), _tagged("ossfuzz", 2, M.bracket_urls(md)))
    ids = F.transform(mentions, lambda m: F.struct(m["gen"].alias("gen"), m["pos"].alias("pos"), id_from_link(m["url"]).alias("repo_id")))
    named = F.transform("ids", lambda m: F.struct(m["repo_id"].alias("repo_id"), m["gen"].alias("gen"), m["pos"].alias("pos"), F.substring_index(m["repo_id"], "/", -1).alias("name")))
    read = docs.withColumns({"ids": F.filter(ids, lambda m: m["repo_id"].isNotNull()), "blocks": M.section_blocks(md, deepest=6)}).drop(md)
    sorted_ = read.withColumn("found", F.array_sort(named)).withColumn("names", F.array_distinct(F.transform("found", lambda m: m["name"])))
    # Names and lengths are bound: a lambda that mentions a computed column would compute it again for every element.
    wanted = F.struct(F.col("names").alias("names"), F.array_distinct(F.transform("names", F.length)).alias("lengths"))

    def block_hits(block: Column, i: Column, known: Column) -> Column:
        first = M.first_line(block)
        headed = first.rlike(_HEADING_LINE)
        body = F.lower(F.when(headed, M.after_first_line(block)).otherwise(block))
        pieces = F.split(body, "/")
        behind = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
        cuts = F.flatten(F.transform(behind, lambda p: F.transform(
            known["lengths"], lambda n: F.substr(p, F.lit(1), n))))
        return F.struct(
            i.cast("bigint").alias("section_no"),
            F.when(headed, strip(F.regexp_extract(first, _HEADING_LINE, 1))).otherwise("").alias("section"),
            F.array_intersect(known["names"], cuts).alias("hits"))

    hits = bind(wanted, lambda known: F.transform("blocks", lambda block, i: block_hits(block, i, known)))
    return sorted_.withColumn("hits", hits).drop("ids", "blocks", "names")


def mention_sections(docs: DataFrame) -> DataFrame:
    """``(list_id, name, section)``: section of the first body line with ``/name`` in it."""
    hits = _read_once(docs.select("list_id", "markdown")).select("list_id", F.explode("hits").alias("b")).select(
        "list_id", "b.section_no", "b.section", F.explode("b.hits").alias("name"))
    return hits.groupBy("list_id", "name").agg(F.min(F.struct("section_no", "section")).alias("f")).select(
        "list_id", "name", "f.section")


def list_members(docs: DataFrame) -> DataFrame:
    """References of lists ``(list_id, owner, repo, markdown)``: no self reference, first of each
    id, with the section that mentions it.

    Mentions and sections come from one pass over the text and meet in one shuffle on list and
    name; an id determines its name, so choosing the first of an id needs no other.
    """
    none = lambda kind: F.lit(None).cast(kind)
    # Sorted by id and place: a mention is the first of its id in the row where its left neighbour has another.
    first = lambda m, i: (i == 0) | ~F.get(F.col("found"), i - 1)["repo_id"].eqNullSafe(m["repo_id"])
    mention = lambda m: F.struct(
        m["name"].alias("name"), m["repo_id"].alias("repo_id"), m["gen"].alias("gen"), m["pos"].alias("pos"), none("struct<section_no:bigint,section:string>").alias("at"))
    hit = lambda b: F.transform(b["hits"], lambda n: F.struct(
        n.alias("name"), none("string").alias("repo_id"), none("int").alias("gen"), none("bigint").alias("pos"),
        F.struct(b["section_no"].alias("section_no"), b["section"].alias("section")).alias("at")))
    self_id = repository_id("owner", "repo")
    both = F.concat(F.transform(F.filter("found", first), mention), F.flatten(F.transform("hits", hit)))
    rows = _read_once(docs.select("list_id", "owner", "repo", "markdown")).select(
        "list_id", F.concat_ws("/", "owner", "repo").alias("parent_list"), self_id.alias("__self"), F.explode(both).alias("r")).select(
        "list_id", "parent_list", "__self", "r.*")
    placed = rows.withColumn("at", F.min("at").over(Window.partitionBy("list_id", "name"))).filter(
        F.col("repo_id") != F.col("__self"))
    firsts = first_per_key(placed, ["list_id", "name", "repo_id"], [F.asc("gen"), F.asc("pos")])
    owner = F.substr(F.substring_index("repo_id", "/", 1), F.lit(len(K.PLATFORM) + 2))
    path = F.substr("repo_id", F.lit(len(K.PLATFORM) + 2))
    return firsts.select(
        "list_id", F.lit("awesome-list").alias("source"), "parent_list",
        "repo_id", F.coalesce("at.section", F.lit("")).alias("section"), owner.alias("owner"), "name",
        F.concat(F.lit(f"https://{K.HOST}/"), path).alias("url"), "gen", "pos")


def infer_sections(docs: DataFrame, refs: DataFrame) -> DataFrame:
    """Section per wanted ``(list_id, repo_id)``; null when no body line mentions it."""
    named = refs.withColumn("name", F.substring_index("repo_id", "/", -1))
    return named.join(mention_sections(docs), ["list_id", "name"], "left").drop("name")
