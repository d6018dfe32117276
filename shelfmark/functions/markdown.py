"""In-row expressions over one Markdown text. None of them shuffles."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import constants as K
from .text import col, strip
from .urls import is_catalog_url

# A heading must be complete within its own line here.
_SECTION_BREAK = r"(?dm)(?=^#{1,3}[^\S\n]+.+$)"
_ANY_HEADING_BREAK = r"(?dm)(?=^#{1,6}[^\S\n]+.+$)"


def _all(text: Column | str, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(col(text), F.lit(pattern), F.lit(group))


def links(text: Column | str) -> Column:
    """``array<struct<text,url>>`` of inline links, in order."""
    return F.arrays_zip(
        _all(text, K.LINK_PATTERN, 1).alias("text"), _all(text, K.LINK_PATTERN, 2).alias("url")
    )


def bare_urls(text: Column | str) -> Column:
    return _all(text, K.BARE_URL_PATTERN)


def bracket_urls(text: Column | str) -> Column:
    return _all(text, K.BRACKET_URL_PATTERN)


def bullet_links(text: Column | str) -> Column:
    return F.arrays_zip(
        _all(text, K.BULLET_LINK_PATTERN, 1).alias("text"), _all(text, K.BULLET_LINK_PATTERN, 2).alias("url")
    )


def headings(text: Column | str) -> Column:
    """``array<struct<title,level>>``; the level counts every ``#`` of the heading line."""
    return F.transform(
        F.arrays_zip(_all(text, K.HEADING_PATTERN, 1).alias("title"), _all(text, K.HEADING_PATTERN, 0).alias("line")),
        lambda h: F.struct(
            h["title"].alias("title"),
            F.length(F.regexp_replace(h["line"], "[^#]", "")).cast("bigint").alias("level"),
        ),
    )


def sections(text: Column | str) -> Column:
    """``array<struct<title,level,match>>``; the level is the length of marker and blanks."""
    return F.transform(
        F.arrays_zip(_all(text, K.HEADING_PATTERN, 1).alias("title"), _all(text, K.HEADING_PATTERN, 0).alias("line")),
        lambda h: F.struct(
            strip(h["title"]).alias("title"),
            (F.length(h["line"]) - F.length(strip(h["title"]))).cast("bigint").alias("level"),
            h["line"].alias("match"),
        ),
    )


def category_titles(text: Column | str) -> Column:
    """Titles of sections whose level is exactly 2."""
    return F.transform(F.filter(sections(text), lambda s: s["level"] == 2), lambda s: s["title"])


def list_metadata(text: Column | str) -> Column:
    found, heads = links(text), headings(text)
    on_host = F.filter(found, lambda x: is_catalog_url(x["url"]))
    return F.struct(
        F.lit(True).alias("is_awesome_list"),
        F.size(heads).cast("bigint").alias("section_count"),
        F.transform(heads, lambda h: h["title"]).alias("sections"),
        F.size(found).cast("bigint").alias("total_links"),
        on_host.alias("catalog_links"),
        F.size(on_host).cast("bigint").alias("repository_count"),
    )


def readme_quality(text: Column | str) -> Column:
    t = col(text)
    words = F.size(F.filter(F.split(t, r"\s+"), lambda w: w != "")).cast("bigint")
    toc, badges = t.rlike(K.TOC_PATTERN), t.rlike(K.BADGE_PATTERN)
    tables, code = t.rlike(K.TABLE_PATTERN), t.contains("```")
    size_points = F.when(words >= 50, 25).when(words >= 20, 15).otherwise(0)
    points = size_points
    for flag, value in ((toc, 25), (badges, 15), (tables, 20), (code, 15)):
        points = points + F.when(flag, value).otherwise(0)
    return F.struct(
        words.alias("word_count"), toc.alias("has_toc"), badges.alias("has_badges"),
        tables.alias("has_tables"), code.alias("has_code_blocks"),
        F.least(points, F.lit(100)).cast("bigint").alias("quality_score"),
    )


def section_blocks(text: Column | str, deepest: int = 3) -> Column:
    """Split a text in front of its headings; each later element starts with one heading line.

    The section of a line is thereby known inside the row: no window over lines, no shuffle.
    """
    return F.split(col(text), _SECTION_BREAK if deepest == 3 else _ANY_HEADING_BREAK)


def first_line(block: Column) -> Column:
    return F.substring_index(block, "\n", 1)


def after_first_line(block: Column) -> Column:
    """Text behind the first line; '' when there is none."""
    return F.when(block.contains("\n"), F.substr(block, F.instr(block, "\n") + 1)).otherwise(F.lit(""))
