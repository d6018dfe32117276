"""Categories from topics, language and keywords, compiled from a taxonomy to literals."""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from .. import constants as K
from ..taxonomy import Taxonomy
from .text import any_of, bind, col, java_quote, literal_lists, lookup, strip, string_array

_NONE = "array<string>"


def without_nulls(values: list[Column]) -> Column:
    """Distinct non-null values in order. Unlike a filter with a lambda this stays compiled."""
    if not values:
        return F.array().cast(_NONE)
    return F.array_except(F.array(*values), F.array(F.lit(None).cast("string")))


def _first(names: Column) -> Column:
    return F.get(names, 0)


def by_topics(topics: Column | str, taxonomy: Taxonomy) -> Column:
    """First leaf that lists each topic, in topic order, unique."""
    owner: dict[str, str] = {}
    for leaf, words in taxonomy.topics.items():
        for word in words:
            owner.setdefault(word.lower(), leaf)
    found = F.transform(col(topics), lambda t: lookup(owner, F.lower(t)))
    return F.coalesce(F.array_distinct(F.filter(found, lambda x: x.isNotNull())), F.array().cast(_NONE))


def by_language(language: Column | str, table: dict[str, str] = K.LANGUAGE_CATEGORIES) -> Column:
    """Zero or one category."""
    return without_nulls([lookup(table, F.lower(strip(language)))])


def by_exact_language(language: Column | str) -> Column:
    """The older table: eleven names, not trimmed."""
    return without_nulls([lookup(K.LEGACY_LANGUAGE_CATEGORIES, F.lower(col(language)))])


def keyword_text(description, topics, name) -> Column:
    blank = F.lit("")
    return F.concat_ws(
        " ", F.coalesce(col(description), blank), F.array_join(F.coalesce(col(topics), F.array().cast(_NONE)), " "),
        F.coalesce(col(name), blank),
    )


def keyword_pattern(words) -> str:
    """One pattern over lower-cased text: ASCII words need free edges, other words match anywhere."""
    lowered = [w.lower() for w in words]
    plain = [java_quote(w) for w in lowered if w.isascii()]
    wide = [java_quote(w) for w in lowered if not w.isascii()]
    parts = [f"(?<![a-z0-9])(?:{'|'.join(plain)})(?![a-z0-9])"] if plain else []
    return "|".join(parts + wide)


_EDGE = "(?<=[a-z0-9])(?![a-z0-9])|(?<![a-z0-9])(?=[a-z0-9])"  # between a run of letters and digits and what is around it


def found_words(lowered: Column, words: list[str]) -> Column:
    """Those of ``words`` that occur with free edges; each begins and ends with an ASCII letter or digit.

    The text is cut once into runs of letters and digits and what stands between; a word of n runs is looked up among
    the strings of n runs. The cost follows the text, whatever the number of words.
    """
    runs: dict[int, list[str]] = {}
    for word in dict.fromkeys(words):
        runs.setdefault(len(re.findall("[a-z0-9]+", word)), []).append(word)

    def joined(pieces: Column, n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(pieces)), lambda i: F.array_join(F.slice(pieces, i, 2 * n - 1), ""))

    def look_up(pieces: Column) -> Column:
        found = [F.array_intersect(pieces, string_array(runs[1]))] if 1 in runs else []
        for n in sorted(set(runs) - {1}):
            starts = string_array(dict.fromkeys(re.match("[a-z0-9]+", w)[0] for w in runs[n]))
            hit = F.array_intersect(joined(pieces, n), string_array(runs[n]))
            found.append(F.when(F.arrays_overlap(pieces, starts), hit).otherwise(F.array().cast(_NONE)))
        return F.concat(*found)

    return bind(F.split(F.coalesce(lowered, F.lit("")), _EDGE, -1), look_up)


FEW_WORDS = 64  # up to here a test for each leaf is cheaper than cutting the text; the rows are the same

_MARKED = r"[^a-z0-9 ]"  # a sign or a letter of another script


def _word_keys(word: str) -> list[str]:
    """Strings that a text with ``word`` must hold: its runs, for an ASCII word with free edges; else its marked characters
    with the one after them, or alone where none has one after it."""
    runs = re.findall("[a-z0-9]+", word) if word.isascii() else []
    return runs or re.findall(f"(?s)(?=({_MARKED}.))", word) or re.findall(_MARKED, word)


def found_odd_words(lowered: Column, words: list[str]) -> Column:
    """Those of ``words`` that occur: words of other scripts anywhere, ASCII words (here with a sign at an edge) with free edges.

    Each word is filed under the one of its keys that fewest words have. The keys of the text are looked up, and only the
    words filed under those found are tried one by one.
    """
    words = list(dict.fromkeys(words))
    load = Counter(key for word in words for key in set(_word_keys(word)))
    filed: dict[str, list[str]] = {}
    blank = []  # words of blanks only have no key
    for word in words:
        keys = _word_keys(word)
        if keys:
            filed.setdefault(min(keys, key=lambda k: (load[k], -len(k), k)), []).append(word)
        else:
            blank.append(word)
    runs = [k for k in filed if re.fullmatch("[a-z0-9]+", k)]
    pairs, singles = ([k for k in filed if len(k) == n and re.match(_MARKED, k)] for n in (2, 1))

    def occurs(text: Column, word: Column) -> Column:
        quoted = F.regexp_replace(word, "([^a-z0-9])", r"\\$1")
        free = F.regexp_like(text, F.concat(F.lit("(?<![a-z0-9])"), quoted, F.lit("(?![a-z0-9])")))
        return F.contains(text, word) & (word.rlike(r"[^\x00-\x7f]") | free)

    def try_words(text: Column) -> Column:
        hits = []
        if runs:
            hits.append(F.array_intersect(F.split(text, "[^a-z0-9]+", -1), string_array(runs)))
        if pairs:
            hits.append(F.array_intersect(F.regexp_extract_all(text, F.lit(f"(?s)(?=({_MARKED}.))"), F.lit(1)), string_array(pairs)))
        if singles:
            hits.append(F.array_intersect(F.regexp_extract_all(text, F.lit(f"({_MARKED})"), F.lit(1)), string_array(singles)))
        likely = [F.flatten(F.transform(F.concat(*hits), lambda k: F.try_element_at(literal_lists(filed), k)))] if hits else []
        return F.filter(F.concat(*likely, string_array(blank)), lambda w: occurs(text, w))

    return bind(F.coalesce(lowered, F.lit("")), try_words)


def by_keywords(text: Column, taxonomy: Taxonomy, leaves=None, few: int = FEW_WORDS) -> Column:
    """Leaves whose keyword occurs in the text, in taxonomy order: one narrow pass, no join.

    A taxonomy of up to ``few`` words has a test for each leaf; larger ones are looked up, so the cost follows the text.
    """
    lowered = F.lower(text)
    wanted = {leaf: [w.lower() for w in words] for leaf, words in taxonomy.keywords.items() if leaves is None or leaf in leaves}
    every = [w for words in wanted.values() for w in words]
    if len(every) <= few:
        tests = {leaf: reduce(or_, [lowered.contains(w) for w in words]) & lowered.rlike(keyword_pattern(words))
                 for leaf, words in wanted.items() if words}
        return without_nulls([F.when(test, F.lit(leaf)) for leaf, test in tests.items()])
    simple = [w for w in every if w.isascii() and re.fullmatch("[a-z0-9](?:.*[a-z0-9])?", w, re.S)]
    odd = [w for w in every if w not in set(simple)]

    def leaf_hits(found: Column) -> Column:
        return without_nulls([F.when(F.arrays_overlap(found, string_array(words)), F.lit(leaf)) for leaf, words in wanted.items() if words])

    parts = [found_words(lowered, simple)] if simple else []
    parts += [found_odd_words(lowered, odd)] if odd else []
    return bind(F.concat(*parts), leaf_hits)


def by_substrings(description, topics, name, keywords: dict[str, list[str]]) -> Column:
    """The older match: plain substrings of lower-cased text."""
    text = F.lower(keyword_text(description, topics, name))
    hits = [
        F.when(any_of([text.contains(w.lower()) for w in words]), F.lit(category))
        for category, words in keywords.items()
    ]
    return without_nulls(hits)


def declared(names: Column, taxonomy: Taxonomy) -> Column:
    """Keep declared leaves, first occurrence only."""
    leaves = string_array(taxonomy.leaves)
    return F.array_distinct(F.filter(names, lambda n: F.array_contains(leaves, n)))


def classify(description, topics, name, language, taxonomy: Taxonomy, limit: int = K.MAX_CATEGORIES) -> Column:
    """Strongest signal first: topics, language, keywords."""
    known = {k: v for k, v in K.LANGUAGE_CATEGORIES.items() if v in taxonomy.leaf_parent}
    ranked = F.concat(
        by_topics(topics, taxonomy),
        by_language(language, known),
        by_keywords(keyword_text(description, topics, name), taxonomy),
    )
    return F.slice(F.array_distinct(ranked), 1, limit)


def clean_heading(section: Column | str) -> Column:
    text = F.coalesce(col(section), F.lit(""))
    for pattern in (K.HEADING_NOISE, K.HEADING_EMOJI, r"\s+"):
        text = F.regexp_replace(text, pattern, " ")
    return strip(F.btrim(strip(text), F.lit(K.HEADING_EDGES)))


def heading_category(section: Column | str, taxonomy: Taxonomy) -> Column:
    """Leaf named by a heading, else the first keyword match, else null."""
    by_leaf = {leaf.lower(): leaf for leaf in taxonomy.leaves}

    def resolve(title: Column) -> Column:
        guess = _first(by_keywords(title, taxonomy))
        for parent, leaves in taxonomy.parents.items():
            guess = F.when(title == parent, _first(by_keywords(title, taxonomy, set(leaves)))).otherwise(guess)
        return F.when(title != "", F.coalesce(lookup(by_leaf, F.lower(title)), guess))

    return bind(clean_heading(section), resolve)


def with_section(section_leaf: Column, classified: Column) -> Column:
    """Heading category first, then the others; the union is not capped."""
    return F.array_distinct(F.array_compact(F.concat(F.array(section_leaf), classified)))


def parent_of(category: Column | str, taxonomy: Taxonomy) -> Column:
    """The parent of one declared leaf, as in ``parents_of``; null for any other name."""
    return lookup(taxonomy.leaf_parent, col(category))


def parents_of(categories: Column | str, taxonomy: Taxonomy) -> Column:
    """``map<leaf,parent>`` for the declared leaves of a record."""
    table = taxonomy.leaf_parent
    return F.map_from_entries(
        F.transform(
            declared(col(categories), taxonomy),
            lambda leaf: F.struct(leaf.alias("key"), lookup(table, leaf).alias("value")),
        )
    )
