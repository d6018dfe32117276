from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

_BLANKS = " \t\n\r\f\x0b"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim ASCII white space on both ends."""
    return F.btrim(col(c), F.lit(_BLANKS))


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), 0)


def is_set(c: Column | str) -> Column:
    """Not null and not the empty string."""
    return F.coalesce(col(c) != "", F.lit(False))


def any_of(conditions: list[Column]) -> Column:
    """OR over conditions with null read as false."""
    out = F.lit(False)
    for condition in conditions:
        out = out | F.coalesce(condition, F.lit(False))
    return out


def literal_alternation(words) -> str:
    """Java pattern that matches any of the words as plain text."""
    return "|".join(java_quote(word) for word in words)


def java_quote(word: str) -> str:
    return re.sub(r"([\\.\[\]{}()*+?^$|#&\-~])", r"\\\1", word)


def string_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def literal_lists(mapping: dict[str, list[str]]) -> Column:
    return F.create_map(*[x for key, values in mapping.items() for x in (F.lit(key), string_array(values))])


def lookup(mapping: dict, key: Column) -> Column:
    """Literal map lookup, null for a missing key."""
    if not mapping:
        return F.lit(None).cast("string")
    return F.try_element_at(literal_map(mapping), key)


def thousands(c: Column | str) -> Column:
    return F.format_number(col(c), 0)
