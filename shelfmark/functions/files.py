"""Decoding, kinds and byte caps of repository files."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import constants as K
from .text import any_of, col


def decode_base64(c: Column | str) -> Column:
    """Text of a base64 payload: bad input -> '', bad UTF-8 replaced."""
    raw = F.try_to_binary(col(c), F.lit("base64"))
    return F.coalesce(F.make_valid_utf8(raw.cast("string")), F.lit(""))


def file_kind(
    listing, type_, name, readme: bool = True, docs: bool = True, api_specs: bool = True
) -> Column:
    """``readme``, ``api`` or ``docs``; null for files that are not stored."""
    lowered = F.lower(F.coalesce(col(name), F.lit("")))
    doc = any_of([lowered.endswith(s) for s in K.DOC_SUFFIXES])
    in_listing = col(listing).isin(*K.LISTINGS) & (col(type_) == "file")
    kind = F.when((col(listing) == K.README_LISTING) & F.lit(readme), "readme")
    kind = kind.when(in_listing & lowered.isin(*K.API_SPEC_NAMES) & F.lit(api_specs), "api")
    return kind.when(in_listing & doc & F.lit(docs), "docs")


def capped_text(text: Column, max_bytes: int = K.MAX_BYTES_PER_FILE) -> Column:
    """``struct(content, bytes, truncated)``, cut at a byte count; a split character is replaced."""
    too_long = F.octet_length(text) > max_bytes
    cut = F.make_valid_utf8(F.substr(F.encode(text, "UTF-8"), F.lit(1), F.lit(max_bytes)).cast("string"))
    content = F.when(too_long, cut).otherwise(text)
    return F.struct(
        content.alias("content"), F.octet_length(content).cast("bigint").alias("bytes"), too_long.alias("truncated")
    )
