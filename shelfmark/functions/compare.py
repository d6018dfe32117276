"""Comparison of two snapshot rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import constants as K
from ..schemas import REPOSITORY
from .clock import days_since
from .text import is_set


def comparable(columns: list[str]) -> list[Column]:
    """``id`` and the compared fields; flat status and score win over the nested ones."""
    have = set(columns)
    typed = lambda name: REPOSITORY[name].dataType if name in REPOSITORY.fieldNames() else "string"
    pick = lambda name: F.col(name) if name in have else F.lit(None).cast(typed(name))
    nested = lambda outer, inner: F.col(f"{outer}.{inner}") if outer in have else F.lit(None)
    out = [F.col("id")]
    for name in K.DIFF_FIELDS:
        if name == "health_status":
            value = F.coalesce(F.nullif(pick(name).cast("string"), F.lit("")), nested("health", "status").cast("string"))
        elif name == "score_overall":
            value = F.coalesce(pick(name).cast("double"), nested("score", "overall").cast("double"))
        else:
            value = pick(name)
        out.append(value.alias(name))
    return out


def as_text(name: str, value: Column) -> Column:
    return F.to_json(value) if name == "topics" else value.cast("string")


def change_map(old: str, new: str) -> Column:
    """``map<field, struct<from,to>>`` of the fields that differ; nulls compare as values."""
    pairs = []
    for name in K.DIFF_FIELDS:
        before, after = F.col(f"{old}.{name}"), F.col(f"{new}.{name}")
        pairs += [F.lit(name), F.struct(
            as_text(name, before).alias("from"), as_text(name, after).alias("to"),
        )]
    return F.map_filter(F.create_map(*pairs), lambda k, v: ~v["from"].eqNullSafe(v["to"]))


def is_stale(status: Column, pushed_at: Column, as_of, days: int = K.STALE_DAYS) -> Column:
    old = F.coalesce(days_since(pushed_at, as_of) > days, F.lit(False))
    return F.coalesce(status == "STALE", F.lit(False)) | old


def is_archived(status: Column, archived: Column) -> Column:
    return F.coalesce(archived, F.lit(False)) | F.coalesce(status == "ARCHIVED", F.lit(False))


def snapshot_status(flat: Column, nested: Column) -> Column:
    return F.coalesce(F.when(is_set(flat), flat), F.when(is_set(nested), nested), F.lit(K.UNKNOWN_HEALTH))
