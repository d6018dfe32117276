"""Ages relative to an explicit ``as_of``; nothing here reads the wall clock."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import col

_DAY_MICROS = 86_400_000_000


def moment(value) -> Column:
    """A timestamp column from a column, a datetime or an ISO string."""
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def parse(c: Column | str) -> Column:
    """ISO text to timestamp, null for anything else."""
    return col(c).try_cast("timestamp")


def _elapsed(c: Column | str, as_of) -> Column:
    return F.unix_micros(moment(as_of)) - F.unix_micros(col(c))


def days_since(c: Column | str, as_of) -> Column:
    """Whole elapsed days, rounded down."""
    return F.floor(_elapsed(c, as_of) / _DAY_MICROS).cast("bigint")


def fractional_days_since(c: Column | str, as_of) -> Column:
    return _elapsed(c, as_of) / _DAY_MICROS


def within_days(c: Column | str, as_of, days: int) -> Column:
    """At most ``days`` before ``as_of``."""
    return F.unix_micros(col(c)) >= F.unix_micros(moment(as_of)) - F.lit(days * _DAY_MICROS)
