"""Quality scores in exact integer units of 1/10000 point; rounding is half up, to one digit.

Every weight of the formulas is a multiple of a unit, so a component is a sum of integer
products: no floating point, no decimal objects per row, and no division before the rounding.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from .. import constants as K
from .clock import days_since
from .text import col, is_set

NO_PUSH_DAYS = 999
UNITS = 10_000
_WEIGHT_DIGITS = 9


def points(units: Column, scale: int = UNITS) -> Column:
    """Units to points, rounded half up to one digit."""
    tenth = scale // 10
    return F.call_function("div", units + F.lit(tenth // 2), F.lit(tenth)).cast("double") / F.lit(10.0)


def _count(c) -> Column:
    return F.coalesce(col(c).cast("bigint"), F.lit(0).cast("bigint"))


def _share(c, limit: int, weight: int) -> Column:
    """``weight`` points at ``limit`` and above, in proportion below."""
    return F.least(_count(c), F.lit(limit).cast("bigint")) * F.lit(weight * UNITS // limit)


def _steps(value: Column, steps: list[tuple[int, int]], otherwise: int, at_most: bool) -> Column:
    """Points of the first step the value fits."""
    out = None
    for bound, worth in steps:
        fits = value <= bound if at_most else value >= bound
        out = F.when(fits, worth) if out is None else out.when(fits, worth)
    return out.otherwise(otherwise)


def _part(whole_points: Column, percent: int) -> Column:
    """A percentage of whole points, in units."""
    return whole_points.cast("bigint") * F.lit(percent * UNITS // 100)


def _recency(days: Column) -> Column:
    return _steps(days, [(7, 100), (30, 80), (90, 50)], 20, at_most=True)


def popularity(stars, forks, contributors) -> Column:
    shares = _share(stars, 100_000, 40) + _share(forks, 10_000, 30) + _share(contributors, 20, 30)
    return F.when(_count(stars) == 0, F.lit(0).cast("bigint")).otherwise(shares)


def activity(push_days: Column, commits, releases) -> Column:
    n_commits, n_releases = _count(commits), _count(releases)
    weighted = (
        _part(_recency(push_days), 40)
        + _part(_steps(n_commits, [(10, 100), (3, 70), (1, 40)], 10, at_most=False), 30)
        + _part(_steps(n_releases, [(5, 100), (2, 70), (1, 40)], 20, at_most=False), 30)
    )
    return F.when((push_days <= 0) & (n_commits <= 0), F.lit(0).cast("bigint")).otherwise(weighted)


def maintenance(has_readme: Column, has_license: Column, response_days: Column, push_days: Column) -> Column:
    response = F.when(response_days.isNull(), 30).otherwise(
        _steps(response_days, [(7, 100), (14, 80), (30, 50)], 20, at_most=True)
    )
    total = F.when(has_readme, 100).otherwise(0) + F.when(has_license, 100).otherwise(0) + response + _recency(push_days)
    return _part(total, 25)


def community(contributors, forks, issues) -> Column:
    open_issues = _count(issues)
    calm = (
        F.when(open_issues > 500, 20).when(open_issues > 100, 40).when(open_issues > 10, 70)
        .when(open_issues > 0, 90).otherwise(100)
    )
    return _share(contributors, 20, 40) + _share(forks, 1_000, 30) + _part(calm, 30)


def documentation(description) -> Column:
    long_enough = F.coalesce(F.length(col(description)) > 20, F.lit(False))
    return _part(F.when(long_enough, 75).otherwise(50), 100)


def _holds(text: Column, words) -> Column:
    return reduce(or_, [text.contains(w) for w in words])


def license_points(key) -> Column:
    """Substring test, permissive keys first."""
    text = F.lower(col(key))
    return _part(
        F.when(~is_set(key), 0).when(_holds(text, K.PERMISSIVE_LICENSES), 100)
        .when(_holds(text, K.COPYLEFT_LICENSES), 50).otherwise(25), 100)


def security_flags(name, description, topics) -> Column:
    """``struct(policy, tool, copilot, dependabot)``."""
    edge = "\x00"
    listed = F.lower(F.concat(F.lit(edge), F.coalesce(F.array_join(col(topics), edge), F.lit("")), F.lit(edge)))
    text = F.lower(F.concat_ws("\n", col(name), col(description)))
    topic = lambda word: listed.contains(f"{edge}{word}{edge}").alias("policy" if word == "security" else word)
    return F.struct(
        topic("security"), _holds(text, K.VULNERABILITY_TOOLS).alias("tool"), topic("copilot"), topic("dependabot"))


def security(flags: Column) -> Column:
    total = F.lit(0)
    for flag, value in (("policy", 30), ("tool", 30), ("copilot", 20), ("dependabot", 20)):
        total = total + F.when(flags[flag], value).otherwise(0)
    return _part(total, 100)


def list_quality(has_info: Column, is_list: Column, categories: Column) -> Column:
    extra = F.when(F.coalesce(is_list, F.lit(False)), 25).otherwise(0) + F.when(
        F.coalesce(F.size(categories) >= 3, F.lit(False)), 25
    ).otherwise(0)
    return _part(F.lit(50) + F.when(has_info, extra).otherwise(0), 100)


def weigh(parts: dict[str, Column], weights: dict | None = None) -> Column:
    """Score struct of ``overall`` and the eight components. Weights count to nine digits."""
    step = 10 ** _WEIGHT_DIGITS
    table = {k: int(round(Decimal(str(v)) * step)) for k, v in (weights or K.SCORE_WEIGHTS).items()}
    overall = reduce(lambda a, b: a + b, [parts[n] * F.lit(table[n]).cast("bigint") for n in K.SCORE_COMPONENTS])
    return F.struct(
        points(overall, UNITS * step).alias("overall"), *[points(parts[n]).alias(n) for n in K.SCORE_COMPONENTS])


def record_parts(strict_reference: bool = False) -> dict[str, Column]:
    """The eight components of a ``REPOSITORY`` row whose ``activity`` has been filled.

    ``strict_reference`` reads a push on the day itself as "no push known".
    """
    days = F.col("activity.last_push_days")
    known = F.nullif(days, F.lit(0).cast("bigint")) if strict_reference else days
    push_days = F.coalesce(known, F.lit(NO_PUSH_DAYS))
    people = F.col("activity.contributors_90d")
    return {
        "popularity": popularity("stars", "forks", people),
        "activity": activity(push_days, F.col("activity.commits_30d"), F.col("activity.releases_90d")),
        "maintenance": maintenance(is_set("description"), is_set("license"), F.lit(None).cast("bigint"), push_days),
        "community": community(people, "forks", "issues"),
        "documentation": documentation("description"),
        "license": license_points("license"),
        "security": security(security_flags("name", "description", "topics")),
        "awesome_quality": list_quality(
            F.col("awesome").isNotNull(), F.col("awesome.is_awesome_list"), F.col("awesome.categories")
        ),
    }


def health_status(push_days: Column, release_days: Column, contributors: Column, archived: Column) -> Column:
    alive = F.coalesce((release_days <= 14) & (contributors >= 3), F.lit(False))
    return (
        F.when(F.coalesce(archived, F.lit(False)), "ARCHIVED")
        .when(push_days.isNull(), "UNKNOWN")
        .when(push_days <= 7, F.when(alive, "ACTIVE").otherwise("MAINTAINED"))
        .when(push_days <= 30, "MAINTAINED").when(push_days <= 90, "SLOW").otherwise("STALE")
    )


def record_health() -> Column:
    """Health struct of a ``REPOSITORY`` row whose ``activity`` has been filled."""
    a = lambda name: F.col(f"activity.{name}")
    return F.struct(
        health_status(a("last_push_days"), a("release_days"), a("contributors_90d"), F.col("archived")).alias("status"),
        a("last_push_days").alias("last_commit_days"), a("release_days").alias("release_days"),
        a("contributors_90d").alias("contributors_90d"),
    )


def push_health(pushed_at, as_of) -> Column:
    """Status from the push date alone; the archived flag plays no part."""
    days = days_since(pushed_at, as_of)
    return (
        F.when(days.isNull(), "UNKNOWN").when(days <= 7, "ACTIVE").when(days <= 30, "MAINTAINED")
        .when(days <= 90, "SLOW").otherwise("STALE")
    )


def refresh_interval(status, policy: dict[str, int] | None = None) -> Column:
    """Days between refreshes; an unknown status or 0 falls back to the UNKNOWN entry."""
    table = policy or K.REFRESH_POLICY
    fallback = table.get("UNKNOWN", K.REFRESH_FALLBACK_DAYS)
    listed = {k: v for k, v in table.items() if v}
    if not listed:
        return F.lit(fallback)
    entries = F.create_map(*[F.lit(x) for pair in listed.items() for x in pair])
    return F.coalesce(F.try_element_at(entries, F.coalesce(col(status), F.lit("UNKNOWN"))), F.lit(fallback))


def is_due(status, collected_at, as_of, policy: dict[str, int] | None = None) -> Column:
    age = days_since(collected_at, as_of)
    known = F.when(is_set(status), col(status)).otherwise(F.lit("UNKNOWN"))
    return F.coalesce(age >= refresh_interval(known, policy), F.lit(True))
