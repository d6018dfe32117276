"""Aggregates, dedupe, snapshot diff, sorts and rankings."""

from pyspark.sql import functions as F

from shelfmark.functions import markdown as M
from shelfmark.functions.urls import repository_id
from shelfmark.operators import activity, catalog, content, diff, discover, findings, ranking, records, refresh, reports
from shelfmark.sources import tables

from .common import hits, nested, scratch, text
from .q_findings import RECURSIVE_KEPT, FILE_VIEWS, FINDINGS_SQL, LIMITS, part_findings, repo_files
from .q_joins import DUE_SQL, FRESH_SQL, OWNERS_SQL, fresh_rows, part_records, raw_records, two_snapshots
from .q_sources import ENTRY_VIEWS, entries, entries_sql
from .registry import query
from .views import AS_OF, DATE1, DATE2, DIFF_AS_OF, DIFF_AS_OF_S, FACTS_AS_OF, FACTS_AS_OF_S


@query("a01_stats", """
    select 'total' as measure, '' as key, count(*) as value from repos union all select 'stars', '', cast(coalesce(sum(stars), 0) as bigint) from repos
    union all select 'health', health_status, count(*) from repos group by health_status
    union all select 'language', language, count(*) from repos where language is not null group by language""", ("repos",))
def stats(t):
    return catalog.stats(t("repos"))


@query("a02_count", "select count(*) as n from repos", ("repos",))
def count(t):
    return catalog.count(t("repos"))


@query("a03_sources_per_record", """
    select repository_id, row_number() over (partition by repository_id order by source_repository, source_section) as position,
        source_repository as repository, source_section as section from (select distinct * from provenance)""", ("provenance",))
def sources_per_record(t):
    return catalog.sources_per_record(t("provenance").distinct())


@query("a03_sources_per_list_parts", """
    select source_repository, count(*) as n from (select distinct source_repository, repository_id from provenance) group by 1""", ("provenance",))
def sources_per_list(t):
    """The same numbering for few, large keys: the last position is the size, nothing lost."""
    pairs = t("provenance").select("source_repository", "repository_id").distinct()
    numbered = ranking.position_in_group(pairs, ["source_repository"], [F.asc("repository_id")], "position")
    return numbered.groupBy("source_repository").agg(F.max("position").alias("n"))


@query("a04_category_summary", f"""
    with {entries_sql()} select count(distinct id) as total, count(distinct category) as categories, count(distinct parent) as parents from entries""", ENTRY_VIEWS)
def category_summary(t):
    return catalog.category_summary(entries(t))


@query("a05_group_counts", f"""
    with {entries_sql()} select parent, null as leaf, count(*) as n from entries group by parent
    union all select parent, category, count(*) from entries where category <> parent group by parent, category""", ENTRY_VIEWS)
def group_counts(t):
    return reports.group_counts(entries(t))


@query("a06_distinct_records", f"with {entries_sql()} select count(distinct id) as n from entries", ENTRY_VIEWS)
def distinct_records(t):
    return reports.distinct_records(entries(t))


@query("a07_run_summary", """
    with firsts as (select arg_min(topics, seq) as topics, count(*) as n from raw_ids group by rid)
    select count(*) as collected, count(*) filter (where n > 1) as duplicates_merged, count(*) filter (where len(topics) > 0) as categorized from firsts""",
       ("raw_ids",))
def run_summary(t):
    raw = raw_records(t)
    return catalog.run_summary(
        records.dedupe(raw).withColumn("categories", F.col("topics")), records.duplicate_counts(raw))


@query("a08_dedupe_hits", """
    select 'github:' || lower(owner) || '/' || lower(name) as id, min(seq) as seq from hits_flat where owner <> '' and name <> '' group by 1""", ("hits_flat",))
def dedupe_hits(t):
    return discover.dedupe_hits(hits(t("hits_flat"))).select(
        repository_id("repository.owner.login", "repository.name").alias("id"), "seq")


@query("a09_dedupe_records", "select rid as id, min(seq) as seq from raw_ids group by rid", ("raw_ids",))
def dedupe_records(t):
    return records.dedupe(raw_records(t)).select("id", "seq")


@query("a09_dedupe_on_fields", "select low_owner as owner, coalesce(lower(license), '') as license, min(seq) as seq from raw_ids group by 1, 2", ("raw_ids",))
def dedupe_on_fields(t):
    return records.dedupe(raw_records(t), ["owner", "license"]).select("owner", F.lower(F.coalesce("license", F.lit(""))).alias("license"), "seq")


@query("a09_duplicate_rows", """
    select rid as primary_id, seq from (select rid, seq, min(seq) over (partition by rid) as first_seq from raw_ids) where seq > first_seq""", ("raw_ids",))
def duplicate_rows(t):
    return records.duplicates(raw_records(t)).select("primary_id", "seq")


@query("a09_duplicate_counts", "select rid as primary_id, cast(count(*) - 1 as bigint) as duplicates from raw_ids group by rid having count(*) > 1", ("raw_ids",))
def duplicate_counts(t):
    return records.duplicate_counts(raw_records(t))


@query("a10_merge_sources", """
    select seq, 'github:lists/a|x,' || source_repository || '|' || source_section || case when source_section = '1-URGENT' then '' else ',' || source_repository || '|1-URGENT' end as sources from raw""", ("raw",))
def merge_sources(t):
    pair = lambda r, s: F.struct(r.alias("repository"), s.alias("section"))
    own, urgent = pair(F.col("source_repository"), F.col("source_section")), pair(F.col("source_repository"), F.lit("1-URGENT"))
    first = pair(F.lit("github:lists/a"), F.lit("x"))
    merged = records.merge_sources(F.array(first, own), F.array(urgent, own, first))
    return t("raw").select("seq", F.array_join(F.transform(
        merged, lambda s: F.concat_ws("|", s["repository"], s["section"])), ",").alias("sources"))


@query("a11_dedupe_findings", """
    select osv_id as advisory_id, coalesce(ecosystem, '') as package, min(seq) as seq from advisories group by 1, 2""", ("advisories",))
def dedupe_findings(t):
    rows = t("advisories").select(
        F.lit("osv").alias("source"), F.col("osv_id").alias("advisory_id"), F.coalesce("ecosystem", F.lit("")).alias("package"),
        F.lit(None).cast("string").alias("repository_id"), "seq", F.lit(0).alias("entry"))
    return findings.dedupe(rows).select("advisory_id", "package", "seq")


@query("a12_enrichment_report", f"""
    with {OWNERS_SQL}, {FINDINGS_SQL} select (select count(*) from found) as finding_count, (select count(*) from partrepos) as repositories_scanned,
        (select count(*) from owners) as packages_queried, cast(0 as bigint) as error_count""", ("partrepos", "advisories"))
def enrichment_report(t):
    return findings.report(part_records(t), part_findings(t))


@query("a13_extraction_report", RECURSIVE_KEPT + """
    select (select count(*) from doc_repos) as selected, (select count(distinct repository_id) from kept) as succeeded,
      (select count(*) from doc_repos where id like 'github:%' and id not in (select repository_id from kept)) as skipped,
      (select count(*) from doc_repos where id not like 'github:%') as failed, (select count(*) from kept) as documents""", FILE_VIEWS)
def extraction_report(t):
    selected = t("doc_repos")
    docs = content.documents(selected, repo_files(t), **LIMITS)
    return content.report(content.statuses(selected, docs))


@query("a14_refresh_report", f"""
    with {FRESH_SQL}, chosen as (select id from repos where {DUE_SQL} order by collected_at asc nulls first, id limit 500)
    select (select count(*) from chosen) as checked, (select count(*) from chosen join fresh using (id)) as updated,
        (select count(*) from repos) - (select count(*) from chosen) as skipped,
        (select count(*) from chosen) - (select count(*) from chosen join fresh using (id)) as failed,
        (select count(*) from repos where {DUE_SQL}) as due""", ("repos",))
def refresh_report(t):
    return refresh.report(nested(t("repos")), fresh_rows(t), AS_OF, limit=500)


@query("a15_list_metadata", r"""
    with x as (select list_id, regexp_extract_all(markdown, '(?m)^#{1,6}\s+(.+)$', 1) as titles, regexp_extract_all(markdown, '\[([^\]]*)\]\(([^)]+)\)', 2) as urls from lists_md)
    select list_id, cast(len(titles) as bigint) as section_count, array_to_string(titles, '~') as sections, cast(len(urls) as bigint) as total_links,
        cast(len(list_filter(urls, lambda u: regexp_matches(u, '^https?://(www\.)?github\.com(/|$)'))) as bigint) as repository_count from x""", ("lists_md",))
def list_metadata(t):
    return t("lists_md").select("list_id", M.list_metadata("markdown").alias("m")).select(
        "list_id", "m.section_count", F.array_join("m.sections", "~").alias("sections"), "m.total_links", "m.repository_count")


ROLLUP_SQL = f"""
    rolled as (select id, max(case when kind = 'commit' then ts end) as last_commit,
        count(*) filter (where kind = 'commit' and epoch(ts) >= {FACTS_AS_OF_S} - 30 * 86400) as commits_30d,
        count(*) filter (where kind = 'release' and epoch(ts) >= {FACTS_AS_OF_S} - 90 * 86400) as releases_90d,
        count(distinct case when kind = 'contributor' and epoch(ts) >= {FACTS_AS_OF_S} - 90 * 86400 then who end) as contributors_90d,
        max(case when kind = 'release' then ts end) as last_release from activity_facts group by id)"""
DAYS = lambda c: f"floor(({FACTS_AS_OF_S} - epoch({c})) / 86400.0)"


@query("a16_activity_rollup", f"""
    with {ROLLUP_SQL} select id, commits_30d, releases_90d, contributors_90d, cast(cast({DAYS('last_commit')} as bigint) as varchar) as last_push_days,
        cast(cast({DAYS('last_release')} as bigint) as varchar) as release_days from rolled""", ("activity_facts",))
def activity_rollup(t):
    return activity.rollup(t("activity_facts"), FACTS_AS_OF).select(
        "id", "commits_30d", "releases_90d", "contributors_90d", text("last_push_days"), text("release_days"))


@query("a17_activity_estimate", f"""
    with {ROLLUP_SQL} select r.id, cast(cast(case when f.id is null then {DAYS('r.pushed_at')} else {DAYS('f.last_commit')} end as bigint) as varchar) as last_push_days,
        cast(f.commits_30d as varchar) as commits_30d, cast(f.contributors_90d as varchar) as contributors_90d
    from repos r left join rolled f on f.id = r.id""", ("repos", "activity_facts"))
def activity_estimate(t):
    df = activity.attach(nested(t("repos")), t("activity_facts"), FACTS_AS_OF)
    return df.select("id", text("activity.last_push_days"), text("activity.commits_30d"), text("activity.contributors_90d")).toDF(
        "id", "last_push_days", "commits_30d", "contributors_90d")


# --- snapshot diff

OLD_NEW = f"a as (select * from snapshots where date = '{DATE1}'), b as (select * from snapshots where date = '{DATE2}')"
_FIELDS = {
    "stars": "cast({}.stars as varchar)", "forks": "cast({}.forks as varchar)", "issues": "cast({}.issues as varchar)", "language": "{}.language",
    "description": "{}.description", "license": "{}.license",
    "topics": "'[' || array_to_string(list_transform({}.topics, lambda x: '\"' || x || '\"'), ',') || ']'",
    "archived": "cast({}.archived as varchar)", "pushed_at": "strftime({}.pushed_at, '%Y-%m-%d %H:%M:%S')", "updated_at": "strftime({}.updated_at, '%Y-%m-%d %H:%M:%S')",
    "health_status": "nullif({}.health_status, '')", "score_overall": "cast({}.score_overall as varchar)",
}
CHANGES_SQL = " union all ".join(
    f"select b.id, '{name}' as field, {sql.format('a')} as \"from\", {sql.format('b')} as \"to\" from a join b on a.id = b.id where {sql.format('a')} is distinct from {sql.format('b')}"
    for name, sql in _FIELDS.items())
_AGE = f"floor(({DIFF_AS_OF_S} - epoch(pushed_at)) / 86400.0)"
STALE_SQL = f"(coalesce(health_status, '') = 'STALE' or coalesce({_AGE} > 180, false))"
ARCHIVED_SQL = "(archived or coalesce(health_status, '') = 'ARCHIVED')"
GAIN = "coalesce(b.stars, 0) - coalesce(a.stars, 0)"


def changed(t):
    old, new = two_snapshots(t)
    return diff.changes(old, new, DIFF_AS_OF)


@query("d01_new_records", f"with {OLD_NEW} select id from b where id not in (select id from a)", ("snapshots",))
def new_records(t):
    return diff.new_records(*two_snapshots(t)).select("id")


@query("d02_removed_records", f"with {OLD_NEW} select id from a where id not in (select id from b)", ("snapshots",))
def removed_records(t):
    return diff.removed_records(*two_snapshots(t)).select("id")


@query("d03_updated_fields", f"with {OLD_NEW} {CHANGES_SQL}", ("snapshots",))
def updated_fields(t):
    return diff.change_rows(changed(t))


@query("d04_trending", f"with {OLD_NEW} select b.id, {GAIN} as star_gain from a join b on a.id = b.id where {GAIN} >= 500", ("snapshots",))
def trending_gain(t):
    return changed(t).filter("is_trending").select("id", "star_gain")


@query("d05_stale_archived", f"with {OLD_NEW} select id, {STALE_SQL} as is_stale, {ARCHIVED_SQL} as is_archived from b where {STALE_SQL} or {ARCHIVED_SQL}", ("snapshots",))
def stale_archived(t):
    return changed(t).filter("is_stale or is_archived").select("id", "is_stale", "is_archived")


SUMMARY_SQL = f"""select (select count(*) from b where id not in (select id from a)) as new_count,
        (select count(*) from a join b on a.id = b.id where {GAIN} >= 500) as trending_count, (select count(distinct id) from ({CHANGES_SQL})) as updated_count,
        (select count(*) from b where {STALE_SQL}) as stale_count, (select count(*) from b where {ARCHIVED_SQL}) as archived_count,
        (select count(*) from a where id not in (select id from b)) as removed_count"""


@query("d06_diff_summary", f"with {OLD_NEW} {SUMMARY_SQL}", ("snapshots",))
def diff_summary(t):
    return diff.summary(diff.between(t("snapshots"), DATE1, DATE2, DIFF_AS_OF))


def stored_flags(t):
    """Flagged rows from snapshots that were stored with their digests."""
    rows = diff.with_digest(t("snapshots"))
    spark, path = rows.sparkSession, scratch(rows.sparkSession, "d06")
    tables.write_partitions(rows, path, "date")
    return diff.flagged_between(spark.read.parquet(path).withColumn("date", F.col("date").cast("string")), DATE1, DATE2, DIFF_AS_OF)


@query("d06_summary_by_digest", f"with {OLD_NEW} {SUMMARY_SQL}", ("snapshots",))
def summary_by_digest(t):
    return diff.summary(stored_flags(t))


@query("d03_fields_by_digest", f"with {OLD_NEW} {CHANGES_SQL}", ("snapshots",))
def fields_by_digest(t):
    return diff.change_rows(stored_flags(t))


@query("d07_set_operations", f"""
    with {OLD_NEW} select 'both' as kind, id from (select id from a intersect select id from b) union all select 'either', id from (select id from a union select id from b)
    union all select 'except', id from (select id from a except select id from b)""", ("snapshots",))
def set_operations(t):
    old, new = (x.select("id") for x in two_snapshots(t))
    tag = lambda df, kind: df.select(F.lit(kind).alias("kind"), "id")
    return tag(old.join(new, "id", "left_semi"), "both").unionByName(
        tag(discover.union_hits(old, new).distinct(), "either")).unionByName(tag(diff.removed_records(old, new), "except"))


# --- sorts and rankings

@query("l01_leaf_ranking", f"""
    with {entries_sql()} select parent, category, id, row_number() over (partition by parent, category order by score desc, stars desc, id) as position from entries""", ENTRY_VIEWS)
def leaf_ranking(t):
    rows = entries(t).select("parent", "category", "id", "score", "stars")
    return reports.ranked_entries(rows).select("parent", "category", "id", "position")


@query("l02_select_for_content", "select id from repos where coalesce(score_overall, 0) >= 20 order by coalesce(score_overall, 0) desc, id limit 100", ("repos",))
def select_for_content(t):
    return content.select_records(t("repos"), 20).select("id")


@query("l03_trending", """
    select id, score_overall as score, (select count(*) from repos where score_overall >= 75) as total from repos where score_overall >= 75
    order by score_overall desc, id limit 20""", ("repos",))
def trending(t):
    return ranking.trending(t("repos"), 75).select("id", F.col("score_overall").alias("score"), "total")


@query("l04_high_scoring", f"""
    with {entries_sql()}, once as (select *, row_number() over (partition by id order by parent, category) as n from entries)
    select id, parent, category, score, stars from once where n = 1 order by score desc, stars desc, id limit 50""", ENTRY_VIEWS)
def high_scoring(t):
    return reports.high_scoring(entries(t)).select("id", "parent", "category", "score", "stars")


@query("l05_report_sample", "select id from repos order by coalesce(score_overall, 0) desc, id limit 20", ("repos",))
def report_sample(t):
    return reports.report_sample(t("repos")).select("id")


@query("l06_refresh_limit", f"select id from repos where {DUE_SQL} order by collected_at asc nulls first, id limit 100", ("repos",))
def refresh_limit(t):
    return refresh.select_due(nested(t("repos")), AS_OF, limit=100).select("id")
