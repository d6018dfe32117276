"""Joins."""

from pyspark.sql import functions as F

from shelfmark.operators import catalog, diff, findings, lists, records, refresh

from .common import csv, duck_id_from_link, nested, text
from .q_sources import kev_documents
from .registry import query
from .views import AS_OF, AS_OF_S, DATE1, DATE2


@query("j01_records_in_category", "select r.id, r.name from repos r join bridge b on b.repository_id = r.id where b.category = 'Gears'",
       ("repos", "bridge"))
def records_in_category(t):
    return catalog.records_in_category(t("repos"), t("bridge"), "Gears").select("id", "name")


@query("j02_categories_per_record", """
    select repository_id, string_agg(category, ',' order by category) as categories from bridge b join categories c on c.name = b.category group by repository_id""",
       ("bridge", "categories"))
def categories_per_record(t):
    return catalog.categories_per_record(t("bridge"), t("categories")).select("repository_id", csv("categories"))


@query("j03_category_parents", "select c.name, p.name as parent from categories c left join categories p on p.name = c.parent", ("categories",))
def category_parents(t):
    return catalog.category_parents(t("categories"))


@query("j04_category_tree", """
    select p.name as parent, string_agg(c.name, ',' order by c.name) as children from categories c join categories p on p.name = c.parent group by p.name""",
       ("categories",))
def category_tree(t):
    return catalog.category_tree(t("categories")).select("parent", csv("children"))


@query("j05_placed_records", """
    select r.id, coalesce(b.category, 'Uncategorized') as category, coalesce(c.parent, 'Uncategorized') as parent
    from repos r left join bridge b on b.repository_id = r.id left join categories c on c.name = b.category""",
       ("repos", "bridge", "categories"))
def placed(t):
    return catalog.placed(t("repos"), t("bridge"), t("categories")).select("id", "category", "parent")


@query("j06_attach_facts", """
    with l as (select 'github:own' || (l_orderkey % 997) || '/order-' || l_orderkey as id, min(l_shipmode) as m, count(distinct l_suppkey) as c
        from (select *, l_returnflag as l_shipmode from lineitem) group by l_orderkey)
    select r.id, array_to_string(case when l.m = 'A' then ['fresh', 'A'] else r.topics end, ',') as topics,
        case when l.m = 'N' then 'spdx-N' when l.m = 'R' then 'key-R' else r.license end as license, coalesce(l.c, 0) as contributors_count
    from repos r left join l on l.id = r.id""", ("repos",))
def attach_facts(t):
    rid = F.concat(F.lit("github:own"), F.col("l_orderkey") % 997, F.lit("/order-"), F.col("l_orderkey"))
    per = t("lineitem").groupBy(rid.alias("id")).agg(
        F.min("l_returnflag").alias("m"), F.countDistinct("l_suppkey").alias("contributors"))
    topics = per.filter("m = 'A'").select("id", F.array(F.lit("fresh"), F.col("m")).alias("topics"))
    licenses = per.filter("m <> 'A'").select(
        "id", F.when(F.col("m") == "R", "key-R").alias("key"), F.concat(F.lit("spdx-"), "m").alias("spdx_id"))
    return records.attach_facts(t("repos"), topics, licenses, per).select(
        "id", csv("topics"), "license", "contributors_count")


# Every reference of a list, found again with the second engine's own string functions.
REFS_SQL = f"""
    found as (
        select list_id, 0 as gen, generate_subscripts(urls, 1) - 1 as pos, unnest(texts) as txt, unnest(urls) as url from (
            select list_id, regexp_extract_all(markdown, '\\[([^\\]]*)\\]\\(([^)]+)\\)', 1) as texts, regexp_extract_all(markdown, '\\[([^\\]]*)\\]\\(([^)]+)\\)', 2) as urls from lists_md)
        union all select list_id, 1, generate_subscripts(urls, 1) - 1, unnest(urls), unnest(urls) from (
            select list_id, regexp_extract_all(markdown, '(?i)(https?://github\\.com/[a-zA-Z0-9_.-]+/[a-zA-Z0-9_.-]+)', 1) as urls from lists_md)
        union all select list_id, 2, generate_subscripts(urls, 1) - 1, unnest(urls), unnest(urls) from (
            select list_id, regexp_extract_all(markdown, '<(https://github\\.com/[a-zA-Z0-9_.-]+/[a-zA-Z0-9_.-]+)>', 1) as urls from lists_md)),
    refs as (select *, {duck_id_from_link('url')} as repo_id from found where {duck_id_from_link('url')} is not null)"""

# Section of each body line by carrying the last heading, then the first line with the name.
SECTIONS_SQL = r"""
    doc_lines as (select list_id, generate_subscripts(ls, 1) as line_no, unnest(ls) as line from (select list_id, split(markdown, chr(10)) as ls from lists_md)),
    carried as (select *, regexp_matches(line, '^#{1,6}\s+.+$') as is_head, coalesce(last_value(case when regexp_matches(line, '^#{1,6}\s+.+$')
        then trim(regexp_extract(line, '^#{1,6}\s+(.+)$', 1)) end ignore nulls) over (partition by list_id order by line_no), '') as section from doc_lines),
    names as (select distinct list_id, repo_id, split_part(repo_id, '/', 2) as nm from refs),
    mentions as (select n.list_id, n.repo_id, arg_min(c.section, c.line_no) as section from names n join carried c on c.list_id = n.list_id
        and not c.is_head and contains(lower(c.line), '/' || n.nm) group by n.list_id, n.repo_id)"""


@query("j07_infer_sections", f"""
    with {REFS_SQL}, {SECTIONS_SQL} select n.list_id, n.repo_id, m.section from names n left join mentions m on m.list_id = n.list_id and m.repo_id = n.repo_id""",
       ("lists_md",))
def infer_sections(t):
    docs = t("lists_md")
    refs = lists.references(docs).select("list_id", "repo_id").distinct()
    return lists.infer_sections(docs, refs)


def duck_package(c: str) -> str:
    return f"regexp_replace(lower(trim(coalesce({c}, ''))), '[-_.]+', '-', 'g')"


OWNERS_SQL = f"""
    owners as (select package, arg_min(id, seq) as repository_id from (
        select id, seq, {duck_package('name')} as package from partrepos
        union all select id, seq, {duck_package('p')} from (select id, seq, unnest(package_names) as p from partrepos)) where package <> '' group by package)"""


def part_records(t):
    return t("partrepos").withColumn("awesome", F.struct("package_names")).drop("package_names")


@query("j08_link_packages", f"""
    with {OWNERS_SQL} select a.seq, a.package, o.repository_id from advisories a left join owners o on o.package = {duck_package('a.package')}""",
       ("partrepos", "advisories"))
def link_packages(t):
    owners = findings.package_owners(part_records(t))
    rows = findings.osv_rows(osv_responses(t), AS_OF)
    return findings.link_optional(rows, owners).select("seq", "package", "repository_id")


def osv_responses(t):
    severity = F.array(F.struct(F.lit("CVSS").alias("type"), F.col("score1").alias("score")),
                       F.struct(F.lit("CVSS").alias("type"), F.col("score2").alias("score")))
    vuln = F.struct(
        F.col("osv_id").alias("id"), "summary", severity.alias("severity"), F.array("alias1", "alias2").alias("aliases"),
        F.struct(F.col("db_severity").alias("severity")).alias("database_specific"))
    return t("advisories").select("seq", "package", "ecosystem", F.array(vuln).alias("vulns"))


KEV_SQL = f"""
    kev as (select a.seq, a.cve_id, a.date_added, a.summary, {duck_package('a.product')} as pk, {duck_package('a.vendor')} as vk, op.repository_id as by_product, ov.repository_id as by_vendor
        from advisories a left join owners op on op.package = {duck_package('a.product')} left join owners ov on ov.package = {duck_package('a.vendor')}
        where op.package is not null or ov.package is not null)"""


@query("j09_kev_match", f"""
    with {OWNERS_SQL}, {KEV_SQL} select seq, case when pk <> '' then pk else vk end as package, case when pk <> '' then by_product else by_vendor end as repository_id from kev""",
       ("partrepos", "advisories"))
def kev_match(t):
    owners = findings.package_owners(part_records(t))
    return findings.kev_matches(findings.kev_entries(kev_documents(t)), owners).select("seq", "package", "repository_id")


def two_snapshots(t):
    snaps = t("snapshots")
    return snaps.filter(F.col("date") == DATE1), snaps.filter(F.col("date") == DATE2)


@query("j10_align_snapshots", f"""
    select coalesce(a.id, b.id) as id, cast(a.stars as varchar) as old_stars, cast(b.stars as varchar) as new_stars, a.id is not null as was, b.id is not null as now
    from (select * from snapshots where date = '{DATE1}') a full join (select * from snapshots where date = '{DATE2}') b on a.id = b.id""",
       ("snapshots",))
def align(t):
    old, new = two_snapshots(t)
    return diff.align(old, new).select(
        "id", text("old.stars", "old_stars"), text("new.stars", "new_stars"), F.col("old").isNotNull().alias("was"),
        F.col("new").isNotNull().alias("now"))


@query("j10_last_row_wins", """
    select id, arg_max(language, date) as language, max(date) as date from snapshots group by id""", ("snapshots",))
def last_row_wins(t):
    from shelfmark.operators.keyed import latest_per_key

    return latest_per_key(t("snapshots"), ["id"], "date").select("id", "language", "date")


def raw_records(t):
    df = t("raw").withColumn("sources", F.array(F.struct(
        F.col("source_repository").alias("repository"), F.col("source_section").alias("section"))))
    flat = df.drop("score_overall", "health_status", "source_repository", "source_section")
    return records.normalize(records.complete(flat))


@query("j11_fold_sources", """
    select rid as id, row_number() over (partition by rid order by source_repository, source_section) as position, source_repository as repository, source_section as section
    from (select distinct rid, source_repository, source_section from raw_ids)""", ("raw_ids",))
def fold_sources(t):
    return records.fold_sources(raw_records(t))


def fresh_rows(t):
    """Fresh facts for records that have line items: new stars and a push date."""
    rid = F.concat(F.lit("github:own"), F.col("l_orderkey") % 997, F.lit("/order-"), F.col("l_orderkey"))
    per = t("lineitem").groupBy(rid.alias("id")).agg(
        F.sum("l_partkey").cast("bigint").alias("stars"), F.max("l_shipdate").cast("timestamp").alias("pushed_at"))
    return records.complete(per.withColumns({"owner": F.lit("x"), "name": F.lit("y"), "url": F.lit("fresh")}))


FRESH_SQL = """
    fresh as (select 'github:own' || (l_orderkey % 997) || '/order-' || l_orderkey as id, cast(sum(l_partkey) as bigint) as stars, max(l_shipdate) as pushed_at from lineitem group by l_orderkey)"""
INTERVAL_SQL = ("case coalesce(health_status, 'UNKNOWN') when 'ACTIVE' then 1 when 'MAINTAINED' then 3 when 'SLOW' then 7 when 'STALE' then 30 "
                "when 'ARCHIVED' then 90 else 14 end")
DUE_SQL = f"(collected_at is null or floor(({AS_OF_S} - epoch(collected_at)) / 86400.0) >= {INTERVAL_SQL})"


@query("j12_refresh_merge", f"""
    with {FRESH_SQL} select r.id, r.owner, r.name, 'https://github.com/' || substr(r.id, 8) as url, f.stars, coalesce(r.score_overall, 0.0) as overall,
        case when floor(({AS_OF_S} - epoch(f.pushed_at)) / 86400.0) <= 7 then 'ACTIVE' when floor(({AS_OF_S} - epoch(f.pushed_at)) / 86400.0) <= 30 then 'MAINTAINED'
            when floor(({AS_OF_S} - epoch(f.pushed_at)) / 86400.0) <= 90 then 'SLOW' else 'STALE' end as status
    from repos r join fresh f on f.id = r.id""", ("repos",))
def refresh_merge(t):
    return refresh.merge(nested(t("repos")), fresh_rows(t), AS_OF).select(
        "id", "owner", "name", "url", "stars", "score.overall", "health.status")
