"""Security findings and content extraction."""

from pyspark.sql import functions as F

from shelfmark.functions.files import decode_base64, file_kind
from shelfmark.functions.urls import package_candidates
from shelfmark.operators import content, findings
from shelfmark.plans import maintain
from shelfmark.schemas import CVE_ENTRY, OSV_RESPONSE
from shelfmark.sources import feeds

from .common import csv, hits, scratch
from .q_joins import KEV_SQL, OWNERS_SQL, duck_package, osv_responses, part_records
from .q_sources import kev_documents
from .registry import query
from .views import AS_OF

FINDINGS_SQL = f"""{KEV_SQL.strip()},
    feed as (
        select 'osv' as source, a.osv_id as advisory_id, a.package, coalesce(a.ecosystem, '') as ecosystem,
            case when a.score1 <> '' then a.score1 when a.score2 <> '' then a.score2 else coalesce(a.db_severity, '') end as severity, coalesce(a.summary, '') as summary,
            'https://osv.dev/vulnerability/' || a.osv_id as url, a.alias1 as cve_ids, o.repository_id, a.seq from advisories a join owners o on o.package = {duck_package('a.package')}
        union all select 'cisa-kev', case when cve_id <> '' then cve_id else date_added end, case when pk <> '' then pk else vk end, '', 'KNOWN_EXPLOITED', coalesce(summary, ''),
            'https://www.cisa.gov/known-exploited-vulnerabilities-catalog', cve_id, case when pk <> '' then by_product else by_vendor end, seq from kev
        union all select 'cve', a.cve_id, a.package, '', coalesce(a.score2, ''), coalesce(a.summary, ''), 'https://www.cve.org/CVERecord?id=' || a.cve_id, a.cve_id, o.repository_id, a.seq
            from advisories a join owners o on o.package = {duck_package('a.package')} where a.cve_id like 'CVE-%'),
    found as (select * exclude (pos) from (select *, row_number() over (partition by source, advisory_id, package, repository_id order by seq) as pos from feed) where pos = 1)"""


def cve_entries(t):
    return t("advisories").select(
        "seq", "package", F.col("cve_id").alias("id"), "summary", F.array(F.struct(F.col("score2").alias("score"))).alias("cvss"))


def part_findings(t):
    return findings.enrich(part_records(t), osv_responses(t), kev_documents(t), cve_entries(t), AS_OF)


@query("f01_package_candidates", f"""
    select id, array_to_string(list_filter([{duck_package('name')}, {duck_package('package_names[1]')}, {duck_package('package_names[2]')}], lambda x: x <> ''), ',') as candidates
    from partrepos""", ("partrepos",))
def candidates(t):
    return t("partrepos").select("id", csv(package_candidates("name", "package_names"), "candidates"))


@query("f02_package_owners", f"with {OWNERS_SQL} select package, repository_id from owners", ("partrepos",))
def owners(t):
    return findings.package_owners(part_records(t))


@query("f03_osv_rows", """
    select seq, osv_id as advisory_id, coalesce(ecosystem, '') as ecosystem,
        case when score1 <> '' then score1 when score2 <> '' then score2 else coalesce(db_severity, '') end as severity, coalesce(summary, '') as summary,
        'https://osv.dev/vulnerability/' || osv_id as url, alias1 as cve_ids from advisories""", ("advisories",))
def osv_rows(t):
    return findings.osv_rows(osv_responses(t), AS_OF).select(
        "seq", "advisory_id", "ecosystem", "severity", "summary", "url", csv("cve_ids"))


@query("f04_kev_rows", f"""
    with {OWNERS_SQL}, {KEV_SQL} select seq, case when cve_id <> '' then cve_id else date_added end as advisory_id, coalesce(summary, '') as summary, 'KNOWN_EXPLOITED' as severity,
        cve_id as cve_ids from kev""", ("partrepos", "advisories"))
def kev_rows(t):
    matches = findings.kev_matches(findings.kev_entries(kev_documents(t)), findings.package_owners(part_records(t)))
    return findings.kev_rows(matches, AS_OF).select("seq", "advisory_id", "summary", "severity", csv("cve_ids"))


@query("f05_cve_rows", """
    select seq, cve_id as advisory_id, coalesce(score2, '') as severity, 'https://www.cve.org/CVERecord?id=' || cve_id as url from advisories where cve_id like 'CVE-%'""",
       ("advisories",))
def cve_rows(t):
    return findings.cve_rows(cve_entries(t), AS_OF).select("seq", "advisory_id", "severity", "url")


@query("f06_enrich", f"""
    with {OWNERS_SQL}, {FINDINGS_SQL} select source, advisory_id, package, ecosystem, severity, summary, url, cve_ids, repository_id, seq from found""", ("partrepos", "advisories"))
def enrich(t):
    return part_findings(t).select(
        "source", "advisory_id", "package", "ecosystem", "severity", "summary", "url", csv("cve_ids"), "repository_id", "seq")


# --- feeds in files, some documents broken

_BROKEN_SQL = "seq % 10 = 3"
_BROKEN = r"""'{"seq": ' || seq || ', "package": ['"""  # cut off in the middle


FEED_LINES = 500_000  # of a compressed file, which one task reads


def feed_file(rows, name):
    """Rows as compressed JSON lines; before them a blank line and, for each row in ten, a document that was cut off."""
    spark, path = rows.sparkSession, scratch(rows.sparkSession, name)
    rows.write.option("compression", "lz4").option("maxRecordsPerFile", FEED_LINES).json(path)
    cut = rows.filter(_BROKEN_SQL).select(F.explode(F.array(F.expr(_BROKEN), F.lit(" "))).alias("value"))
    cut.write.mode("append").text(path)
    return spark, path


@query("s21_osv_feed", """
    select seq, package, ecosystem, osv_id as advisory_id, alias1 as cve_ids from advisories""", ("advisories",))
def osv_feed(t):
    rows, _ = feeds.split(*feed_file(osv_responses(t), "s21o"), OSV_RESPONSE, "osv")
    return rows.select("seq", "package", "ecosystem", F.explode("vulns").alias("v")).select(
        "seq", "package", "ecosystem", F.col("v.id").alias("advisory_id"),
        csv(F.filter("v.aliases", lambda a: F.upper(a).startswith("CVE-")), "cve_ids"))


@query("s21_cve_feed", "select seq, package, cve_id as id, summary, score2 as score from advisories", ("advisories",))
def cve_feed(t):
    rows, _ = feeds.split(*feed_file(cve_entries(t), "s21c"), CVE_ENTRY, "cve")
    return rows.select("seq", "package", "id", "summary", F.get("cvss", F.lit(0))["score"].alias("score"))


@query("s21_hits", "select seq, source, query, owner, name, stars, array_to_string(topics, ',') as topics from hits_flat", ("hits_flat",))
def hit_files(t):
    rows = feeds.read_hits(*feed_file(hits(t("hits_flat")), "s21h"))
    return rows.select("seq", "source", "query", F.col("repository.owner.login").alias("owner"), "repository.name",
                       F.col("repository.stargazers_count").alias("stars"), csv("repository.topics", "topics"))


@query("s21_files", "select repository_id, listing, file_order, name, md5(text) as hash from files_text", ("files_text",))
def content_files(t):
    rows = repo_files(t).drop("text")
    spark, path = rows.sparkSession, scratch(rows.sparkSession, "s21f")
    rows.write.json(path)
    return feeds.read_files(spark, path).select("repository_id", "listing", "file_order", "name", F.md5(decode_base64("content_base64")).alias("hash"))


def broken_feeds(t):
    """osv and cve with broken documents, kev not there."""
    spark, osv = feed_file(osv_responses(t), "a12o")
    _, cve = feed_file(cve_entries(t), "a12c")
    return maintain.enrich_feeds(part_records(t), {"osv": osv, "kev": f"{osv}-absent", "cve": cve}, AS_OF, staging=scratch(spark, "a12s"))


@query("a12_error_messages", f"""
    select p || ': unreadable document: ' || {_BROKEN} as message, p as provider from advisories, (values ('osv'), ('cve')) x(p) where {_BROKEN_SQL}
    union all select 'kev: cannot open feed: PATH_NOT_FOUND', 'kev'""", ("advisories",))
def error_messages(t):
    return broken_feeds(t)["errors"]


@query("a12_report_with_errors", f"""
    with {OWNERS_SQL}, {FINDINGS_SQL} select (select count(*) from found where source <> 'cisa-kev') as finding_count, (select count(*) from partrepos) as repositories_scanned,
        (select count(*) from owners) as packages_queried, (select 2 * count(*) + 1 from advisories where {_BROKEN_SQL}) as error_count""", ("partrepos", "advisories"))
def report_with_errors(t):
    return broken_feeds(t)["report"]


# --- content

LIMITS = {"max_bytes": 3000, "budget": 20_000, "per_listing": 4}
FILE_VIEWS = ("files_text", "doc_repos")
_STORED = """((listing = 'readme') or (listing in ('docs', 'doc', 'documentation', 'wiki', '') and type = 'file'
    and (lower(name) in ('openapi.yaml', 'swagger.json') or regexp_matches(lower(name), '\\.(md|mdx|rst|txt)$'))))"""
_KIND = """case when listing = 'readme' then 'readme' when lower(name) in ('openapi.yaml', 'swagger.json') then 'api' else 'docs' end"""
_LISTING = "case listing when 'readme' then 0 when 'docs' then 1 when 'doc' then 2 when 'documentation' then 3 when 'wiki' then 4 else 5 end"


def capped_sql(n: int) -> str:
    """Byte cap of a text: a character cut in two becomes one replacement character of three bytes."""
    byte = lambda i: f"substr(h, {2 * i - 1}, 2) between '80' and 'BF'"
    split = f"case when not ({byte(n + 1)}) then 0 when not ({byte(n)}) then 1 when not ({byte(n - 1)}) then 2 else 3 end"
    return f"""
    hexed as (select *, octet_length(encode(text)) as full_bytes, hex(encode(text)) as h from files_text where {_STORED} and text <> ''),
    measured as (select *, case when full_bytes > {n} then {split} else 0 end as p from hexed),
    capped as (select repository_id, {_LISTING} as listing_no, {_KIND} as kind, file_order, case when listing = 'readme' then coalesce(name, 'README') else coalesce(path, name) end as path,
        coalesce(html_url, case when listing = 'readme' then 'https://github.com/' || substr(repository_id, 8) else '' end) as url, full_bytes > {n} as truncated,
        cast(case when full_bytes > {n} then {n} - p + case when p > 0 then 3 else 0 end else full_bytes end as bigint) as bytes,
        case when full_bytes > {n} then decode(unhex(substr(h, 1, 2 * ({n} - p)))) || case when p > 0 then '�' else '' end else text end as content from measured)"""


def walk_sql(budget: int, per_listing: int, source: str = "capped") -> str:
    return f"""
    numbered as (select *, row_number() over (partition by repository_id order by listing_no, file_order) as rn from {source}),
    walk as (
        select repository_id, rn, listing_no, case when bytes <= {budget} then bytes else 0 end as used, case when bytes <= {budget} then 1 else 0 end as files, bytes <= {budget} as ok
        from numbered where rn = 1
        union all
        select n.repository_id, n.rn, n.listing_no,
            w.used + case when (case when n.listing_no = w.listing_no then w.files else 0 end) < {per_listing} and w.used + n.bytes <= {budget} then n.bytes else 0 end,
            (case when n.listing_no = w.listing_no then w.files else 0 end) + case when (case when n.listing_no = w.listing_no then w.files else 0 end) < {per_listing} and w.used + n.bytes <= {budget} then 1 else 0 end,
            (case when n.listing_no = w.listing_no then w.files else 0 end) < {per_listing} and w.used + n.bytes <= {budget}
        from numbered n join walk w on n.repository_id = w.repository_id and n.rn = w.rn + 1),
    kept as (select n.* from numbered n join walk w on n.repository_id = w.repository_id and n.rn = w.rn where w.ok)"""


FILES_KEPT_SQL = f"with {capped_sql(LIMITS['max_bytes']).strip()}, {walk_sql(LIMITS['budget'], LIMITS['per_listing']).strip()}"
RECURSIVE_KEPT = FILES_KEPT_SQL.replace("with ", "with recursive ", 1)


def repo_files(t):
    return t("files_text").withColumn("content_base64", F.base64(F.encode("text", "UTF-8")))


@query("x01_decode", "select file_order, listing, md5(text) as hash, octet_length(encode(text)) as bytes from files_text", ("files_text",))
def decode(t):
    text = decode_base64("content_base64")
    return repo_files(t).select("file_order", "listing", F.md5(text).alias("hash"), F.octet_length(text).cast("bigint").alias("bytes"))


@query("x02_file_kinds", f"select file_order, listing, {_KIND} as kind from files_text where {_STORED}", ("files_text",))
def file_kinds(t):
    return repo_files(t).withColumn("kind", file_kind("listing", "type", "name")).filter("kind is not null").select(
        "file_order", "listing", "kind")


@query("x02_only_api_specs", """
    select file_order, 'api' as kind from files_text where listing in ('docs', 'doc', 'documentation', 'wiki', '') and type = 'file' and lower(name) in ('openapi.yaml', 'swagger.json')""",
       ("files_text",))
def only_api_specs(t):
    kind = file_kind("listing", "type", "name", readme=False, docs=False)
    return repo_files(t).withColumn("kind", kind).filter("kind is not null").select("file_order", "kind")


@query("x03_byte_cap", f"with {capped_sql(777).strip()} select repository_id, path, listing_no, kind, bytes, truncated, md5(content) as hash from capped", ("files_text",))
def byte_cap(t):
    return content.stored_candidates(repo_files(t), 777).select(
        "repository_id", "path", "listing_no", "kind", "bytes", "truncated", F.md5("content").alias("hash"))


def _sizes(t, max_bytes):
    return content.stored_candidates(repo_files(t), max_bytes).select("repository_id", "listing_no", "file_order", "bytes")


@query("x04_listing_cap", f"with recursive {capped_sql(3000).strip()}, {walk_sql(10**12, 3).strip()} select repository_id, listing_no, file_order from kept", ("files_text",))
def listing_cap(t):
    return content.within_budget(_sizes(t, 3000), budget=10**12, per_listing=3)


@query("x05_byte_budget", RECURSIVE_KEPT + " select repository_id, listing_no, file_order from kept", ("files_text",))
def byte_budget(t):
    return content.within_budget(_sizes(t, LIMITS["max_bytes"]), LIMITS["budget"], LIMITS["per_listing"])


@query("x05_byte_budget_wide", f"with recursive {capped_sql(200000).strip()}, {walk_sql(50000, 100000).strip()} select repository_id, listing_no, file_order from kept", ("files_text",))
def byte_budget_wide(t):
    return content.within_budget(_sizes(t, 200_000), 50_000, 100_000)


@query("x06_extract", RECURSIVE_KEPT + """, picked as (select id from doc_repos where score_overall >= 20 order by score_overall desc, id limit 12)
    select repository_id, kind, path, url, bytes, truncated, md5(content) as hash from kept where repository_id in (select id from picked)""", FILE_VIEWS)
def extract(t):
    made = maintain.extract(t("doc_repos"), repo_files(t), min_score=20, max_repositories=12, **LIMITS)
    return made["documents"].select("repository_id", "kind", "path", "url", "bytes", "truncated", F.md5("content").alias("hash"))


@query("x06_statuses", RECURSIVE_KEPT + """
    select d.id, case when d.id not like 'github:%' then 'failed' when count(k.path) = 0 then 'skipped' else 'succeeded' end as status, count(k.path) as documents
    from doc_repos d left join kept k on k.repository_id = d.id group by d.id""", FILE_VIEWS)
def statuses(t):
    docs = content.documents(t("doc_repos"), repo_files(t), **LIMITS)
    return content.statuses(t("doc_repos"), docs).select("id", "status", "documents")
