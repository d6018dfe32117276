"""Scans, sources, sinks and keyed writes."""

from pyspark.sql import functions as F

from shelfmark.operators import catalog, content, discover, findings, keyed, records
from shelfmark.schemas import FLAT_COLUMNS
from shelfmark.sources import feeds, tables
from shelfmark import taxonomy as taxonomies

from .common import csv, duck_list_hit, epoch, hits, nested, scratch, text
from .registry import query
from .views import AS_OF, DATE1

COLLECTED = "2001-08-01 00:00:00"


@query("s01_scan_json", """
    select id, owner, name, coalesce(stars, -1) as stars, array_to_string(topics, ',') as topics, archived,
        cast(epoch(pushed_at) as bigint)::varchar as pushed_at, coalesce(health_status, 'UNKNOWN') as status,
        coalesce(score_overall, 0.0) as overall from repos""", ("repos",))
def scan_json(t):
    df = nested(t("repos"))
    path = scratch(df.sparkSession, "s01")
    df.drop("seq").write.json(path)
    df.sparkSession.range(1).select(F.lit("{broken").alias("value")).write.mode("append").text(path)
    back = tables.read_records(df.sparkSession, path, multi_line=False)
    return back.select("id", "owner", "name", F.coalesce("stars", F.lit(-1)).alias("stars"), csv("topics"), "archived",
                       epoch("pushed_at"), "health.status", "score.overall")


@query("s02_write_records", """
    select rid as id, seq from (select *, row_number() over (partition by rid order by seq desc) as pos from raw_ids) where pos = 1""",
       ("raw_ids",))
def write_records(t):
    df = records.normalize(records.complete(t("raw").drop("score_overall", "health_status", "source_repository", "source_section")))
    spark, path = df.sparkSession, scratch(df.sparkSession, "s02")
    tables.write_records(df.withColumn("issues", F.col("seq")), path)
    return tables.read_records(spark, path, multi_line=False).select("id", F.col("issues").alias("seq"))


@query("s03_snapshot_read", f"""
    select id, coalesce(stars, -1) as stars, forks, issues, language, array_to_string(topics, ',') as topics from snapshots where date = '{DATE1}'""",
       ("snapshots",))
def snapshot_read(t):
    df = t("snapshots")
    path = scratch(df.sparkSession, "s03")
    tables.write_partitions(df, path, "date")
    return tables.read_snapshot(df.sparkSession, path, DATE1).select(
        "id", F.coalesce("stars", F.lit(-1)).alias("stars"), "forks", "issues", "language", csv("topics"))


@query("s03_snapshot_dates", "select distinct date from snapshots", ("snapshots",))
def snapshot_dates(t):
    df = t("snapshots")
    path = scratch(df.sparkSession, "s03d")
    tables.write_partitions(df.select("id", "date"), path, "date")
    return tables.snapshot_dates(df.sparkSession, path)


@query("s04_list_records", f"""
    select 'github:' || owner || '/' || name as id, name, owner, coalesce(html_url, 'https://github.com/' || owner || '/' || name) as url,
        description, stars, language, array_to_string(topics, ',') as topics, {duck_list_hit()} as is_awesome_list, source, query
    from hits_flat where owner <> '' and name <> ''""", ("hits_flat",))
def list_records(t):
    df = discover.list_records(hits(t("hits_flat")), COLLECTED)
    path = scratch(df.sparkSession, "s04")
    tables.write_lists(df, path)
    return df.sparkSession.read.parquet(path).select(
        "id", "name", "owner", "url", "description", "stars", "language", csv("topics"), "is_awesome_list", "source", "query")


@query("s05_content_lookup", """
    select path, octet_length(encode(text)) as bytes, md5(text) as hash from files_text
    where repository_id = 'github:docs/src3' and listing in ('docs', 'doc', 'documentation', 'wiki', '') and type = 'file'
      and name not in ('e.py') and text <> ''
    union all select name as path, octet_length(encode(text)), md5(text) from files_text where repository_id = 'github:docs/src3' and listing = 'readme'""",
       ("files_text",))
def content_lookup(t):
    files = t("files_text").withColumn("content_base64", F.base64(F.encode("text", "UTF-8")))
    docs = content.stored_candidates(files, max_bytes=10_000_000)
    path = scratch(files.sparkSession, "s05")
    tables.write_content(docs, path)
    return tables.read_content(files.sparkSession, path, "github:docs/src3").select(
        "path", "bytes", F.md5("content").alias("hash"))


def entries_sql(extra: str = "") -> str:
    return f"""
    entries as (select r.id, r.owner || '/' || r.name as name, r.url, r.description, coalesce(r.stars, 0) as stars, r.language,
        coalesce(r.score_overall, 0.0) as score, coalesce(r.health_status, 'UNKNOWN') as health,
        coalesce(b.category, 'Uncategorized') as category, coalesce(c.parent, 'Uncategorized') as parent
        from repos r left join bridge b on b.repository_id = r.id left join categories c on c.name = b.category){extra}"""


ENTRY_VIEWS = ("repos", "bridge", "categories")


def entries(t):
    from shelfmark.operators import reports

    return reports.tree_entries(catalog.placed(t("repos"), t("bridge"), t("categories")))


@query("s06_index_lists", f"""
    with {entries_sql()} select parent, category as leaf, row_number() over (partition by parent, category order by coalesce(score, 0) desc, coalesce(stars, 0) desc, id) as position, id
    from entries""", ENTRY_VIEWS)
def index_lists(t):
    return tables.index_lists(entries(t))


@query("s06_index_parents", f"""
    with {entries_sql()} select parent, row_number() over (partition by parent order by coalesce(score, 0) desc, coalesce(stars, 0) desc, id) as position, id
    from (select distinct parent, id, score, stars from entries)""", ENTRY_VIEWS)
def index_parents(t):
    return tables.index_parents(entries(t))


@query("s06_read_index", f"""
    with {entries_sql()} select row_number() over (order by coalesce(score, 0) desc, coalesce(stars, 0) desc, id) as position, id from entries
    where parent = 'Fasteners' and category = 'Bolts'""", ENTRY_VIEWS)
def read_index(t):
    rows = entries(t)
    spark, path = rows.sparkSession, scratch(rows.sparkSession, "s06")
    tables.write_index(rows, t("repos"), path)
    return tables.read_index(spark, path, "Fasteners", "Bolts")


@query("s06_index_members", f"""
    with {entries_sql()} select parent, category as leaf, id from entries""", ENTRY_VIEWS)
def index_members(t):
    rows = entries(t)
    path = scratch(rows.sparkSession, "s06")
    tables.write_index(rows, t("repos"), path)
    return rows.sparkSession.read.parquet(f"{path}/members").select("parent", "leaf", "id")


@query("s06_index_slim", """
    select id, owner || '/' || name as name, url, cast(stars as varchar) as stars, cast(score_overall as varchar) as score, health_status as health from repos""",
       ("repos",))
def index_slim(t):
    return tables.slim_records(t("repos")).withColumns({"stars": F.col("stars").cast("string"), "score": F.col("score").cast("string")})


@query("s07_from_payload", """
    select seq, 'github:' || lower(owner) || '/' || lower(coalesce(name, '')) as id, owner, coalesce(name, '') as name,
        coalesce(html_url, 'https://github.com/' || owner || '/' || coalesce(name, '')) as url, description, stars,
        coalesce(forks_count, forks) as forks, issues, language, array_to_string(topics, ',') as topics, license,
        coalesce(archived, false) as archived from hits_flat""", ("hits_flat",))
def from_payload(t):
    return records.from_payload(hits(t("hits_flat")), COLLECTED).select(
        "seq", "id", "owner", "name", "url", "description", "stars", "forks", "issues", "language", csv("topics"), "license", "archived")


@query("s08_slim_hits", """
    select 'github:' || lower(owner) || '/' || lower(name) as id, owner, name, coalesce(html_url, 'https://github.com/' || owner || '/' || name) as url,
        description, stars, coalesce(forks_count, forks) as forks, language, coalesce(archived, false) as archived, owner || '/' || name as name_with_owner
    from hits_flat where owner <> '' and name <> ''""", ("hits_flat",))
def slim_hits(t):
    return records.slim_hits(hits(t("hits_flat")))


@query("s09_from_flat", """
    select id, coalesce(score_overall, 0.0) as overall, coalesce(health_status, 'UNKNOWN') as status from repos""", ("repos",))
def from_flat(t):
    return nested(t("repos")).select("id", "score.overall", "health.status")


@query("s10_by_id", "select id, name, cast(stars as varchar) as stars from repos where id = 'github:own5/order-5'", ("repos",))
def by_id(t):
    return catalog.by_id(t("repos"), "github:own5/order-5").select("id", "name", text("stars"))


@query("s11_scan_limit", "select id, url from repos order by id limit 50", ("repos",))
def scan_limit(t):
    return catalog.scan(t("repos"), 50).select("id", "url")


@query("s12_upsert_repositories", """
    with incoming as (select 'github:own' || (l_orderkey % 997) || '/order-' || l_orderkey as id, l_partkey as stars,
        row_number() over (partition by l_orderkey order by l_linenumber desc, l_partkey desc) as n from lineitem)
    select r.id, cast(case when i.id is null then r.stars else i.stars end as varchar) as stars,
        case when i.id is null then r.health_status else 'UNKNOWN' end as health_status,
        case when i.id is null then cast(r.score_overall as varchar) else '0.0' end as score_overall,
        case when i.id is null then r.name else 'new' end as name
    from repos r left join incoming i on i.id = r.id and i.n = 1""", ("repos",))
def upsert_repositories(t):
    rows = t("lineitem").select(
        F.concat(F.lit("github:own"), F.col("l_orderkey") % 997, F.lit("/order-"), F.col("l_orderkey")).alias("id"),
        F.lit("own").alias("owner"), F.lit("new").alias("name"), F.lit("u").alias("url"), F.col("l_partkey").alias("stars"),
        F.lit(None).cast("string").alias("health_status"), F.lit(None).cast("double").alias("score_overall"),
        (F.col("l_linenumber") * 10_000_000 + F.col("l_partkey")).alias("seq"))
    merged = keyed.upsert_repositories(t("repos").select(*FLAT_COLUMNS), rows)
    return merged.select("id", text("stars"), "health_status", text("score_overall"), "name")


@query("s13_category_rows", """
    select name, parent from categories""", ("categories",))
def category_rows(t):
    return keyed.category_rows(t("assigned"))


@query("s13_category_bridge", "select distinct repository_id, category from assigned", ("assigned",))
def category_bridge(t):
    return keyed.category_bridge(t("assigned"))


@query("s14_insert_sources", """
    select distinct repository_id, source_repository, source_section from provenance
    union select id, 'github:lists/s1', 'A' from repos""", ("repos", "provenance"))
def insert_sources(t):
    existing = t("repos").select(
        F.col("id").alias("repository_id"), F.lit("github:lists/s1").alias("source_repository"), F.lit("A").alias("source_section"))
    incoming = t("provenance").select(F.col("repository_id").alias("id"), F.array(F.struct(
        F.col("source_repository").alias("repository"), F.col("source_section").alias("section"))).alias("sources"))
    return keyed.insert_sources(existing, incoming)


@query("s15_upsert_daily_metrics", """
    with incoming as (select 'github:users/u' || user_id as repository_id, cast(cast(ts as date) as varchar) as date, max(event_id) as stars
        from events group by 1, 2)
    select coalesce(i.repository_id, s.id) as repository_id, coalesce(i.date, s.date) as date,
        cast(case when i.date is null then s.stars else i.stars end as varchar) as stars,
        case when i.date is null then s.forks else 1 end as forks, case when i.date is null then s.issues else 0 end as issues
    from snapshots s full join incoming i on i.repository_id = s.id and i.date = s.date""", ("snapshots",))
def upsert_daily_metrics(t):
    existing = t("snapshots").select(F.col("id").alias("repository_id"), "date", "stars", "forks", "issues")
    incoming = t("events").select(
        F.concat(F.lit("github:users/u"), "user_id").alias("repository_id"), F.to_date("ts").cast("string").alias("date"),
        F.col("event_id").alias("stars"), F.lit(1).cast("bigint").alias("forks"), F.lit(0).cast("bigint").alias("issues"),
        F.col("event_id").alias("seq"))
    spark, path = existing.sparkSession, scratch(existing.sparkSession, "s15")
    tables.write_partitions(existing, path, "date")
    stored = spark.read.parquet(path).withColumn("date", F.col("date").cast("string"))
    tables.write_daily_metrics(spark, path, incoming, stored)
    back = spark.read.parquet(path)
    return back.select("repository_id", text("date"), text("stars"), "forks", "issues")


_FINDINGS_MERGED = """
    with both_sides as (
        select 'GHSA-' || s_suppkey as advisory_id, 'PyPI' as package, 'old' as severity, 'old summary' as summary, 'old url' as url, -1 as seq from supplier
        union all select osv_id, coalesce(ecosystem, ''), coalesce(score2, ''), coalesce(summary, ''), alias1, seq from advisories)
    select 'osv' as source, advisory_id, package, '' as repository_id, arg_max(severity, seq) as severity, arg_max(summary, seq) as summary, arg_min(url, seq) as url
    from both_sides group by advisory_id, package"""


@query("s16_upsert_findings", _FINDINGS_MERGED, ("advisories",))
def upsert_findings(t):
    return keyed.upsert_findings(*old_and_new_findings(t)).select("source", "advisory_id", "package", "repository_id", "severity", "summary", "url")


@query("s16_bucketed_upsert", _FINDINGS_MERGED, ("advisories",))
def bucketed_upsert(t):
    """Old findings stored in buckets, then the new ones in two runs, the first of them once more."""
    old, new = old_and_new_findings(t)
    spark, path = old.sparkSession, scratch(old.sparkSession, "s16")
    tables.upsert_finding_buckets(spark, path, old.withColumn("seq", F.lit(None).cast("bigint")))
    median = new.agg(F.percentile_approx("seq", 0.5)).first()[0]
    early = new.filter(F.col("seq") <= median)
    for part in (early, early, new.filter(F.col("seq") > median)):
        tables.upsert_finding_buckets(spark, path, part)
    return spark.read.parquet(path).select("source", "advisory_id", "package", "repository_id", "severity", "summary", "url")


def old_and_new_findings(t):
    none = F.array().cast("array<string>")
    old = t("supplier").select(
        F.lit("osv").alias("source"), F.concat(F.lit("GHSA-"), "s_suppkey").alias("advisory_id"), F.lit("PyPI").alias("package"),
        F.lit(None).cast("string").alias("repository_id"), F.lit("").alias("ecosystem"), F.lit("old").alias("severity"),
        F.lit("old summary").alias("summary"), F.lit("old url").alias("url"), none.alias("cve_ids"),
        F.lit(AS_OF).cast("timestamp").alias("observed_at"))
    new = t("advisories").select(
        F.lit("osv").alias("source"), F.col("osv_id").alias("advisory_id"), F.coalesce("ecosystem", F.lit("")).alias("package"),
        F.lit(None).cast("string").alias("repository_id"), F.lit("").alias("ecosystem"), F.coalesce("score2", F.lit("")).alias("severity"),
        F.coalesce("summary", F.lit("")).alias("summary"), F.col("alias1").alias("url"), none.alias("cve_ids"),
        F.lit(AS_OF).cast("timestamp").alias("observed_at"), "seq")
    return old, new


def _stored(t):
    good = F.concat(F.lit('["'), "alias1", F.lit('","'), "alias2", F.lit('"]'))
    return t("advisories").select(
        F.lit("osv").alias("source"), F.col("osv_id").alias("advisory_id"), F.col("ecosystem").alias("repository_id"), "seq",
        F.when(F.col("db_severity").isNull(), F.lit("not json")).otherwise(good).alias("cve_ids"))


@query("s17_findings", """
    select 'osv' as source, osv_id as advisory_id, seq, case when db_severity is null then '' else alias1 || ',' || alias2 end as cve_ids from advisories""",
       ("advisories",))
def stored_findings(t):
    return findings.stored(_stored(t)).select("source", "advisory_id", "seq", csv("cve_ids"))


@query("s17_findings_of_repository", """
    select osv_id as advisory_id, seq from advisories where ecosystem = 'PyPI'""", ("advisories",))
def findings_of_repository(t):
    return findings.stored(_stored(t), "PyPI").select("advisory_id", "seq")


@query("s18_export", """
    select id, description, cast(stars as varchar) as stars, archived, health_status, null as cve_ids from repos
    union all select ecosystem, osv_id, cast(seq as varchar), null, 'osv', case when db_severity is null then 'not json' else '["' || alias1 || '","' || alias2 || '"]' end from advisories""",
       ("repos", "advisories"))
def export(t):
    df = t("repos")
    path = scratch(df.sparkSession, "s18")
    tables.export(df, path, _stored(t))
    back = lambda like, name: df.sparkSession.read.schema(like.schema).json(f"{path}/{name}")
    rows = back(df, "repositories").select(
        "id", "description", text("stars"), "archived", "health_status", F.lit(None).cast("string").alias("cve_ids"))
    found = back(_stored(t), "security_findings").select(
        F.col("repository_id").alias("id"), F.col("advisory_id").alias("description"), F.col("seq").cast("string").alias("stars"),
        F.lit(None).cast("boolean").alias("archived"), F.col("source").alias("health_status"), "cve_ids")
    return rows.unionByName(found)


@query("s19_fallback_scan", "select id, archived from repos", ("repos",))
def fallback(t):
    df = t("repos")
    return catalog.first_non_empty(df.filter("id = 'nobody'"), df).select("id", "archived")


@query("s20_taxonomy_violations", """
    with tree as (select case when p_size < 3 then p_name else p_brand end as parent, case when p_size = 50 then ' ' else p_name end as leaf, p_partkey as ord from part),
    words as (select p_name as leaf from part union all select p_type from part),
    filled as (select * from tree where trim(leaf) <> '')
    select 'parent without leaves' as problem, parent as name from tree group by parent having count(*) filter (where trim(leaf) <> '') = 0
    union all select 'leaf listed twice', leaf from filled group by leaf having count(*) > 1
    union all select 'parent is also a leaf', p.parent from (select parent, min(ord) as starts from tree group by parent) p
        join (select leaf, min(ord) as seen from filled group by leaf) l on l.leaf = p.parent and l.seen < p.starts
    union all select distinct 'words for an unknown leaf', w.leaf from words w where w.leaf not in (select leaf from filled)""")
def taxonomy_violations(t):
    part = t("part")
    tree = part.select(
        F.when(F.col("p_size") < 3, F.col("p_name")).otherwise(F.col("p_brand")).alias("parent"),
        F.when(F.col("p_size") == 50, F.lit(" ")).otherwise(F.col("p_name")).alias("leaf"), F.col("p_partkey").alias("ord"))
    words = part.select(F.col("p_name").alias("leaf")).unionByName(part.select(F.col("p_type").alias("leaf")))
    return taxonomies.violations(tree, words)


@query("s21_kev_feed", """
    select coalesce(cve_id, '') as cve_id, trim(regexp_replace(lower(trim(product)), '[-_.]+', '-', 'g')) as product_key,
        regexp_replace(lower(trim(vendor)), '[-_.]+', '-', 'g') as vendor_key, date_added from advisories""", ("advisories",))
def kev_feed(t):
    df = kev_documents(t)
    path = scratch(df.sparkSession, "s21")
    df.drop("seq").write.json(path)
    feed = feeds.read_kev(df.sparkSession, path, multi_line=False)
    return findings.kev_entries(feed).select(
        F.col("cveID").alias("cve_id"), "product_key", "vendor_key", F.col("dateAdded").alias("date_added"))


def kev_documents(t):
    """One feed document per advisory, with ``seq``."""
    return t("advisories").select("seq", F.array(F.struct(
        F.col("cve_id").alias("cveID"), F.col("vendor").alias("vendorProject"), "product",
        F.col("summary").alias("vulnerabilityName"), F.col("date_added").alias("dateAdded"))).alias("vulnerabilities"))
