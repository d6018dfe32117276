"""Discovery searches, predicates and filters."""

from pyspark.sql import functions as F

from shelfmark.functions import urls as U
from shelfmark.functions.compare import comparable
from shelfmark.operators import catalog, discover, records

from .common import csv, duck_list_hit, duck_list_url, epoch, hits, nested, text
from .registry import query
from .taxonomy import PARTS
from .views import AS_OF, AS_OF_S, DIFF_AS_OF, DIFF_AS_OF_S


@query("p01_curated_hits", f"select seq, source, query, owner, name from hits_flat where {duck_list_hit()}", ("hits_flat",))
def curated_hits(t):
    return discover.curated_lists(hits(t("hits_flat"))).select(
        "seq", "source", "query", F.col("repository.owner.login").alias("owner"), F.col("repository.name").alias("name"))


_P02_URL = "case when forks % 5 = 0 then 'https://github.com/o/the-list-awesome' else html_url end"


@query("p02_curated_records", f"""
    select seq, name, {duck_list_hit()} or {duck_list_url(_P02_URL)} as is_list from hits_flat""", ("hits_flat",))
def curated_records(t):
    url = F.when(F.col("forks") % 5 == 0, "https://github.com/o/the-list-awesome").otherwise(F.col("html_url"))
    return t("hits_flat").select("seq", "name", U.is_list_record("name", "description", "topics", url).alias("is_list"))


@query("p03_curated_urls", f"select n, url, {duck_list_url('url')} as is_list from url_rows", ("url_rows",))
def curated_urls(t):
    return t("url_rows").select("n", "url", U.is_list_url("url").alias("is_list"))


@query("p04_search_text", """
    select 'search_name' as source, '"order-1" in:name' as query, id from repos where lower(name) like '%order-1%'
    union all select 'search_description', '"Gizmo" in:description', id from repos where lower(description) like '%gizmo%'
    union all select 'search_readme', '"awesome list" in:readme', id from repos where lower('readme of ' || coalesce(description, '')) like '%awesome list%'""",
       ("repos",))
def search_text(t):
    df = t("repos").withColumn("readme", F.concat(F.lit("readme of "), F.coalesce("description", F.lit(""))))
    found = discover.union_hits(
        discover.search_text(df, "name", "order-1"), discover.search_text(df, "description", "Gizmo"),
        discover.search_text(df, "readme", "awesome list"))
    return found.select("source", "query", "id")


@query("p05_search_names", """
    select 'search_pattern' as source, p.query, id from partrepos join (values ('red*', 'red%'), ('*ring', '%ring'), ('hot-*-1*', 'hot-%-1%'), ('cold.rod', 'cold.rod')) p(query, pat)
    on lower(name) like p.pat""", ("partrepos",))
def search_names(t):
    return discover.search_names(t("partrepos"), ["red*", "*ring", "hot-*-1*", "cold.rod"]).select("source", "query", "id")


@query("p06_search_topics", """
    select 'topic' as source, u.topic as query, id from (select id, unnest(topics) as topic from repos) u where u.topic in ('ring', 'gear', 'awesome-list')""",
       ("repos",))
def search_topics(t):
    return discover.search_topics(t("repos"), ["gear", "ring", "awesome-list", "none"]).select("source", "query", "id")


@query("p07_matching_topics", "select distinct topic from (select unnest(topics) as topic from hits_flat) where topic like '%awesome%'",
       ("hits_flat",))
def matching_topics(t):
    return discover.matching_topics(t("hits_flat"))


@query("p08_cap_hits", """
    select source, query, id, stars from (select source, query, owner || '/' || coalesce(name, '') || '/' || seq as id, stars,
        row_number() over (partition by source, query order by stars desc, owner || '/' || coalesce(name, '') || '/' || seq) as n from
        (select distinct * from hits_flat)) where n <= 100""", ("hits_flat",))
def cap_hits(t):
    df = t("hits_flat").distinct().withColumn("id", F.concat_ws("/", "owner", F.coalesce("name", F.lit("")), F.col("seq").cast("string")))
    return discover.cap_hits(df).select("source", "query", "id", "stars")


@query("p09_category_filter", """
    select 'Fasteners' as wanted, repository_id, category from bridge where category in ('Rings', 'Bolts', 'Rods')
    union all select ' Rings ', repository_id, category from bridge where category = 'Rings'
    union all select 'cold work', repository_id, category from bridge where category = 'Cold Work'
    union all select 'ALL', repository_id, category from bridge""", ("bridge",))
def category_filter(t):
    rows = t("bridge").withColumn("categories", F.array("category"))
    parts = [
        catalog.in_categories(rows, PARTS, w).select(F.lit(w).alias("wanted"), "repository_id", "category")
        for w in ("Fasteners", " Rings ", "cold work", "ALL", "fasteners")
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("p10_category_overlap", """
    select distinct repository_id from bridge where category in ('Gears', 'Plates', 'Gizmos')""", ("bridge",))
def category_overlap(t):
    per = t("bridge").groupBy("repository_id").agg(F.collect_set("category").alias("categories"))
    return catalog.in_categories(per, PARTS, "Machines").select("repository_id")


@query("p11_by_health", "select id from repos where health_status = 'STALE'", ("repos",))
def by_health(t):
    return catalog.by_health(t("repos"), "STALE").select("id")


@query("p12_stale", f"""
    select id from repos where not archived and health_status <> 'ARCHIVED'
      and (pushed_at is null or ({AS_OF_S} - epoch(pushed_at)) / 86400.0 > 60)""", ("repos",))
def stale(t):
    return catalog.stale(t("repos"), AS_OF, 60).select("id")


@query("p13_min_stars", "select id from repos where coalesce(stars, 0) >= 250000", ("repos",))
def min_stars(t):
    return catalog.min_stars(t("repos"), 250_000).select("id")


_BROKEN = """broken as (select id, case when forks % 9 = 0 then '' else owner end as owner, name, case when issues % 50 = 0 then null else url end as url, collected_at from repos)"""


def _broken(t):
    return t("repos").withColumns({
        "owner": F.when(F.col("forks") % 9 == 0, "").otherwise(F.col("owner")),
        "url": F.when(F.col("issues") % 50 != 0, F.col("url"))})


_MISSING = ("concat_ws(', ', case when owner = '' then 'owner' end, case when url is null then 'url' end, "
            "case when collected_at is null then 'collected_at' end)")


@query("p14_validate", f"""
    with {_BROKEN} select count(*) as total, count(*) filter (where {_MISSING} = '') as valid, count(*) filter (where {_MISSING} <> '') as errors from broken""",
       ("repos",))
def validate(t):
    return records.validate(_broken(t))


@query("p14_validation_errors", f"""
    with {_BROKEN} select id, id || ': missing ' || {_MISSING} as message from broken where {_MISSING} <> '' order by id limit 20""", ("repos",))
def validation_errors(t):
    return records.validation_errors(_broken(t))


@query("p15_filter_rules", """
    select id from repos where coalesce(stars, 0) >= 10 and coalesce(license, 'x') not in ('GPL-2.0-only', 'GPL-3.0-only', 'AGPL-3.0-only')
      and coalesce(language, 'x') <> '' and not regexp_matches(lower(coalesce(description, '')), 'click here|buy now|spam|phishing|crypto airdrop|free ethereum')""",
       ("repos",))
def filter_rules(t):
    return catalog.filter_catalog(t("repos")).select("id")


@query("p15_filter_include_only", """
    select id from repos where coalesce(stars, 0) >= 10 and coalesce(forks, 0) >= 100 and not archived and language in ('Python', 'rust') and license in ('mit', 'apache-2.0')
      and coalesce(score_overall, 0) >= 30""", ("repos",))
def filter_include_only(t):
    rules = catalog.Rules(
        exclude_archived=True, min_forks=100, languages=(), licenses=(), phrases=(), only_languages=("Python", "rust"),
        only_licenses=("mit", "apache-2.0"), min_score=30)
    return catalog.filter_catalog(t("repos"), rules).select("id")


_AGE = f"floor(({DIFF_AS_OF_S} - epoch(pushed_at)) / 86400.0)"
_STATUS = "case when coalesce(health_status, '') = '' then 'UNKNOWN' else health_status end"


@query("p16_snapshot_flags", f"""
    select id, date, {_STATUS} as status, {_STATUS} = 'STALE' or coalesce({_AGE} > 180, false) as is_stale,
        archived or {_STATUS} = 'ARCHIVED' as is_archived from snapshots""", ("snapshots",))
def snapshot_flags(t):
    return catalog.with_snapshot_flags(t("snapshots"), DIFF_AS_OF).select("id", "date", "status", "is_stale", "is_archived")


@query("p17_comparable", """
    select id, cast(stars as varchar) as stars, cast(forks as varchar) as forks, cast(issues as varchar) as issues, language, description, license,
        array_to_string(topics, ',') as topics, archived, cast(cast(epoch(pushed_at) as bigint) as varchar) as pushed_at, cast(cast(epoch(updated_at) as bigint) as varchar) as updated_at,
        case when health_status = '' then null else health_status end as health_status, cast(score_overall as varchar) as score_overall from snapshots""",
       ("snapshots",))
def comparable_rows(t):
    df = t("snapshots")
    return df.select(*comparable(df.columns)).select(
        "id", text("stars"), text("forks"), text("issues"), "language", "description", "license", csv("topics"), "archived",
        epoch("pushed_at"), epoch("updated_at"), "health_status", text("score_overall"))


@query("p17_comparable_nested", """
    select id, coalesce(health_status, 'UNKNOWN') as health_status, coalesce(score_overall, 0.0) as score_overall from repos""", ("repos",))
def comparable_nested(t):
    df = nested(t("repos"))
    return df.select(*comparable(df.columns)).select("id", "health_status", "score_overall")


@query("p18_min_score", "select id from repos where coalesce(score_overall, 0) >= 75", ("repos",))
def min_score(t):
    return catalog.min_score(t("repos"), 75).select("id")
