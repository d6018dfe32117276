"""Report datasets, compositions and incremental ingest."""

from pyspark.sql import functions as F

from shelfmark.operators import catalog, keyed, records, reports
from shelfmark.operators.ranking import best_first
from shelfmark.plans import collect, maintain, publish, store
from shelfmark.schemas import REPOSITORY
from shelfmark.session import DENSE, shuffles_dropped, staged
from shelfmark.sources import tables
from shelfmark.streaming import ingest

from .common import csv, duck_list_hit, hits, nested, scratch, text
from .q_aggregates import GAIN, OLD_NEW, SUMMARY_SQL, changed
from .q_findings import LIMITS, RECURSIVE_KEPT, FILE_VIEWS, FINDINGS_SQL, cve_entries, repo_files
from .q_functions import CLASSIFIED_SQL, SCORE_INPUT_SQL, PUSH_SQL, duck_unique, heading_sql, scored
from .q_joins import DUE_SQL, FRESH_SQL, OWNERS_SQL, REFS_SQL, SECTIONS_SQL, fresh_rows, osv_responses, part_records, raw_records
from .q_sources import ENTRY_VIEWS, entries, entries_sql, kev_documents
from .registry import ORACLES, query
from .taxonomy import PARTS
from .views import AS_OF, DATE1, DATE2, DIFF_AS_OF, FACTS_AS_OF

LINE = ["block", "parent", "leaf", "slot", "line"]
_SCORE = "case when score = 0 then '0' else cast(score as varchar) end"
_STARS = "format('{:,}', stars)"


def _tree_sql(title: list[str], entry: str) -> str:
    head = " union all ".join(f"select 0 as block, '' as parent, '' as leaf, {i} as slot, '{line}' as line" for i, line in enumerate(title))
    return f"""with {entries_sql()} {head}
        union all select 0, '', '', {len(title)}, 'Records: ' || count(distinct id) from entries
        union all select distinct 1, parent, '', 0, '## ' || parent from entries
        union all select distinct 1, parent, category, 1, '### ' || category from entries where category <> parent
        union all select 1, parent, category, 2, {entry} from entries"""


@query("r01_tree_entries", f"with {entries_sql()} select id, name, url, description, stars, language, score, health, category, parent from entries", ENTRY_VIEWS)
def tree_entries(t):
    return entries(t)


@query("r02_sitemap", _tree_sql(
    ["# Catalog tree", "Generated: now"], f"'- [' || name || '](' || url || ') - ' || {_STARS} || ' stargazers, points ' || {_SCORE}"), ENTRY_VIEWS)
def sitemap(t):
    return reports.sitemap_lines(entries(t), "now").select(LINE)


@query("r03_index_text", _tree_sql(
    ["# Catalog lines", "> One line for each record."],
    "'- [' || name || '](' || url || '): ' || case when coalesce(description, '') = '' then '(no text)' else trim(description) end"), ENTRY_VIEWS)
def index_text(t):
    return reports.index_text_lines(entries(t)).select(LINE)


_N = "n || case when n = 1 then ' record' else ' records' end"


@query("r04_agent_guide", f"""
    with {entries_sql()}, once as (select * from (select *, row_number() over (partition by id order by parent, category) as pos from entries) where pos = 1),
    best as (select * from once order by score desc, stars desc, id limit 50),
    shape as (select count(distinct id) as a, count(distinct parent || '|' || category) as b, count(distinct parent) as c from entries)
    select 0 as block, '' as parent, '' as leaf, 0 as slot, '# Guide for readers' as line union all select 0, '', '', 1, '## Size'
    union all select 1, '', '', 0, '- Records: ' || a from shape union all select 1, '', '', 1, '- Leaves: ' || b from shape
    union all select 1, '', '', 2, '- Parents: ' || c from shape
    union all select 1, '', '', 9, '- Stargazers: ' || format('{{:,}}', cast(coalesce(sum(stars), 0) as bigint)) from repos
    union all select 2, coalesce(health_status, ''), '', 0, '- Status ' || coalesce(health_status, '') || ': ' || count(*) from repos group by health_status
    union all select 3, '', '', 0, '## Tree'
    union all select 4, parent, '', 0, '- `' || parent || '` (' || {_N} || ')' from (select parent, count(*) as n from entries group by parent)
    union all select 4, parent, category, 0, '  - `' || category || '` (' || {_N} || ')' from (select parent, category, count(*) as n from entries where category <> parent group by 1, 2)
    union all select 5, '', '', 0, '## Best points'
    union all select 6, '', '', 0, '| Name | Points | Stargazers | Leaf | Parent |' union all select 6, '', '', 1, '|---|---:|---:|---|---|'
    union all select 6, '', '', 2, '| [' || name || '](' || url || ') | ' || {_SCORE} || ' | ' || {_STARS} || ' | ' || category || ' | ' || parent || ' |' from best""", ENTRY_VIEWS)
def agent_guide(t):
    return reports.agent_guide_lines(entries(t), catalog.stats(t("repos"))).select(LINE)


_LABEL = lambda title, c: f"'- {title}: ' || case when {c} > 1000 then format('{{:,}}', {c}) else cast({c} as varchar) end"


@query("r05_daily_report", f"""
    with {entries_sql()}, s as (select count(distinct id) as total, count(distinct category) as categories, count(distinct parent) as parents from entries)
    select 0 as block, '' as parent, '' as leaf, 0 as slot, '# Catalog of the day' as line union all select 0, '', '', 1, '## 2001-08-02' union all select 0, '', '', 2, '### Totals'
    union all select 1, '', '', 0, {_LABEL('Total', 'total')} from s union all select 1, '', '', 1, {_LABEL('Categories', 'categories')} from s
    union all select 1, '', '', 2, {_LABEL('Parents', 'parents')} from s
    union all select distinct 2, parent, '', 0, '## ' || parent from entries union all select distinct 2, parent, '', 1, '| Name | Stargazers | Leaf | Points |' from entries
    union all select distinct 2, parent, '', 2, '|---|---:|---|---:|' from entries
    union all select 2, parent, category, 3, '| ' || name || ' | ' || {_STARS} || ' | ' || category || ' | ' || {_SCORE} || ' |' from entries""", ENTRY_VIEWS)
def daily_report(t):
    return publish.daily_report(t("repos"), t("bridge"), t("categories"), "2001-08-02").select(LINE)


_KINDS = [
    ("Added", "new_count", "records added: ", ""), ("Rising", "trending_count", "records with a large gain: ", ""),
    ("Edited", "updated_count", "records with edited fields: ", ""), ("Quiet", "stale_count", "records without recent pushes: ", ""),
    ("Frozen", "archived_count", "records now archived: ", ""), ("Gone", "removed_count", "records no longer listed: ", ""),
]
_DIFF_LINES = " union all ".join(
    f"select {i + 1}, 0, '', '## {title}' union all select {i + 1}, 1, '', '{mark}' || {c} || '{tail}' from counts"
    for i, (title, c, mark, tail) in enumerate(_KINDS))


@query("r06_change_report", f"""
    with {OLD_NEW}, counts as ({SUMMARY_SQL}) select 0 as block, 0 as slot, '' as id, '# What changed' as line union all {_DIFF_LINES}
    union all select 1, 2, id, '  - ' || coalesce(name, substr(id, 8)) || ' (' || format('{{:,}}', coalesce(stars, 0)) || ' stars)' from b where id not in (select id from a)
    union all select 2, 2, b.id, '  - ' || coalesce(b.name, substr(b.id, 8)) || ' (+' || format('{{:,}}', {GAIN}) || ')' from a join b on a.id = b.id where {GAIN} >= 500""", ("snapshots",))
def change_report(t):
    return reports.change_report_lines(changed(t)).select("block", "slot", "id", "line")


@query("r07_category_index", f"""
    with {entries_sql()} select 0 as block, '' as parent, '' as leaf, 0 as slot, '# Leaves and ids' as line
    union all select distinct 1, parent, '', 0, '## ' || parent from entries union all select 1, parent, category, 2, '- ' || id from entries""", ENTRY_VIEWS)
def category_index(t):
    return reports.category_index_lines(entries(t)).select(LINE)


@query("r08_record_line", """
    select id, '- **' || owner || '/' || name || '** (' || format('{:,}', coalesce(stars, 0)) || ' stars, ' || format('{:,}', forks) || ' forks) - ' || coalesce(health_status, 'UNKNOWN')
        || ' - Score: ' || case when coalesce(score_overall, 0) = 0 then 'N/A' else cast(cast(round_even(score_overall, 0) as bigint) as varchar) end as line from repos""", ("repos",))
def record_line(t):
    return t("repos").select("id", reports.record_line().alias("line"))


@query("r08_table_rows", "select id, '| ' || id || ' | ' || coalesce(cast(stars as varchar), 'None') || ' | ' || coalesce(language, 'None') || ' | ' || coalesce(cast(score_overall as varchar), 'None') || ' |' as line from repos", ("repos",))
def table_rows(t):
    return t("repos").select("id", reports.table_row("id", "stars", "language", "score_overall").alias("line"))


@query("r05_from_snapshot", ORACLES["r05_daily_report"])
def stored_daily_report(t):
    """Written with the snapshot of the date and read back from there."""
    flat = t("repos")
    spark, path = flat.sparkSession, scratch(flat.sparkSession, "r05")
    publish.publish(flat, t("bridge"), t("categories"), path, "2001-08-02", text_codec="gzip")
    return publish.stored_report(spark, path, "2001-08-02").select(LINE)


# --- compositions

_FIRST_HITS = f"""
    firsts as (select * from (select *, 'github:' || lower(owner) || '/' || lower(name) as id, row_number() over (partition by lower(owner), lower(name) order by seq) as pos from hits_flat
        where owner <> '' and name <> '') where pos = 1),
    classified as (select * replace (lower(name) as name), {CLASSIFIED_SQL} as categories from firsts)"""


@query("w01_collect", f"with {_FIRST_HITS} select id, stars, array_to_string(categories, ',') as categories, coalesce(archived, false) as archived, seq from classified", ("hits_flat",))
def run_collect(t):
    made = collect.collect(hits(t("hits_flat")), PARTS, AS_OF, staging=False)
    return made["records"].select("id", "stars", csv("awesome.categories"), "archived", "seq")


@query("w01_discover_collect", """
    with found as (select 'search_pattern' as source, p.query, id, stars from repos join (values ('order-1*', 'order-1%'), ('*7', '%7')) p(query, pat) on lower(name) like p.pat
        union all select 'topic', unnest(list_filter(['gear', 'ring'], lambda x: list_contains(topics, x))), id, stars from repos),
    capped as (select *, row_number() over (partition by source, query order by stars desc nulls last, id) as n from found)
    select distinct id from capped where n <= 40""", ("repos",))
def discover_collect(t):
    """From a catalog table to saved records: searches, cap per query, union, de-duplication."""
    found = collect.discover_hits(t("repos"), ["order-1*", "*7"], ["gear", "ring"], 40)
    return collect.collect(found, PARTS, AS_OF, staging=False)["records"].select("id")


@query("w01_collect_filtered", f"""
    with {_FIRST_HITS} select id, unnest(categories) as category from classified where list_has_any(categories, ['Gears', 'Plates', 'Gizmos'])""", ("hits_flat",))
def run_collect_filtered(t):
    made = collect.collect(hits(t("hits_flat")), PARTS, AS_OF, "Machines")
    return made["bridge"].withColumnRenamed("repository_id", "id")


@query("w01_collect_summary", f"""
    with {_FIRST_HITS} select count(*) as collected, count(*) filter (where len(categories) > 0) as categorized, cast(0 as bigint) as duplicates_merged from classified""", ("hits_flat",))
def run_collect_summary(t):
    return collect.collect(hits(t("hits_flat")), PARTS, AS_OF, "Machines", staging=False)["summary"]


_RUNS = f"""
    firsts as (select * from (select *, 'github:' || lower(owner) || '/' || lower(name) as id, row_number() over (partition by source, lower(owner), lower(name) order by seq) as pos from hits_flat
        where owner <> '' and name <> '') where pos = 1),
    latest as (select * replace (lower(name) as name) from (select *, row_number() over (partition by id order by case source when 'topic' then 0 else 1 end) as run from firsts) where run = 1)"""


@query("w01_collect_saved", f"with {_RUNS} select id, stars, array_to_string({CLASSIFIED_SQL}, ',') as categories from latest", ("hits_flat",))
def run_collect_saved(t):
    """Two saved runs; the second replaces the records both found."""
    rows = hits(t("hits_flat"))
    spark = rows.sparkSession
    first, second = scratch(spark, "w01a"), scratch(spark, "w01b")
    run = lambda kind: collect.collect(rows.filter(F.col("source") == kind), PARTS, AS_OF)
    store.save(spark, run("search_pattern"), first)
    store.save(spark, run("topic"), second, first)
    return spark.read.parquet(f"{second}/records").select("id", "stars", csv("awesome.categories"))


@query("w01_collect_with_facts", f"""
    with {_FIRST_HITS} select id, array_to_string(topics, ',') || ',fresh' as topics, coalesce(license, 'none') as license from classified""", ("hits_flat",))
def run_collect_with_facts(t):
    rows = hits(t("hits_flat"))
    ids = collect.collect(rows, PARTS, AS_OF)["records"]
    topics = ids.select("id", F.concat("topics", F.array(F.lit("fresh"))).alias("topics"))
    licenses = ids.filter("license is null").select("id", F.lit("none").alias("key"), F.lit(None).cast("string").alias("spdx_id"))
    counts = ids.select("id", F.lit(1).cast("bigint").alias("contributors"))
    made = collect.collect(rows, PARTS, AS_OF, facts=(topics, licenses, counts), staging=False)
    return made["records"].select("id", F.when(F.size("topics") == 1, ",fresh").otherwise(F.array_join("topics", ",")).alias("topics"), "license")


_MEMBERS = f"""{REFS_SQL.strip()}, {SECTIONS_SQL.strip()},
    per_list as (select * from (select *, row_number() over (partition by list_id, repo_id order by gen, pos) as rn from refs where repo_id <> 'github:lists/' || list_id) where rn = 1),
    members as (select p.list_id, p.gen, p.pos, p.repo_id as id, coalesce(m.section, '') as section, split_part(p.repo_id, '/', 2) as name, f.description, f.stars, cast([] as varchar[]) as topics,
        cast(null as varchar) as language from per_list p left join mentions m on m.list_id = p.list_id and m.repo_id = p.repo_id left join member_facts f on f.id = p.repo_id),
    saved as (select *, {duck_unique(f"list_concat(list_filter([{heading_sql('section')}], lambda x: x is not null), {CLASSIFIED_SQL})")} as categories
        from (select *, row_number() over (partition by id order by list_id, gen, pos) as rn from members) where rn = 1)"""


def _from_lists(t):
    facts = records.complete(t("member_facts"))
    staging = scratch(facts.sparkSession, "w02")
    return collect.collect_from_lists(t("lists_md"), facts, PARTS, AS_OF, staging)


@query("w02_collect_from_lists", f"with {_MEMBERS} select id, coalesce(stars, -1) as stars, array_to_string(categories, ',') as categories from saved", ("lists_md", "member_facts"))
def from_lists(t):
    return _from_lists(t)["records"].select("id", F.coalesce("stars", F.lit(-1)).alias("stars"), csv("awesome.categories"))


@query("w02_list_sources", f"with {_MEMBERS} select distinct id as repository_id, 'github:lists/' || list_id as source_repository, section as source_section from members", ("lists_md", "member_facts"))
def list_sources(t):
    return _from_lists(t)["sources"]


@query("w02_list_bridge", f"with {_MEMBERS} select distinct id as repository_id, unnest(categories) as category from saved", ("lists_md", "member_facts"))
def list_bridge(t):
    return _from_lists(t)["bridge"]


_PLACES = ", ".join(f"('{leaf}', '{parent}')" for leaf, parent in PARTS.leaf_parent.items())


@query("w02_list_categories", f"""
    with {_MEMBERS}, used as (select distinct unnest(categories) as leaf from saved), places(leaf, parent) as (values {_PLACES})
    select leaf as name, parent from used left join places using (leaf) union select parent, null from used join places using (leaf)""", ("lists_md", "member_facts"))
def list_categories(t):
    return _from_lists(t)["categories"]


@query("w02_saved", f"with {_MEMBERS} select id, coalesce(stars, -1) as stars from saved", ("lists_md", "member_facts"))
def saved_lists(t):
    """The run saved and read back."""
    made = _from_lists(t)
    spark = made["records"].sparkSession
    path = scratch(spark, "w02")
    store.save(spark, made, path)
    return spark.read.parquet(f"{path}/records").select("id", F.coalesce("stars", F.lit(-1)).alias("stars"))


@query("w02_list_summary", f"""
    with {_MEMBERS} select count(*) as collected, count(*) filter (where len(categories) > 0) as categorized,
        (select count(*) from (select id from members group by id having count(*) > 1)) as duplicates_merged from saved""", ("lists_md", "member_facts"))
def list_summary(t):
    return _from_lists(t)["summary"]


@query("w03_discover_lists", f"select 'github:' || owner || '/' || name as id, source, query, stars from hits_flat where {duck_list_hit()} and owner <> '' and name <> ''", ("hits_flat",))
def discover_lists(t):
    return collect.discover_lists(hits(t("hits_flat")), AS_OF).select("id", "source", "query", "stars")


@query("w03_search_lists", f"""
    with found as (select 'search_pattern' as source, p.query, r.* from repos r join (values ('order-1*', 'order-1%'), ('*-2*', '%-2%')) p(query, pat) on lower(r.name) like p.pat
        union all select 'topic', u.topic, u.* exclude (topic) from (select unnest(topics) as topic, * from repos) u where u.topic in ('awesome-list', 'gear')),
    best as (select * from (select *, row_number() over (partition by source, query order by stars desc nulls last, id) as n from found) where n <= 500),
    firsts as (select * from (select * exclude (n), row_number() over (partition by lower(owner), lower(name) order by source = 'topic', query, -coalesce(stars, 0), id) as n from best
        where owner <> '' and name <> '') where n = 1)
    select 'github:' || owner || '/' || name as id, source, query, stars, array_to_string(topics, ',') as topics from firsts where {duck_list_hit()}""", ("repos",))
def search_lists(t):
    """From the catalog table to list records in one plan."""
    return collect.search_lists(t("repos"), AS_OF, ["order-1*", "*-2*"], ["awesome-list", "gear"], 500).select(
        "id", "source", "query", "stars", csv("topics"))


@query("w04_score_all", f"""
    with {SCORE_INPUT_SQL} select id, overall as score_overall, case when archived then 'ARCHIVED' when raw_days is null then 'UNKNOWN'
        when raw_days <= 7 then case when coalesce(release_days <= 14 and contributors_90d >= 3, false) then 'ACTIVE' else 'MAINTAINED' end
        when raw_days <= 30 then 'MAINTAINED' when raw_days <= 90 then 'SLOW' else 'STALE' end as health_status from scored""", ("repos", "activity_facts"))
def score_all(t):
    return maintain.scored_flat(scored(t)).select("id", "score_overall", "health_status")


@query("w04_saved", f"""
    with {SCORE_INPUT_SQL} select id, overall as score_overall, coalesce(stars, -1) as stars from scored""", ("repos", "activity_facts"))
def saved_scores(t):
    """Records saved, scored in place of the stored ones, and read back."""
    stored = nested(t("repos"))
    spark = stored.sparkSession
    old, new = scratch(spark, "w04"), scratch(spark, "w04")
    store.save_records(spark, stored, old)
    store.save_scores(spark, old, new, t("activity_facts"), FACTS_AS_OF)
    return spark.read.parquet(f"{new}/records").select("id", F.col("score.overall").alias("score_overall"), F.coalesce("stars", F.lit(-1)).alias("stars"))


@query("w05_refresh", f"""
    with {FRESH_SQL}, chosen as (select * from repos where {DUE_SQL} order by collected_at asc nulls first, id limit 1000)
    select c.id, c.owner, f.stars, 'https://github.com/' || substr(c.id, 8) as url, '{AS_OF}' as collected_at, {PUSH_SQL.replace('pushed_at', 'f.pushed_at')} as status from chosen c join fresh f on f.id = c.id""", ("repos",))
def run_refresh(t):
    made = maintain.refresh_due(nested(t("repos")), fresh_rows(t), AS_OF, limit=1000)
    return made["records"].select("id", "owner", "stars", "url", text("collected_at"), "health.status")


@query("w05_saved", f"""
    with {FRESH_SQL}, chosen as (select * from repos where {DUE_SQL} order by collected_at asc nulls first, id limit 1000)
    select r.id, case when f.id is null then coalesce(r.stars, -1) else coalesce(f.stars, -1) end as stars
    from repos r left join (select c.id, f.stars from chosen c join fresh f on f.id = c.id) f on f.id = r.id""", ("repos",))
def saved_refresh(t):
    """Refreshed records saved over the stored ones, and the whole catalog read back."""
    stored = nested(t("repos"))
    spark = stored.sparkSession
    old, new = scratch(spark, "w05"), scratch(spark, "w05")
    store.save_records(spark, stored, old)
    store.save_records(spark, maintain.refresh_due(stored, fresh_rows(t), AS_OF, limit=1000)["records"], new, old)
    return spark.read.parquet(f"{new}/records").select("id", F.coalesce("stars", F.lit(-1)).alias("stars"))


@query("w07_enrich_saved", f"with {OWNERS_SQL}, {FINDINGS_SQL} select source, advisory_id, package, severity, summary, cve_ids, coalesce(repository_id, '') as repository_id from found", ("partrepos", "advisories"))
def saved_findings(t):
    """Findings saved twice: a repeated run replaces, it does not add."""
    found = maintain.enrich(part_records(t), osv_responses(t), kev_documents(t), cve_entries(t), AS_OF)["findings"]
    spark = found.sparkSession
    first, second = scratch(spark, "w07"), scratch(spark, "w07")
    store.save_findings(spark, found, first)
    store.save_findings(spark, found, second, first)
    return spark.read.parquet(f"{second}/findings").select("source", "advisory_id", "package", "severity", "summary", csv("cve_ids"), "repository_id")


@query("w06_generate", f"""
    with {entries_sql()}, of_parent as (select distinct parent, id, score, stars from entries)
    select 'members' as dataset, parent, category as leaf, row_number() over (partition by parent, category order by score desc, stars desc, id) as position, id from entries
    union all select 'parents', parent, '', row_number() over (partition by parent order by score desc, stars desc, id), id from of_parent
    union all select unnest(['repositories', 'daily']), '', '', 0, id from repos
    union all select 'sitemap', '', '', 2 + count(distinct parent) + count(distinct case when category <> parent then parent || '|' || category end) + count(*), '' from entries""", ENTRY_VIEWS)
def generate(t):
    flat = t("repos")
    spark, path = flat.sparkSession, scratch(flat.sparkSession, "w06")
    publish.publish(flat, t("bridge"), t("categories"), path, "2001-08-02", text_codec="gzip")
    index = lambda name: spark.read.parquet(f"{path}/index/{name}")
    parts = {
        "members": index("members"), "parents": index("parents"), "repositories": index("repositories").select("id"),
        "daily": tables.read_snapshot(spark, f"{path}/daily", "2001-08-02").select("id"),
        "sitemap": spark.read.text(f"{path}/sitemap").agg(F.count("*").alias("position")),
    }
    shape = {"parent": F.lit(""), "leaf": F.lit(""), "position": F.lit(0).cast("bigint"), "id": F.lit("")}
    out = None
    for name, df in parts.items():
        rows = df.select(F.lit(name).alias("dataset"), *[F.col(c) if c in df.columns else default.alias(c) for c, default in shape.items()])
        out = rows if out is None else out.unionByName(rows)
    return out


@query("w06_layout_lines", f"""
    with {entries_sql()}, lines as (
        select 'sitemap' as report, '# Catalog tree' as line union all select 'index_text', '# Catalog lines' union all select 'index_text', '> One line for each record.'
        union all select 'category_index', '# Leaves and ids'
        union all select unnest(['sitemap', 'index_text']), 'Records: ' || n from (select count(distinct id) as n from entries)
        union all select unnest(['sitemap', 'index_text', 'category_index']), '## ' || parent from (select distinct parent from entries)
        union all select unnest(['sitemap', 'index_text']), '### ' || category from (select distinct parent, category from entries where category <> parent)
        union all select 'sitemap', '- [' || name || '](' || url || ') - ' || format('{{:,}}', stars) || ' stargazers, points ' || case when score = 0 then '0' else cast(score as varchar) end from entries
        union all select 'index_text', '- [' || name || '](' || url || '): ' || trim(case when coalesce(description, '') = '' then '(no text)' else description end) from entries
        union all select 'category_index', '- ' || id from entries)
    select report, line, count(*) as n from lines group by report, line""", ENTRY_VIEWS)
def layout_lines(t):
    """All lines of the three reports that are read off one ordered layout, as published. They are counted report by report, so
    that the disks hold the shuffle of one."""
    flat = t("repos")
    spark, path = flat.sparkSession, scratch(flat.sparkSession, "w06")
    publish.publish(flat, t("bridge"), t("categories"), path, "2001-08-02", text_codec="gzip")
    out = None
    with shuffles_dropped(spark):
        for name in ("sitemap", "index_text", "category_index"):
            lines = spark.read.text(f"{path}/{name}").select(F.lit(name).alias("report"), F.col("value").alias("line"))
            counted = staged(lines.groupBy("report", "line").agg(F.count("*").alias("n")), "lines", DENSE)
            out = counted if out is None else out.unionByName(counted)
    return out


@query("w07_diff", f"with {OLD_NEW} {SUMMARY_SQL}", ("snapshots",))
def run_diff(t):
    return publish.diff_report(t("snapshots"), DATE1, DATE2, DIFF_AS_OF)["summary"]


@query("w07_enrich", f"with {OWNERS_SQL}, {FINDINGS_SQL} select source, advisory_id, package, severity, summary, cve_ids, repository_id, (select count(*) from found) as finding_count from found", ("partrepos", "advisories"))
def run_enrich(t):
    made = maintain.enrich(part_records(t), osv_responses(t), kev_documents(t), cve_entries(t), AS_OF)
    return made["findings"].select(
        "source", "advisory_id", "package", "severity", "summary", csv("cve_ids"), "repository_id", made["report"].select("finding_count").scalar().alias("finding_count"))


@query("w07_extract", RECURSIVE_KEPT + """, picked as (select id from doc_repos where score_overall >= 0 order by score_overall desc, id limit 15)
    select count(*) as selected, count(*) filter (where id in (select repository_id from kept)) as succeeded,
        count(*) filter (where id like 'github:%' and id not in (select repository_id from kept)) as skipped, count(*) filter (where id not like 'github:%') as failed,
        (select count(*) from kept where repository_id in (select id from picked)) as documents from picked""", FILE_VIEWS)
def run_extract(t):
    return maintain.extract(t("doc_repos"), repo_files(t), max_repositories=15, **LIMITS)["report"]


@query("w07_extract_saved", RECURSIVE_KEPT + """, picked as (select id from doc_repos where score_overall >= 0 order by score_overall desc, id limit 15)
    select 'report' as kind, concat_ws(' ', count(*), count(*) filter (where id in (select repository_id from kept)), count(*) filter (where id not like 'github:%')) as key, (select count(*) from kept where repository_id in (select id from picked)) as n from picked
    union all select 'stored', repository_id, count(*) from kept where repository_id in (select id from picked) group by repository_id""", FILE_VIEWS)
def saved_extraction(t):
    made = maintain.extract(t("doc_repos"), repo_files(t), max_repositories=15, **LIMITS)
    spark = made["documents"].sparkSession
    path = scratch(spark, "w07")
    report = store.save_extraction(spark, made, path, buckets=16)
    shown = report.select(F.lit("report").alias("kind"), F.concat_ws(" ", "selected", "succeeded", "failed").alias("key"), F.col("documents").alias("n"))
    stored = spark.read.parquet(f"{path}/content").groupBy(F.col("repository_id").alias("key")).agg(F.count("*").alias("n"))
    return shown.unionByName(stored.select(F.lit("stored").alias("kind"), "key", "n"))


@query("w07_trending", """
    select id, (select count(*) from repos where score_overall >= 75) as total from repos where score_overall >= 75 order by score_overall desc, id limit 10""", ("repos",))
def top_trending(t):
    return publish.top_trending(t("repos"), 10).select("id", "total")


@query("st1_incremental_ingest", "select rid as id, max(seq) as seq from raw_ids group by rid", ("raw_ids",))
def incremental_ingest(t):
    """Two landings and one replayed file; the newest row per id stays."""
    rows = raw_records(t).withColumns({"issues": F.col("seq"), "collected_at": F.timestamp_seconds("seq")})
    spark = rows.sparkSession
    base = scratch(spark, "st1")
    landing, log, check = f"{base}/landing", f"{base}/log", f"{base}/checkpoint"
    urgent = F.col("sources")[0]["section"].isin("1-URGENT", "2-HIGH")
    body = rows.select(*REPOSITORY.fieldNames())
    for part in (body.filter(~urgent), body.filter(urgent), body.filter(urgent)):
        part.write.mode("append").json(landing)
        ingest.start(spark, landing, log, check, PARTS).awaitTermination()
    return ingest.current(spark, log).select("id", F.col("issues").alias("seq"))


_PARENT = " ".join(f"when '{leaf}' then '{p}'" for leaf, p in PARTS.leaf_parent.items())


@query("st1_ledger", f"""
    with given as (select rid, unnest({CLASSIFIED_SQL}) as category from raw_ids), tree as (select category, case category {_PARENT} end as parent from given)
    select 'records' as dataset, rid as key, cast(max(seq) as varchar) as detail from raw_ids group by rid
    union all select distinct 'sources', rid || ' ' || source_repository, source_section from raw_ids
    union all select distinct 'bridge', rid, category from given
    union all select distinct 'categories', category, coalesce(parent, '') from tree
    union all select distinct 'categories', parent, '' from tree where parent is not null
    union all select 'open', '2', ''""", ("raw_ids",))
def ledger_ingest(t):
    """A batch, its replay, a batch that lands during compaction, and one after it: all tables over the last base and the log."""
    rows = raw_records(t).withColumns({"issues": F.col("seq"), "collected_at": F.timestamp_seconds("seq")})
    spark = rows.sparkSession
    base = scratch(spark, "st1")
    landing, log, check = f"{base}/landing", f"{base}/log", f"{base}/checkpoint"
    urgent = F.col("sources")[0]["section"].isin("1-URGENT", "2-HIGH")
    body = rows.select(*REPOSITORY.fieldNames())

    def arrive(part):
        part.write.mode("append").json(landing)
        ingest.start(spark, landing, log, check, PARTS).awaitTermination()

    arrive(body.filter(~urgent))
    ingest.land(body.filter(~urgent), 0, log, check, PARTS)  # replayed: entered before
    ingest.compact(spark, log, None, f"{base}/v1")
    arrive(body.filter(urgent))  # lands before the folded batches are dropped
    ingest.drop_folded(spark, log, f"{base}/v1")
    ingest.compact(spark, log, f"{base}/v1", f"{base}/v2")
    arrive(body.filter(urgent))
    ingest.drop_folded(spark, log, f"{base}/v2")
    read = lambda name: ingest.current(spark, log, f"{base}/v2", name)
    shown = read("records").select(F.lit("records").alias("dataset"), F.col("id").alias("key"), text("issues", "detail"))
    for name, key, detail in (("sources", F.concat_ws(" ", "repository_id", "source_repository"), F.col("source_section")),
                              ("bridge", F.col("repository_id"), F.col("category")), ("categories", F.col("name"), F.coalesce("parent", F.lit("")))):
        shown = shown.unionByName(read(name).select(F.lit(name).alias("dataset"), key.alias("key"), detail.alias("detail")))
    waiting = spark.createDataFrame([("open", str(n), "") for n in ingest.open_batches(spark, log, f"{base}/v2")], "dataset string, key string, detail string")
    return shown.unionByName(waiting)


# --- flagship: the best records of every category

_BEST_SQL = SCORE_INPUT_SQL.replace(
    "cast(50 as decimal(18, 6)) as p_awesome",
    f"{CLASSIFIED_SQL} as categories, cast(50 + case when len({CLASSIFIED_SQL}) >= 3 then 25 else 0 end as decimal(18, 6)) as p_awesome")


@query("w00_best_per_category", f"""
    with {_BEST_SQL}, spread as (select id, unnest(categories) as category, overall, coalesce(stars, 0) as stars from scored)
    select category, parent, id, overall, stars from (select s.*, p.parent, row_number() over (partition by category order by overall desc, stars desc, id) as pos
        from spread s join (values {', '.join(f"('{leaf}', '{p}')" for leaf, p in PARTS.leaf_parent.items())}) p(leaf, parent) on p.leaf = s.category) where pos <= 5""",
       ("repos", "activity_facts"))
def best_per_category(t):
    normalized = records.dedupe(records.normalize(nested(t("repos"))))
    classified = collect.classified(normalized, PARTS).select(*REPOSITORY.fieldNames(), "seq")
    ranked = maintain.score_all(classified, t("activity_facts"), FACTS_AS_OF)
    spread = ranked.select(
        "id", F.coalesce("stars", F.lit(0)).alias("stars"), F.col("score.overall").alias("overall"),
        F.explode(collect.parents_of("awesome.categories", PARTS)).alias("category", "parent"))
    return keyed.top_per_key(spread, ["category"], best_first("overall"), 5)
