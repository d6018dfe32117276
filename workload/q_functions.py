"""Scalar and generator functions: urls, Markdown, classification, scores, health."""

from pyspark.sql import functions as F

from shelfmark import constants as K
from shelfmark.functions import classify as C, markdown as M, scoring as S, text as X, urls as U
from shelfmark.functions.clock import days_since
from shelfmark.operators import lists, records, refresh
from shelfmark.plans import maintain

from .common import csv, duck_id_from_link, duck_id_from_url, nested
from .q_aggregates import DAYS, ROLLUP_SQL
from .q_joins import DUE_SQL, INTERVAL_SQL, REFS_SQL, SECTIONS_SQL, duck_package
from .registry import query
from .taxonomy import PARTS
from .views import AS_OF, AS_OF_S, FACTS_AS_OF

# --- urls

_U = "trim(coalesce(url, ''))"


def _duck_form(prefix: str, suffix: str) -> str:
    tail = f"substr({_U}, {len(prefix) + 1}, length({_U}) - {len(prefix) + len(suffix)})"
    path = f"rtrim({tail}, '/')"
    return (f"case when {_U} like '{prefix}%{suffix}' and {path} like '%/%' then 'github:' || lower(split_part({path}, '/', 1)) || '/' || "
            f"lower(split_part({path}, '/', 2)) end")


_NORMAL = "coalesce(" + ", ".join(_duck_form(p, s) for p, s in (
    ("git@github.com:", ".git"), ("git@ssh.github.com:/", ""), ("git://github.com/", ".git"),
    ("https://github.com/", ".git"), ("https://github.com/", ""))) + f", rtrim({_U}, '/'))"


@query("b01_normalize_url", f"select n, form, {_NORMAL} as id from url_rows", ("url_rows",))
def normalize_url(t):
    return t("url_rows").select("n", "form", U.normalize_url("url").alias("id"))


_PATH = "regexp_replace(trim(regexp_extract(ltrim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:www\\.)?github\\.com/([^?#]*)', 1), '/'), '\\.git$', '')"
_HOST = "coalesce(regexp_matches(ltrim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:www\\.)?github\\.com(?:[/?#]|$)'), false)"


@query("b02_canonical_https", f"select n, case when {_HOST} then 'https://github.com/' || {_PATH} else url end as url from url_rows", ("url_rows",))
def canonical_https(t):
    return t("url_rows").select("n", U.canonical_https("url").alias("url"))


@query("b03_id_from_url", f"select n, form, {duck_id_from_url('url')} as id from url_rows", ("url_rows",))
def id_from_url(t):
    return t("url_rows").select("n", "form", U.id_from_url("url").alias("id"))


@query("b04_id_from_link", f"select n, form, {duck_id_from_link('url')} as id from url_rows", ("url_rows",))
def id_from_link(t):
    return t("url_rows").select("n", "form", U.id_from_link("url").alias("id"))


@query("b05_repository_id", "select seq, 'github:' || lower(trim(owner)) || '/' || lower(trim(name)) as id from raw", ("raw",))
def repository_id(t):
    return t("raw").select("seq", U.repository_id("owner", "name").alias("id"))


@query("b06_split_id", r"""
    with x as (select n, """ + _NORMAL + r""" as id from url_rows)
    select n, regexp_extract(id, '^github:([^/]*)/([^/]*)$', 1) as owner, regexp_extract(id, '^github:([^/]*)/([^/]*)$', 2) as name
    from x where regexp_matches(id, '^github:[^/]*/[^/]*$')""", ("url_rows",))
def split_id(t):
    parts = t("url_rows").select("n", U.split_id(U.normalize_url("url")).alias("p"))
    return parts.filter("p is not null").select("n", "p.owner", "p.name")


@query("b06_malformed_ids", "with x as (select n, " + _NORMAL + " as id from url_rows) select n, id from x where not regexp_matches(id, '^github:[^/]*/[^/]*$')", ("url_rows",))
def malformed_ids(t):
    return records.malformed_ids(t("url_rows").select("n", U.normalize_url("url").alias("id")))


@query("b07_url_from_id", "select id, 'https://github.com/' || owner || '/' || name as url from repos", ("repos",))
def url_from_id(t):
    return t("repos").select("id", U.url_from_id("id").alias("url"))


@query("b08_catalog_host", f"select n, {_HOST} as on_host from url_rows", ("url_rows",))
def catalog_host(t):
    return t("url_rows").select("n", U.is_catalog_url("url").alias("on_host"))


@query("b09_normalize_record", "select seq, rid as id, low_owner as owner, low_name as name, 'https://github.com/' || low_owner || '/' || low_name as url from raw_ids", ("raw_ids",))
def normalize_record(t):
    return records.normalize(t("raw")).select("seq", "id", "owner", "name", "url")


@query("b10_record_from_url", f"""
    with x as (select {duck_id_from_url('url')} as id from url_rows) select id, split_part(substr(id, 8), '/', 1) as owner, split_part(id, '/', 2) as name,
        'https://github.com/' || substr(id, 8) as url from x where id is not null""", ("url_rows",))
def record_from_url(t):
    return records.from_urls(t("url_rows"), "url", AS_OF).select("id", "owner", "name", "url")


@query("b11_package_name", f"select seq, {duck_package('package')} as a, {duck_package('vendor')} as b, {duck_package('db_severity')} as c from advisories", ("advisories",))
def package_name(t):
    return t("advisories").select("seq", U.package_name("package").alias("a"), U.package_name("vendor").alias("b"), U.package_name("db_severity").alias("c"))


@query("b12_display_path", "select id, owner || '/' || name as path from repos", ("repos",))
def display_path(t):
    return t("repos").select("id", U.display_path("owner", "name").alias("path"))


# --- Markdown

_HEADS = r"regexp_extract_all(markdown, '(?m)^#{1,6}\s+(.+)$', %d)"
_LINKS = r"regexp_extract_all(markdown, '\[([^\]]*)\]\(([^)]+)\)', %d)"


@query("c01_links", f"select list_id, generate_subscripts(a, 1) - 1 as pos, unnest(a) as text, unnest(b) as url from (select list_id, {_LINKS % 1} as a, {_LINKS % 2} as b from lists_md)", ("lists_md",))
def links(t):
    return lists.link_rows(t("lists_md"))


@query("c02_bare_urls", r"select list_id, unnest(regexp_extract_all(markdown, '(?i)(https?://github\.com/[a-zA-Z0-9_.-]+/[a-zA-Z0-9_.-]+)', 1)) as url from lists_md", ("lists_md",))
def bare_urls(t):
    return t("lists_md").select("list_id", F.explode(M.bare_urls("markdown")).alias("url"))


@query("c03_bracket_urls", r"select list_id, unnest(regexp_extract_all(markdown, '<(https://github\.com/[a-zA-Z0-9_.-]+/[a-zA-Z0-9_.-]+)>', 1)) as url from lists_md", ("lists_md",))
def bracket_urls(t):
    return t("lists_md").select("list_id", F.explode(M.bracket_urls("markdown")).alias("url"))


@query("c04_headings", f"""
    select list_id, pos, title, cast(length(regexp_replace(line, '[^#]', '', 'g')) as bigint) as level from (
        select list_id, generate_subscripts(a, 1) - 1 as pos, unnest(a) as title, unnest(b) as line from (select list_id, {_HEADS % 1} as a, {_HEADS % 0} as b from lists_md))""", ("lists_md",))
def headings(t):
    return lists.heading_rows(t("lists_md"))


@query("c05_repository_links", f"with {REFS_SQL} select list_id, pos, trim(txt) as text, repo_id from refs where gen = 0", ("lists_md",))
def repository_links(t):
    return lists.repository_links(t("lists_md"))


@query("c06_references", f"""
    with {REFS_SQL} select list_id, repo_id, case gen when 0 then 'link' when 1 then 'raw_url' else 'ossfuzz' end as type, txt as text, url from (
        select *, row_number() over (partition by list_id, repo_id order by gen, pos) as rn from refs) where gen = 0 or rn = 1""", ("lists_md",))
def references(t):
    return lists.references(t("lists_md")).select("list_id", "repo_id", "type", "text", "url")


_DISTINCT = rf"""
    bullets as (
        select list_id, 0 as gen, generate_subscripts(a, 1) - 1 as pos, unnest(a) as txt, unnest(b) as url from (select list_id,
            regexp_extract_all(markdown, '(?m)^[\s\-\*]*\[([^\]]+)\]\((https?://[^\)]+)\)', 1) as a, regexp_extract_all(markdown, '(?m)^[\s\-\*]*\[([^\]]+)\]\((https?://[^\)]+)\)', 2) as b from lists_md)
        union all select list_id, 1, generate_subscripts(a, 1) - 1, unnest(a), unnest(a) from (select list_id,
            regexp_extract_all(markdown, '(https?://github\.com/[a-zA-Z0-9_.-]+/[a-zA-Z0-9_.-]+)', 1) as a from lists_md)),
    known as (select *, {duck_id_from_url('url')} as repo_id from bullets where {duck_id_from_url('url')} is not null),
    firsts as (select * from (select *, row_number() over (partition by list_id, repo_id order by gen, pos) as rn from known) where rn = 1)"""


@query("c07_parsed_list", f"""
    with {_DISTINCT}, totals as (select list_id, count(*) as n from firsts group by list_id)
    select list_id, list_id as source_repository, cast(len({_HEADS % 1}) as bigint) as sections, array_to_string(list_transform(list_filter({_HEADS % 0}, lambda x: x like '# %'), lambda x: substr(x, 3)), '~') as categories,
        coalesce(n, 0) as total_repositories from lists_md left join totals using (list_id)""", ("lists_md",))
def parsed(t):
    return lists.parsed(t("lists_md"), "repo").select(
        "list_id", "source_repository", F.size("sections").cast("bigint").alias("sections"), F.array_join("categories", "~").alias("categories"), "total_repositories")


@query("c08_sections", f"""
    select list_id, pos, trim(title) as title, cast(length(line) - length(trim(title)) as bigint) as level, line as "match" from (
        select list_id, generate_subscripts(a, 1) - 1 as pos, unnest(a) as title, unnest(b) as line from (select list_id, {_HEADS % 1} as a, {_HEADS % 0} as b from lists_md))""", ("lists_md",))
def sections(t):
    return lists.section_rows(t("lists_md"))


@query("c09_distinct_repositories", f"with {_DISTINCT} select list_id, repo_id, trim(txt) as name, {_NORMAL} as url, case gen when 0 then 'link' else 'raw_url' end as source from firsts", ("lists_md",))
def distinct_repositories(t):
    return lists.distinct_repositories(t("lists_md")).select("list_id", "repo_id", "name", "url", "source")


@query("c10_category_titles", f"select list_id, unnest(list_transform(list_filter({_HEADS % 0}, lambda x: x like '# %'), lambda x: substr(x, 3))) as title from lists_md", ("lists_md",))
def category_titles(t):
    return t("lists_md").select("list_id", F.explode(M.category_titles("markdown")).alias("title"))


@query("c11_sectioned_repositories", r"""
    with doc_lines as (select list_id, generate_subscripts(ls, 1) as line_no, unnest(ls) as line from (select list_id, split(markdown, chr(10)) as ls from lists_md)),
    marked as (select *, regexp_matches(line, '^#{1,3}\s+.+$') as opens, regexp_matches(line, '^#{5,6}\s+.+$') as small,
        regexp_extract(line, '(?i)(https?://github\.com/[a-zA-Z0-9_.-]+/[a-zA-Z0-9_.-]+)', 1) as url from doc_lines),
    carried as (select *, sum(case when opens then 1 else 0 end) over (partition by list_id order by line_no) as section_no from marked),
    heads as (select list_id, section_no, trim(regexp_extract(line, '^#{1,3}\s+(.+)$', 1)) as section from carried where opens),
    items as (select list_id, section_no, line_no, url, case when regexp_matches(trim(line), '^[\s\-\*]*\[?([^\]]*)\]?\s*\((https?://[^)]+)\)')
        then trim(regexp_extract(trim(line), '^[\s\-\*]*\[?([^\]]*)\]?\s*\((https?://[^)]+)\)', 1)) else url end as name
        from carried where not opens and not small and url <> '' and section_no > 0)
    select h.list_id, h.section, cast(h.section_no as bigint) as section_no, case when i.url is null then null else """ + _NORMAL.replace("url", "i.url") + r""" end as url, i.name
    from heads h left join items i on i.list_id = h.list_id and i.section_no = h.section_no""", ("lists_md",))
def sectioned_repositories(t):
    return lists.sectioned_repositories(t("lists_md")).select("list_id", "section", "section_no", "url", "name")


@query("c12_list_members", f"""
    with {REFS_SQL}, {SECTIONS_SQL}, firsts as (select * from (select *, row_number() over (partition by list_id, repo_id order by gen, pos) as rn from refs where repo_id <> 'github:lists/' || list_id) where rn = 1)
    select f.list_id, 'lists/' || f.list_id as parent_list, f.repo_id, coalesce(m.section, '') as section, split_part(substr(f.repo_id, 8), '/', 1) as owner, split_part(f.repo_id, '/', 2) as name,
        'https://github.com/' || substr(f.repo_id, 8) as url from firsts f left join mentions m on m.list_id = f.list_id and m.repo_id = f.repo_id""", ("lists_md",))
def list_members(t):
    return lists.list_members(t("lists_md")).select("list_id", "parent_list", "repo_id", "section", "owner", "name", "url")


_QUALITY = r"""
    with x as (select doc_id, text, cast(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) as bigint) as word_count,
        regexp_matches(text, '(?m)^\[?\[?[^\]]+\]:?\s+#') as has_toc, regexp_matches(text, '!\[[^\]]*\]\([^)]*\)') as has_badges,
        regexp_matches(text, '(?m)^\|.*\|.*\|') as has_tables, contains(text, '```') as has_code_blocks from docs_md)
    select doc_id, word_count, has_toc, has_badges, has_tables, has_code_blocks, cast(least(100, case when word_count >= 50 then 25 when word_count >= 20 then 15 else 0 end
        + case when has_toc then 25 else 0 end + case when has_badges then 15 else 0 end + case when has_tables then 20 else 0 end + case when has_code_blocks then 15 else 0 end) as bigint) as quality_score from x"""


@query("c13_readme_quality", _QUALITY, ("docs_md",))
def readme_quality(t):
    return t("docs_md").select("doc_id", M.readme_quality("text").alias("q")).select("doc_id", "q.*")


# --- classification

_TEXT = "(coalesce(description, '') || ' ' || array_to_string(topics, ' ') || ' ' || coalesce(name, ''))"


def _quoted(word: str) -> str:
    return word.lower().replace(".", "\\.").replace("+", "\\+")


def duck_keywords(text_: str, leaves=None) -> str:
    cases = [
        f"case when regexp_matches(lower({text_}), '(^|[^a-z0-9])({'|'.join(_quoted(w) for w in words)})([^a-z0-9]|$)') then '{leaf}' end"
        for leaf, words in PARTS.keywords.items() if leaves is None or leaf in leaves]
    return f"list_filter([{', '.join(cases)}], lambda x: x is not null)" if cases else "[]"


def duck_topics(topics: str = "topics") -> str:
    owner: dict[str, str] = {}
    for leaf, words in PARTS.topics.items():
        for word in words:
            owner.setdefault(word.lower(), leaf)
    cases = " ".join(f"when '{w}' then '{leaf}'" for w, leaf in owner.items())
    return duck_unique(f"list_filter(list_transform({topics}, lambda x: case lower(x) {cases} end), lambda x: x is not null)")


def duck_unique(a: str) -> str:
    """Distinct values of a list in order of first occurrence."""
    return f"list_filter({a}, lambda x, i: list_position({a}, x) = i)"


def duck_language(table=K.LANGUAGE_CATEGORIES, known=True, expr="lower(trim(language))") -> str:
    cases = " ".join(f"when '{k}' then '{v}'" for k, v in table.items() if not known or v in PARTS.leaf_parent)
    return f"list_filter([case {expr} {cases} end], lambda x: x is not null)"


_ALL = f"list_concat(list_concat({duck_topics()}, {duck_language()}), {duck_keywords(_TEXT)})"
CLASSIFIED_SQL = f"list_slice({duck_unique(_ALL)}, 1, 5)"
_CLASSIFY = lambda: C.classify("description", "topics", "name", "language", PARTS)


@query("t01_topic_categories", f"select id, array_to_string({duck_topics()}, ',') as categories from partrepos", ("partrepos",))
def topic_categories(t):
    return t("partrepos").select("id", csv(C.by_topics("topics", PARTS), "categories"))


@query("t02_language_categories", f"select id, array_to_string({duck_language(known=False)}, ',') as categories from partrepos", ("partrepos",))
def language_categories(t):
    return t("partrepos").select("id", csv(C.by_language("language"), "categories"))


@query("t03_keyword_categories", f"select id, array_to_string({duck_keywords(_TEXT)}, ',') as categories from partrepos", ("partrepos",))
def keyword_categories(t):
    return t("partrepos").select("id", csv(C.by_keywords(C.keyword_text("description", "topics", "name"), PARTS), "categories"))


@query("t04_classify", f"select id, array_to_string({CLASSIFIED_SQL}, ',') as categories from partrepos", ("partrepos",))
def classify(t):
    return t("partrepos").select("id", csv(_CLASSIFY(), "categories"))


@query("t04_classify_orders", f"select id, array_to_string({CLASSIFIED_SQL}, ',') as categories from repos", ("repos",))
def classify_orders(t):
    return t("repos").select("id", csv(_CLASSIFY(), "categories"))


@query("l07_first_categories", f"select id, array_to_string(list_slice({duck_unique(_ALL)}, 1, 2), ',') as categories from repos", ("repos",))
def first_categories(t):
    return t("repos").select("id", csv(C.classify("description", "topics", "name", "language", PARTS, limit=2), "categories"))


_CLEAN = r"trim(trim(trim(regexp_replace(regexp_replace(regexp_replace(coalesce({}, ''), '[\[\](){}*_`#•·|]+', ' ', 'g'), '[\x{1F000}-\x{1FAFF}\x{2190}-\x{21FF}\x{2300}-\x{27BF}\x{2B00}-\x{2BFF}\x{FE0F}\x{200D}]+', ' ', 'g'), '\s+', ' ', 'g')), '-–—:|,'))"


def clean_sql(c: str) -> str:
    return _CLEAN.replace("coalesce({}", "coalesce(" + c)


def heading_sql(c: str) -> str:
    title = clean_sql(c)
    exact = " ".join(f"when lower({title}) = '{leaf.lower()}' then '{leaf}'" for leaf in PARTS.leaves)
    inside = " ".join(f"when {title} = '{p}' then ({duck_keywords(title, set(ls))})[1]" for p, ls in PARTS.parents.items())
    return f"case when {title} = '' then null {exact} {inside} else ({duck_keywords(title)})[1] end"


@query("t05_clean_heading", f"select n, {clean_sql('heading')} as title from headings", ("headings",))
def clean_heading(t):
    return t("headings").select("n", C.clean_heading("heading").alias("title"))


@query("t06_heading_category", f"select n, {heading_sql('heading')} as category from headings", ("headings",))
def heading_category(t):
    return t("headings").select("n", C.heading_category("heading", PARTS).alias("category"))


@query("t07_member_categories", f"""
    select n, array_to_string({duck_unique(f"list_concat(list_filter([{heading_sql('heading')}], lambda x: x is not null), {CLASSIFIED_SQL})")}, ',') as categories from headings""", ("headings",))
def member_categories(t):
    return t("headings").select("n", csv(C.with_section(C.heading_category("heading", PARTS), _CLASSIFY()), "categories"))


_LEAF_PARENT = " ".join(f"when '{leaf}' then '{p}'" for leaf, p in PARTS.leaf_parent.items())


@query("t08_category_parents", f"""
    select repository_id, category, case category {_LEAF_PARENT} end as parent from bridge where case category {_LEAF_PARENT} end is not null""", ("bridge",))
def category_parents(t):
    grouped = t("bridge").groupBy("repository_id").agg(F.collect_set("category").alias("c"))
    return grouped.select("repository_id", F.explode(C.parents_of("c", PARTS)).alias("category", "parent"))


@query("t09_declared_leaves", f"""
    select id, array_to_string(list_filter([language, 'Rings', name], lambda x: x in ({', '.join(repr(x) for x in PARTS.leaves)})), ',') as leaves from repos""", ("repos",))
def declared_leaves(t):
    return t("repos").select("id", csv(C.declared(F.array("language", F.lit("Rings"), "name", F.lit("Rings")), PARTS), "leaves"))


@query("t09_taxonomy_join", "select b.category, t.parent, count(*) as n from bridge b join (values " + ", ".join(
    f"('{p}', '{leaf}')" for leaf, p in PARTS.leaf_parent.items()) + ") t(parent, leaf) on t.leaf = b.category group by 1, 2", ("bridge",))
def taxonomy_join(t):
    rows = t("bridge")
    frame = PARTS.frame(rows.sparkSession).select(F.col("leaf").alias("category"), "parent")
    return rows.join(frame, "category").groupBy("category", "parent").agg(F.count("*").alias("n"))


_SUB = [f"case when {' or '.join(f'contains(lower({_TEXT}), ' + repr(w.lower()) + ')' for w in words)} then '{leaf}' end" for leaf, words in PARTS.keywords.items()]


@query("t10_substring_categories", f"select id, array_to_string(list_filter([{', '.join(_SUB)}], lambda x: x is not null), ',') as categories from partrepos", ("partrepos",))
def substring_categories(t):
    return t("partrepos").select("id", csv(C.by_substrings("description", "topics", "name", PARTS.keywords), "categories"))


@query("t11_exact_language", f"select id, array_to_string({duck_language(K.LEGACY_LANGUAGE_CATEGORIES, False, 'lower(language)')}, ',') as categories from partrepos", ("partrepos",))
def exact_language(t):
    return t("partrepos").select("id", csv(C.by_exact_language("language"), "categories"))


# --- scores; the second engine computes them in decimals

_dec = lambda c: f"cast(coalesce({c}, 0) as decimal(18, 0))"
_POP = lambda p: (f"case when {_dec('stars')} = 0 then cast(0 as decimal(18, 6)) else cast(least({_dec('stars')} * 0.00001, 1.0) * 40 + least({_dec('forks')} * 0.0001, 1.0) * 30 + least({_dec(p)} * 0.05, 1.0) * 30 as decimal(18, 6)) end")
_RECENT = lambda d: f"case when {d} <= 7 then 100 when {d} <= 30 then 80 when {d} <= 90 then 50 else 20 end"
_ACT = lambda d, c, r: (f"case when {d} <= 0 and coalesce({c}, 0) <= 0 then cast(0 as decimal(18, 6)) else cast(({_RECENT(d)}) * 0.4 + (case when coalesce({c}, 0) >= 10 then 100 when coalesce({c}, 0) >= 3 then 70 when coalesce({c}, 0) >= 1 then 40 else 10 end) * 0.3 "
                        f"+ (case when coalesce({r}, 0) >= 5 then 100 when coalesce({r}, 0) >= 2 then 70 when coalesce({r}, 0) >= 1 then 40 else 20 end) * 0.3 as decimal(18, 6)) end")
_SET = lambda c: f"(coalesce({c}, '') <> '')"
_MAINT = lambda d, resp="30": f"cast((case when {_SET('description')} then 100 else 0 end + case when {_SET('license')} then 100 else 0 end + {resp} + {_RECENT(d)}) * 0.25 as decimal(18, 6))"
_COMM = lambda p: (f"cast(least({_dec(p)} * 0.05, 1.0) * 40 + least({_dec('forks')} * 0.001, 1.0) * 30 + (case when coalesce(issues, 0) > 500 then 20 when coalesce(issues, 0) > 100 then 40 when coalesce(issues, 0) > 10 then 70 when coalesce(issues, 0) > 0 then 90 else 100 end) * 0.3 as decimal(18, 6))")
_DOC = "cast(case when length(coalesce(description, '')) > 20 then 75 else 50 end as decimal(18, 6))"
_any = lambda c, words: "(" + " or ".join(f"contains({c}, '{w}')" for w in words) + ")"
_LIC = (f"cast(case when not {_SET('license')} then 0 when {_any('lower(license)', K.PERMISSIVE_LICENSES)} then 100 when {_any('lower(license)', K.COPYLEFT_LICENSES)} then 50 else 25 end as decimal(18, 6))")
_topic = lambda w: f"list_contains(list_transform(topics, lambda x: lower(x)), '{w}')"
_low = "lower(coalesce({}, ''))"
_TOOL = f"({_any(_low.format('name'), K.VULNERABILITY_TOOLS)} or {_any(_low.format('description'), K.VULNERABILITY_TOOLS)})"
_SEC = f"cast(case when {_topic('security')} then 30 else 0 end + case when {_TOOL} then 30 else 0 end + case when {_topic('copilot')} then 20 else 0 end + case when {_topic('dependabot')} then 20 else 0 end as decimal(18, 6))"
_one = lambda e: f"cast(round({e}, 1) as double)"
_out = S.points
_AGE = f"floor(({AS_OF_S} - epoch(pushed_at)) / 86400.0)"


@query("g01_popularity", f"select id, {_one(_POP('issues'))} as popularity from repos", ("repos",))
def popularity(t):
    return t("repos").select("id", _out(S.popularity("stars", "forks", "issues")).alias("popularity"))


@query("g02_activity", f"select id, {_one(_ACT(f'coalesce({_AGE}, 0)', 'issues % 12', 'forks % 7'))} as activity from repos", ("repos",))
def activity_score(t):
    days = F.coalesce(days_since("pushed_at", AS_OF), F.lit(0))
    return t("repos").select("id", _out(S.activity(days, F.col("issues") % 12, F.col("forks") % 7)).alias("activity"))


_RESP = "case when stars is null then 30 when issues <= 7 then 100 when issues <= 14 then 80 when issues <= 30 then 50 else 20 end"


@query("g03_maintenance", f"select id, {_one(_MAINT(f'coalesce({_AGE}, 999)', _RESP))} as maintenance from repos", ("repos",))
def maintenance(t):
    response = F.when(F.col("stars").isNotNull(), F.col("issues"))
    days = F.coalesce(days_since("pushed_at", AS_OF), F.lit(999))
    return t("repos").select("id", _out(S.maintenance(X.is_set("description"), X.is_set("license"), response, days)).alias("maintenance"))


@query("g04_community", f"select id, {_one(_COMM('issues'))} as community from repos", ("repos",))
def community(t):
    return t("repos").select("id", _out(S.community("issues", "forks", "issues")).alias("community"))


@query("g05_documentation", f"select id, {_one(_DOC)} as documentation from repos", ("repos",))
def documentation(t):
    return t("repos").select("id", _out(S.documentation("description")).alias("documentation"))


@query("g06_license", f"select id, {_one(_LIC)} as license_score from repos", ("repos",))
def license_score(t):
    return t("repos").select("id", _out(S.license_points("license")).alias("license_score"))


@query("g07_security", f"select id, {_one(_SEC)} as security from repos", ("repos",))
def security(t):
    return t("repos").select("id", _out(S.security(S.security_flags("name", "description", "topics"))).alias("security"))


@query("g08_security_flags", f"select id, {_topic('security')} as policy, {_TOOL} as tool, {_topic('copilot')} as copilot, {_topic('dependabot')} as dependabot from repos", ("repos",))
def security_flags(t):
    return t("repos").select("id", S.security_flags("name", "description", "topics").alias("f")).select("id", "f.*")


SCORE_INPUT_SQL = f"""
    {ROLLUP_SQL.strip()}, acts as (select r.*, coalesce(case when f.id is null then {DAYS('r.pushed_at')} else {DAYS('f.last_commit')} end, 999) as push_days,
        case when f.id is null then {DAYS('r.pushed_at')} else {DAYS('f.last_commit')} end as raw_days, {DAYS('f.last_release')} as release_days,
        f.commits_30d, f.releases_90d, f.contributors_90d from repos r left join rolled f on f.id = r.id),
    parts as (select *, {_POP('contributors_90d')} as p_popularity, {_ACT('push_days', 'commits_30d', 'releases_90d')} as p_activity, {_MAINT('push_days')} as p_maintenance,
        {_COMM('contributors_90d')} as p_community, {_DOC} as p_documentation, {_LIC} as p_license, {_SEC} as p_security, cast(50 as decimal(18, 6)) as p_awesome from acts),
    scored as (select *, {_one("p_popularity * 0.20 + p_activity * 0.20 + p_maintenance * 0.20 + p_community * 0.15 + p_documentation * 0.10 + p_license * 0.05 + p_security * 0.05 + p_awesome * 0.05")} as overall from parts)"""


def scored(t, **options):
    return maintain.score_all(nested(t("repos")), t("activity_facts"), FACTS_AS_OF, **options)


@query("g09_overall_score", f"""
    with {SCORE_INPUT_SQL} select id, overall, {_one('p_popularity')} as popularity, {_one('p_activity')} as activity, {_one('p_maintenance')} as maintenance, {_one('p_community')} as community,
        {_one('p_documentation')} as documentation, {_one('p_license')} as license, {_one('p_security')} as security, {_one('p_awesome')} as awesome_quality from scored""", ("repos", "activity_facts"))
def overall_score(t):
    return scored(t).select("id", "score.*")


_WEIGHTED = SCORE_INPUT_SQL.replace("p_popularity * 0.20", "p_popularity * 0.5").replace("p_activity * 0.20", "p_activity * 0.5")
for _name, _w in (("maintenance", "0.20"), ("community", "0.15"), ("documentation", "0.10"), ("license", "0.05"), ("security", "0.05"), ("awesome", "0.05")):
    _WEIGHTED = _WEIGHTED.replace(f"p_{_name} * {_w}", f"p_{_name} * 0")


@query("g09_custom_weights", f"with {_WEIGHTED} select id, overall from scored", ("repos", "activity_facts"))
def custom_weights(t):
    weights = dict.fromkeys(K.SCORE_COMPONENTS, 0) | {"popularity": 0.5, "activity": 0.5}
    return scored(t, weights=weights).select("id", "score.overall")


@query("g10_list_quality", """
    select id, cast(50 + case when len(topics) = 0 then 0 else case when archived then 25 else 0 end + case when len(topics) + 1 >= 3 then 25 else 0 end end as double) as quality from repos""", ("repos",))
def list_quality(t):
    has = F.size("topics") > 0
    return t("repos").select("id", _out(S.list_quality(has, F.col("archived"), F.concat("topics", F.array(F.lit("x"))))).alias("quality"))


@query("h01_days_since", f"select id, cast(cast({_AGE} as bigint) as varchar) as days from repos", ("repos",))
def days(t):
    return t("repos").select("id", days_since("pushed_at", AS_OF).cast("string").alias("days"))


@query("h02_health", f"""
    with {SCORE_INPUT_SQL} select id, case when archived then 'ARCHIVED' when raw_days is null then 'UNKNOWN'
        when raw_days <= 7 then case when coalesce(release_days <= 14 and contributors_90d >= 3, false) then 'ACTIVE' else 'MAINTAINED' end
        when raw_days <= 30 then 'MAINTAINED' when raw_days <= 90 then 'SLOW' else 'STALE' end as status from scored""", ("repos", "activity_facts"))
def health(t):
    return scored(t).select("id", "health.status")


PUSH_SQL = f"case when {_AGE} is null then 'UNKNOWN' when {_AGE} <= 7 then 'ACTIVE' when {_AGE} <= 30 then 'MAINTAINED' when {_AGE} <= 90 then 'SLOW' else 'STALE' end"


@query("h03_push_health", f"select id, {PUSH_SQL} as status from repos", ("repos",))
def push_health(t):
    return t("repos").select("id", S.push_health("pushed_at", AS_OF).alias("status"))


@query("h04_refresh_interval", f"""
    select id, cast({INTERVAL_SQL} as bigint) as days, cast(case coalesce(health_status, 'UNKNOWN') when 'SLOW' then 2 else 9 end as bigint) as custom from repos""", ("repos",))
def refresh_interval(t):
    return t("repos").select(
        "id", S.refresh_interval("health_status").cast("bigint").alias("days"),
        S.refresh_interval("health_status", {"SLOW": 2, "STALE": 0, "UNKNOWN": 9}).cast("bigint").alias("custom"))


@query("h05_is_due", f"select id, {DUE_SQL} as due from repos", ("repos",))
def is_due(t):
    return t("repos").select("id", S.is_due("health_status", "collected_at", AS_OF).alias("due"))


@query("h06_split_due", f"select {DUE_SQL} as due, count(*) as n from repos group by 1", ("repos",))
def split_due(t):
    return refresh.with_due(nested(t("repos")), AS_OF).groupBy("due").agg(F.count("*").alias("n"))
