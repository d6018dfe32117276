"""Repository-shaped views over the driver tables, in SQL that both engines run.

``d`` supplies the few spellings that differ. String casts use ``string``.
"""

from .registry import view

AS_OF = "2001-08-02 00:00:00"
AS_OF_S = 996710400
FACTS_AS_OF = "2024-01-31 00:00:00"
FACTS_AS_OF_S = 1706659200
DATE1, DATE2, DIFF_AS_OF, DIFF_AS_OF_S = "2024-01-10", "2024-01-20", "2024-01-21 00:00:00", 1705795200


def rid(k: str) -> str:
    return f"'github:own' || cast({k} % 997 as string) || '/order-' || cast({k} as string)"


def _facts(d, k: str) -> str:
    """Columns that depend on a record number only."""
    return f"""
        case {k} % 7 when 1 then 'tiny' when 2 then 'A red bolt and RING toolkit' when 3 then 'Awesome list of widgets'
            when 4 then 'Rodent plating machines' when 5 then 'Cold anvil, hot gizmo: semgrep rules'
            when 6 then 'Buy now the free gear-box' end as description,
        case when {k} % 29 = 0 then null else cast(floor(o_totalprice) as bigint) end as stars,
        cast({k} % 12000 as bigint) as forks, cast({k} % 700 as bigint) as issues,
        case {k} % 6 when 0 then 'Python' when 1 then 'rust' when 2 then ' Go ' when 3 then 'HTML' when 4 then 'Fortran' end as language,
        {d.csv(f"case {k} % 5 when 0 then 'security,tools' when 1 then 'Dependabot,ring' when 2 then 'copilot,awesome-list' when 3 then 'gear,promo' else '' end")} as topics,
        case {k} % 5 when 0 then 'mit' when 1 then 'GPL-3.0-only' when 2 then 'apache-2.0' when 3 then 'custom' when 4 then '' end as license,
        o_orderstatus = 'P' as archived,
        {d.ts(f"800000000 + {k} * 60")} as created_at, {d.ts(f"900000000 + {k} * 60")} as updated_at,
        case when {k} % 31 = 0 then null when {k} % 3 = 0 then {d.ts(f"996710400 - ({k} % 120) * 86400 - ({k} % 11) * 1000")}
            else cast(o_orderdate as timestamp) end as pushed_at,
        case when {k} % 37 = 0 then null else {d.ts(f"996710400 - ({k} % 40) * 86400 - ({k} % 7) * 3600")} end as collected_at,
        case {k} % 8 when 0 then 'ACTIVE' when 1 then 'MAINTAINED' when 2 then 'SLOW' when 3 then 'STALE' when 4 then 'ARCHIVED'
            when 5 then 'UNKNOWN' when 6 then 'WEIRD' end as health_status,
        case when {k} % 17 = 0 then null else cast(({k} * 7) % 1001 as double) / cast(10 as double) end as score_overall,
        cast({k} as bigint) as seq"""


@view("repos")
def repos(d):
    k = "o_orderkey"
    return f"""select {rid(k)} as id, 'own' || cast({k} % 997 as string) as owner, 'order-' || cast({k} as string) as name,
        'https://github.com/own' || cast({k} % 997 as string) || '/order-' || cast({k} as string) as url, {_facts(d, k)}
        from orders"""


@view("raw")
def raw(d):
    """Records with duplicates; one repository holds a third of all rows."""
    k = "o_orderkey"
    return f"""select 'github:x' as id, case when {k} % 3 = 0 then ' Big' else 'Own' || cast({k} % 2 as string) end as owner,
        case when {k} % 3 = 0 then 'Hot ' else 'Repo-' || cast({k} % 211 as string) end as name, 'u' as url,
        'github:lists/l' || cast({k} % 13 as string) as source_repository, o_orderpriority as source_section, {_facts(d, k)}
        from orders"""


@view("raw_ids", "raw")
def raw_ids(d):
    return "select lower(trim(owner)) as low_owner, lower(trim(name)) as low_name, 'github:' || lower(trim(owner)) || '/' || lower(trim(name)) as rid, raw.* from raw"


@view("hits_flat")
def hits_flat(d):
    """Search hits; rows with equal ``seq`` are equal in every column."""
    seq = "((l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey) * 100000 + l_suppkey"
    return f"""select {seq} as seq, case when l_linenumber % 2 = 0 then 'topic' else 'search_pattern' end as source,
        case l_linenumber % 3 when 0 then 'awesome' when 1 then 'awesome-list' else 'awesome-*' end as query,
        case when l_suppkey % 50 = 0 then '' else 'Supp' || cast(l_suppkey as string) end as owner,
        case l_partkey % 9 when 0 then 'Awesome-P' when 1 then 'my-awesome-P' when 2 then null else 'Part' end || cast(l_partkey % 300 as string) as name,
        case when l_partkey % 4 = 0 then null else 'https://github.com/s' || cast(l_suppkey as string) || '/p' || cast(l_partkey as string) end as html_url,
        case l_partkey % 6 when 0 then 'An Awesome List of gears' when 1 then 'awesome repository' when 2 then null else 'cold plate ' || cast(l_partkey % 10 as string) end as description,
        cast(l_partkey * 3 % 5000 as bigint) as stars,
        case when l_partkey % 3 = 0 then null else cast(l_partkey % 77 as bigint) end as forks_count, cast(l_partkey % 55 as bigint) as forks,
        cast(l_partkey % 33 as bigint) as issues, case l_partkey % 3 when 0 then 'Python' when 1 then 'Go' end as language,
        {d.csv("case l_partkey % 5 when 0 then 'awesome-list,ring' when 1 then 'Awesome-List' when 2 then 'resources,awesome,gear' else '' end")} as topics,
        case l_partkey % 4 when 0 then 'mit' when 1 then 'gpl-3.0' end as license,
        case when l_partkey % 7 = 0 then null else l_partkey % 2 = 0 end as archived
        from lineitem"""


@view("partrepos")
def partrepos(d):
    k = "p_partkey"
    sep = f"case {k} % 3 when 0 then '_' when 1 then '.' else '-' end"
    return f"""select 'github:' || lower(replace(p_brand, '#', '-')) || '/part-' || cast({k} as string) as id,
        lower(replace(p_brand, '#', '-')) as owner,
        replace(p_name, ' ', {sep}) || case when {k} % 4 = 0 then '' else '-' || cast({k} % 500 as string) end as name,
        case when {k} % 10 = 0 then null else 'The ' || p_name || ' of ' || p_type || case when {k} % 6 = 0 then ' toolkit' else 'ish' end end as description,
        case {k} % 9 when 0 then 'Python' when 1 then ' RUST' when 2 then 'go' when 3 then 'html' when 4 then 'C++' when 5 then 'cpp' when 6 then 'Java' when 7 then '' end as language,
        {d.arr("lower(p_type)", f"'t' || cast({k} % 5 as string)")} as topics,
        case when {k} % 23 = 0 then null else cast(p_size as bigint) * 10 end as stars,
        {d.arr("replace(p_brand, '#', '__')", "case when " + k + " % 5 = 0 then ' ' else p_type end")} as package_names,
        cast({k} as bigint) as seq
        from part"""


@view("assigned")
def assigned(d):
    """Categories given to records, with parents; one leaf has none."""
    return f"""select {rid("l_orderkey")} as repository_id,
        case l_partkey % 8 when 0 then 'Rings' when 1 then 'Bolts' when 2 then 'Rods' when 3 then 'Gears' when 4 then 'Plates'
            when 5 then 'Anvils' when 6 then 'Cold Work' else 'Loose' end as category,
        case l_partkey % 8 when 0 then 'Fasteners' when 1 then 'Fasteners' when 2 then 'Fasteners' when 3 then 'Machines' when 4 then 'Machines'
            when 5 then 'Workshop' when 6 then 'Workshop' end as parent, l_orderkey as seq
        from lineitem"""


@view("bridge", "assigned")
def bridge(d):
    return "select distinct repository_id, category from assigned"


@view("categories", "assigned")
def categories(d):
    return """select distinct category as name, parent from assigned
        union select distinct parent as name, cast(null as string) as parent from assigned where parent is not null"""


@view("provenance")
def provenance(d):
    return f"""select {rid("l_orderkey")} as repository_id, 'github:lists/s' || cast(l_suppkey as string) as source_repository,
        l_returnflag as source_section from lineitem"""


@view("snapshots")
def snapshots(d):
    e = "max(event_id)"
    return f"""select 'github:users/u' || cast(user_id as string) as id, cast(cast(ts as date) as string) as date, 'User ' || cast(user_id as string) as name,
        case when {e} % 19 = 0 then null else count(*) * 300 end as stars, cast({e} % 50 as bigint) as forks,
        cast(sum(case when event_type = 'error' then 1 else 0 end) as bigint) as issues, max(event_type) as language,
        case when {e} % 5 = 0 then null else min(event_type) end as description,
        case {e} % 3 when 0 then 'mit' when 1 then 'isc' end as license,
        {d.csv(f"case {e} % 4 when 0 then 'a,b' when 1 then 'b,a' when 2 then 'a' else '' end")} as topics,
        {e} % 11 = 0 as archived,
        case when {e} % 13 = 0 then null else {d.ts(f"1704067200 + day(cast(ts as date)) * 86400 - ({e} % 400) * 86400")} end as pushed_at,
        {d.ts(f"1704067200 + ({e} % 3) * 86400")} as updated_at,
        case {e} % 6 when 0 then 'STALE' when 1 then 'ACTIVE' when 2 then 'ARCHIVED' when 3 then 'SLOW' when 4 then '' end as health_status,
        cast({e} % 900 as double) / cast(10 as double) as score_overall
        from events group by user_id, cast(ts as date)"""


@view("activity_facts")
def activity_facts(d):
    return f"""select {rid("user_id")} as id,
        case event_type when 'view' then 'commit' when 'click' then 'commit' when 'purchase' then 'release' else 'contributor' end as kind,
        cast(ts as timestamp) as ts, 'p' || cast(event_id % 17 as string) as who from events"""


@view("url_rows")
def url_rows(d):
    k = "o_orderkey"
    o, n = f"'Own' || cast({k} % 97 as string)", f"'Repo.' || cast({k} as string)"
    forms = [
        f"'https://github.com/' || {o} || '/' || {n}", f"'https://github.com/' || {o} || '/' || {n} || '/'",
        f"'https://github.com/' || {o} || '/' || {n} || '.git'", f"'git@github.com:' || {o} || '/' || {n} || '.git'",
        f"'git@ssh.github.com:/' || {o} || '/' || {n}", f"'git://github.com/' || {o} || '/' || {n} || '.git'",
        f"'https://www.github.com/' || {o} || '/' || {n} || '?tab=readme'", f"'https://gitlab.com/' || {o} || '/' || {n}",
        "cast(null as string)", "''", f"'https://github.com/' || {o}",
        f"'https://github.com/' || {o} || '/' || {n} || '/tree/main#top'", f"'  https://github.com/' || {o} || '/' || {n} || '.git/ '",
        f"'http://github.com/' || {o} || '/awesome-' || {n} || '.git'", f"'github:' || {o} || '/' || {n}",
        f"'git@github.com:' || {o} || '/my-awesome-' || {n}", f"'https://github.com/' || {o} || '/really-awesome-' || {n} || '/x'",
    ]
    cases = " ".join(f"when {i} then {form}" for i, form in enumerate(forms))
    return f"""select cast({k} as bigint) as n, cast({k} % {len(forms)} as bigint) as form, case {k} % {len(forms)} {cases} end as url from orders
        union all select cast(-1 - page_id as bigint) as n, cast(-1 as bigint) as form, url from pages"""


# A list holds the parts of one brand among a thousand, so lists grow in number, not in size.
_LIST = "lower(replace(p_brand, '#', '-')) || '-' || cast(cast(floor(p_partkey / 1000) as bigint) as string)"


@view("md_lines")
def md_lines(d):
    k = "p_partkey"
    brand = _LIST
    slug = f"replace(p_name, ' ', '-') || '-' || cast({k} % 40 as string)"
    label = f"p_name || ' ' || cast({k} as string)"
    lines = [
        f"'- [' || {label} || '](https://github.com/' || {brand} || '/' || {slug} || ') - a part'",
        f"'See https://github.com/Bare/' || {slug} || ' and /' || {slug}",
        f"'* <https://github.com/angle/' || {slug} || '> in brackets'",
        f"'- [' || {label} || '](https://github.com/' || {brand} || '/' || {slug} || '.git)'",
        f"'  - [' || {label} || '](https://github.com/Frag/' || {slug} || '#readme) text'",
        f"'- [' || {label} || '](https://github.com/deep/' || {slug} || '/tree/main/src)'",
        f"'- [' || {label} || '](https://example.org/' || {slug} || ')'",
        f"'#### [' || {label} || '](https://github.com/h4/' || {slug} || ')'",
        f"'##### https://github.com/h5/' || {slug}",
        f"'- [self](https://github.com/lists/' || {brand} || ') or [short](github:short/' || {slug} || ')'",
        f"'| ' || {label} || ' | HTTPS://GITHUB.COM/Upper/' || {slug} || ' |'",
    ]
    cases = " ".join(f"when {i} then {line}" for i, line in enumerate(lines))
    head = "case p_type when 'PROMO' then '### ' when 'SMALL' then '##### ' else '## ' end"
    title = "case p_type when 'ECONOMY' then '[Gears] **Best**' when 'LARGE' then 'Fasteners' when 'MEDIUM' then 'rods' when 'PROMO' then 'Red Bolt corner' else p_type end"
    return f"""select {brand} as list_id, p_type as part, cast({k} + 1 as bigint) as pos, case {k} % {len(lines)} {cases} end as line from part
        union all select distinct {brand}, p_type, cast(0 as bigint), {head} || {title} from part
        union all select distinct {brand}, '', cast(0 as bigint), 'intro https://github.com/before/first' from part
        union all select distinct {brand}, '', cast(1 as bigint), '# List ' || {brand} from part"""


@view("lists_md", "md_lines")
def lists_md(d):
    return f"""select list_id, 'lists' as owner, list_id as repo, {d.joined("line", "part", "pos")} as markdown
        from md_lines group by list_id"""


@view("files_text")
def files_text(d):
    k = "doc_id"
    listing = f"case {k} % 7 when 0 then 'docs' when 1 then 'doc' when 2 then 'documentation' when 3 then 'wiki' when 4 then '' when 5 then 'docs' else 'src' end"
    name = (f"case {k} % 9 when 0 then 'a.md' when 1 then 'b.RST' when 2 then 'c.txt' when 3 then 'd.mdx' when 4 then 'OpenAPI.yaml' "
            f"when 5 then 'e.py' when 6 then 'swagger.json' when 7 then 'README.md' else 'f.md' end")
    path = f"cast({k} as string) || '/' || {name}"
    return f"""select 'github:docs/' || source as repository_id, {listing} as listing, cast({k} as bigint) as file_order,
        case when {k} % 13 = 0 then 'dir' else 'file' end as type, {name} as name, {path} as path,
        case when {k} % 3 = 0 then null else 'https://github.com/docs/' || source || '/' || cast({k} as string) end as html_url,
        case when {k} % 41 = 0 then '' else text end as text from documents
        union all select 'github:docs/' || source, 'readme', min(doc_id), 'file', 'README.md', 'docs/README.md', cast(null as string), min(text)
        from documents group by source"""


@view("doc_repos")
def doc_repos(d):
    return """select 'github:docs/' || source as id, cast(sum(n_chars) % 1000 as double) / cast(10 as double) as score_overall from documents group by source
        union all select 'github:empty/' || lang, cast(50 as double) from documents group by lang
        union all select 'broken-' || lang, cast(60 as double) from documents group by lang"""


@view("advisories")
def advisories(d):
    """One advisory per part, in the flat form of all three feeds."""
    k = "p_partkey"
    return f"""select cast({k} as bigint) as seq, replace(p_name, ' ', '-') || case when {k} % 2 = 0 then '' else '-' || cast({k} % 700 as string) end as package,
        case when {k} % 4 = 0 then 'PyPI' end as ecosystem, 'GHSA-' || cast({k} % 300 as string) as osv_id,
        case when {k} % 7 = 0 then null else 'Flaw in ' || p_name end as summary,
        case when {k} % 3 = 0 then '' else '7.' || cast({k} % 10 as string) end as score1,
        case when {k} % 5 = 0 then null else '5.' || cast({k} % 10 as string) end as score2,
        case when {k} % 2 = 0 then 'HIGH' end as db_severity,
        'cve-2024-' || cast({k} as string) as alias1, 'XX-' || cast({k} as string) as alias2,
        case when {k} % 6 = 0 then '' else 'CVE-2023-' || cast({k} % 900 as string) end as cve_id,
        case {k} % 3 when 0 then 'Unknown Thing' when 1 then upper(p_name) else '' end as product,
        case {k} % 4 when 0 then p_brand when 1 then replace(p_name, ' ', '_') else 'Nobody' end as vendor,
        '2024-01-' || cast(10 + {k} % 20 as string) as date_added
        from part"""


@view("docs_md")
def docs_md(d):
    """Documents with Markdown structure added to some."""
    k = "doc_id"
    return f"""select doc_id, case when {k} % 3 = 0 then '[![b](x)](y) ' else '' end || text || case when {k} % 4 = 0 then chr(10) || '| a | b |' else '' end
        || case when {k} % 5 = 0 then chr(10) || '```' else '' end || case when {k} % 6 = 0 then chr(10) || '[Toc]: #part' else '' end as text from documents"""


@view("headings")
def headings(d):
    """Decorated headings made of part words, with the fields classification reads."""
    k = "p_partkey"
    shapes = [
        "'## ' || p_name", "'[Rings]'", "'**cold work**'", "'  -- Bolts: --  '", "'Fasteners'", "'Machines 🔐'", "''", "cast(null as string)",
        "'(' || upper(p_name) || ') → more'", "p_type", "'workshop'", "'Workshop'", "'Red Bolt | corner'",
    ]
    cases = " ".join(f"when {i} then {s}" for i, s in enumerate(shapes))
    return f"""select cast({k} as bigint) as n, case {k} % {len(shapes)} {cases} end as heading, 'The ' || p_name as description,
        {d.arr("lower(p_type)")} as topics, p_brand as name, case when {k} % 2 = 0 then 'go' end as language from part"""


@view("member_facts")
def member_facts(d):
    """Catalog facts of list members, keyed by their id."""
    k = "p_partkey"
    return f"""select 'github:' || {_LIST} || '/' || replace(p_name, ' ', '-') || '-' || cast({k} % 40 as string) as id,
        max('The ' || p_name || ' toolkit') as description, cast(sum(p_size) as bigint) as stars from part group by 1"""
