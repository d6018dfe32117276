"""Markdown, classification, scores, files: boundary values."""

import base64
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from shelfmark import constants as K
from shelfmark.functions import classify as C, clock, files, markdown as M, scoring as S
from shelfmark.operators import lists
from shelfmark.taxonomy import EXAMPLE, TaxonomyError, build

DOC = """before https://github.com/too/early
# Title
- [One](https://github.com/a/one) text
## Tools ##
plain https://github.com/B/Two and more
- [One again](https://github.com/a/one.git)
#### [Deep](https://github.com/c/three)
##### https://github.com/d/four
##
Not a line heading
### Empty

## Last
- [foreign](https://example.org/a/b)
- [self](https://github.com/me/list)
* [frag](https://github.com/e/five#readme)
see <https://github.com/f/six>."""


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([("l1", "me", "list", DOC), ("l2", "x", "y", "")], "list_id string, owner string, repo string, markdown string")


def test_heading_levels(docs):
    got = [(r["title"], r["level"]) for r in lists.heading_rows(docs).orderBy("pos").collect()]
    assert got[:3] == [("Title", 1), ("Tools ##", 4), ("[Deep](https://github.com/c/three)", 4)]
    assert ("Not a line heading", 2) in got  # blanks of a heading may span the line end
    sections = {r["title"]: r["level"] for r in lists.section_rows(docs).collect()}
    assert sections["Title"] == 2 and sections["Empty"] == 4
    assert docs.select(M.category_titles("markdown").alias("c")).first()["c"] == ["Title"]


def test_references_and_distinct(docs):
    refs = lists.references(docs).orderBy("gen", "pos").collect()
    assert [r["repo_id"] for r in refs if r["type"] == "link"] == [
        "github:a/one", "github:a/one", "github:c/three", "github:me/list", "github:e/five"]
    # Bare urls inside links count as seen; a sentence-ending dot stays in the name only without brackets.
    assert [r["repo_id"] for r in refs if r["type"] == "raw_url"] == ["github:too/early", "github:b/two", "github:d/four", "github:f/six"]
    firsts = {r["repo_id"]: (r["name"], r["source"]) for r in lists.distinct_repositories(docs).collect()}
    assert firsts["github:a/one"] == ("One", "link") and firsts["github:c/three"][1] == "raw_url"


def test_sectioned_repositories(docs):
    rows = lists.sectioned_repositories(docs).orderBy("section_no", "line_no").collect()
    assert [(r["section"], r["name"], r["url"]) for r in rows] == [
        ("Title", "One", "github:a/one"), ("Tools ##", "https://github.com/B/Two", "github:b/two"), ("Tools ##", "One again", "github:a/one"),
        ("Tools ##", "#### [Deep", "github:c/three"), ("Empty", None, None),
        ("Last", "self", "github:me/list"), ("Last", "frag", "github:e/five"), ("Last", "https://github.com/f/six", "github:f/six")]


def test_members_and_sections(docs):
    got = {r["repo_id"]: r["section"] for r in lists.list_members(docs).collect()}
    assert "github:me/list" not in got
    assert got["github:a/one"] == "Title" and got["github:b/two"] == "Tools ##" and got["github:e/five"] == "Last"
    assert got["github:too/early"] == "" and got["github:c/three"] == ""  # only a heading line mentions the last one


def test_sections_of_a_long_list_take_one_pass(spark):
    """Names and their lengths are computed once a text, not once for every piece of it."""
    lines = [line for i in range(800) for line in ([f"## S{i // 100}"] if i % 100 == 0 else []) + [f"- [t{i}](https://github.com/o{i}/{'n' * (i % 30)}{i})"]]
    doc = spark.createDataFrame([("l", "\n".join(lines))], "list_id string, markdown string")
    started = time.monotonic()
    got = {r["name"]: r["section"] for r in lists.mention_sections(doc).collect()}
    assert time.monotonic() - started < 15
    assert all(got[f"{'n' * (i % 30)}{i}"] == f"S{i // 100}" for i in range(100, 800))


def test_sections_equal_brute_force(spark):
    """The hash-set search against a plain double loop."""
    rnd = random.Random(5)
    names = ["ab", "abc", "b-c", "x.y", "lib"]
    texts = []
    for i in range(40):
        lines = []
        for _ in range(rnd.randint(0, 15)):
            kind = rnd.random()
            n = rnd.choice(names)
            lines.append(f"## S{rnd.randint(0, 9)}" if kind < .25 else f"- [t](https://github.com/o{rnd.randint(0, 2)}/{n})" if kind < .7
                         else f"path /{n.upper()} here" if kind < .85 else "noise")
        texts.append((f"d{i}", "\n".join(lines)))
    expected = {}
    for doc, text in texts:
        ids = {f"github:{o}/{n}".lower() for o, n in re.findall(r"https://github\.com/([\w.-]+)/([\w.-]+)", text)}
        for rid in ids:
            section = ""
            for line in text.split("\n"):
                head = re.match(r"^#{1,6}\s+(.+)$", line)
                if head:
                    section = head.group(1)
                elif "/" + rid.split("/")[1] in line.lower():
                    expected[doc, rid] = section
                    break
    df = spark.createDataFrame(texts, "list_id string, markdown string")
    refs = lists.references(df).select("list_id", "repo_id").distinct()
    got = {(r["list_id"], r["repo_id"]): r["section"] for r in lists.infer_sections(df, refs).collect() if r["section"] is not None}
    assert got == expected


def test_readme_quality(spark):
    text = "[Toc]: #a\n![b](c)\n| a | b |\n```\n" + "word " * 50
    rows = spark.createDataFrame([(1, text), (2, ""), (3, "w " * 20)], "i int, t string")
    got = {r["i"]: r["q"] for r in rows.select("i", M.readme_quality("t").alias("q")).collect()}
    assert got[1]["quality_score"] == 100 and got[2]["word_count"] == 0 and got[3]["quality_score"] == 15


def test_clean_heading_and_category(one):
    assert one(C.clean_heading, "[x] Data 🔐 Tools") == "x Data Tools"
    assert one(C.clean_heading, "  -- Go: --  ") == "Go:"
    assert one(C.clean_heading, None, kinds=["string"]) == ""
    category = lambda c: C.heading_category(c, EXAMPLE)
    assert one(category, "## rust") == "Rust"
    assert one(category, "测试 tools") == "Testing"
    assert one(category, "Database stuff") == "Stores"
    assert one(category, "Data Systems") is None and one(category, "Contents") is None and one(category, "") is None


def _matches(word: str, text: str) -> bool:
    edge = "(?<![a-z0-9]){}(?![a-z0-9])" if word.isascii() else "{}"
    return re.search(edge.format(re.escape(word)), text) is not None


def test_keyword_index_equals_one_test_a_word(spark):
    """Signs at edges, other scripts, several runs, blanks: looked up or tried for each leaf, the rows are the same."""
    rnd = random.Random(11)
    signs, letters, wide = "+#.-*/ ", "abc1", "éß测试ж🔐"
    make = lambda chars, lo, hi: "".join(rnd.choice(chars) for _ in range(rnd.randint(lo, hi)))
    words = {f"leaf{i}": sorted({make(signs + letters + (wide if i % 3 == 0 else ""), 1, 4).lower() for _ in range(6)}) for i in range(60)}
    words["fixed"] = ["c++", ".net", "c#", "++", "a b", "测试", "\\e", "$1", "^a$", "[b]"]
    tax = build({"taxonomy": {"All": list(words)}, "keywords": words})
    texts = [make(signs + letters * 2 + wide, 0, 14) for _ in range(400)]
    texts += ["C++ and ASP.NET", "a .net b", "xc++", "c++x", "c+++", "a测试b", "", None, "\\E", "$1", "^a$ [b]", "++", "a  b", "🔐🔐"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    looked, tried = (rows.select("i", C.by_keywords(F.col("t"), tax, few=few).alias("c")).collect() for few in (0, 10**6))
    expected = {i: [leaf for leaf in tax.leaves if any(_matches(w, (t or "").lower()) for w in tax.keywords[leaf])] for i, t in enumerate(texts)}
    assert {r["i"]: r["c"] for r in looked} == expected
    assert {r["i"]: r["c"] for r in tried} == expected


def test_classify_order_limit_and_edges(spark):
    rows = spark.createDataFrame([
        (1, "a terminal database", ["fuzzing", "security"], "n", "Python"),
        (2, "databases interminals", [], "goes", None),
        (3, None, None, None, " C++ "),
        (4, "database event stream workflow engine terminal fuzzing hardening", ["sql"], "x", "go"),
    ], "i int, d string, t array<string>, n string, l string")
    got = {r["i"]: r["c"] for r in rows.select("i", C.classify("d", "t", "n", "l", EXAMPLE).alias("c")).collect()}
    assert got[1] == ["Testing", "Hardening", "Python", "Stores", "CLI"]
    assert got[2] == [] and got[3] == ["C++"]
    assert len(got[4]) == K.MAX_CATEGORIES and got[4][:2] == ["Stores", "Go"]
    assert all(set(c) <= set(EXAMPLE.leaves) for c in got.values())


@pytest.mark.parametrize("config", [
    {}, {"taxonomy": []}, {"taxonomy": {"A": []}}, {"taxonomy": {"A": ["x"], "B": ["x"]}}, {"taxonomy": {"A": ["B"], "B": ["x"]}},
    {"taxonomy": {"A": ["x"]}, "keywords": {"y": ["z"]}}, {"taxonomy": {"A": ["x"]}, "topics": ["z"]}, {"taxonomy": {"A": "x"}},
])
def test_taxonomy_rejects(config):
    with pytest.raises(TaxonomyError):
        build(config)


def test_taxonomy_lookups():
    tax = build({"taxonomy": {"A": [" x ", "", "y"], "B": ["z"]}, "keywords": {"x": None}})
    assert tax.leaves == ["x", "y", "z"] and tax.keywords == {}
    assert tax.leaves_for("all") is None and tax.leaves_for(None) is None
    assert tax.leaves_for("A") == ["x", "y"] and tax.leaves_for("Z") == ["z"] and tax.leaves_for("nope") == []
    # A parent that turns up as a leaf only later in the file is accepted.
    assert build({"taxonomy": {"A": ["x"], "B": ["A"]}}).parent_of("A") == "B"


def test_days_since_floors(one):
    days = lambda c: clock.days_since(c, "2026-11-01 00:00:00")
    assert one(days, "2026-10-31 00:00:01", kinds=["timestamp"]) == 0
    assert one(days, "2026-10-31 00:00:00", kinds=["timestamp"]) == 1
    assert one(days, "2026-11-01 00:00:01", kinds=["timestamp"]) == -1
    assert one(lambda c: clock.days_since(clock.parse(c), "2026-11-01"), "junk") is None
    assert one(lambda c: clock.days_since(clock.parse(c), "2026-11-01"), "2026-10-30T00:00:00Z") == 2


@pytest.mark.parametrize("stars, forks, people, expected", [
    (0, 10_000, 20, 0.0), (None, 5, 5, 0.0), (100_000, 10_000, 20, 100.0), (10**9, 10**9, 10**9, 100.0), (6, 0, 0, 0.0), (125, 0, 0, 0.1), (124, 0, 0, 0.0),
])
def test_popularity(one, stars, forks, people, expected):
    assert one(lambda a, b, c: S.points(S.popularity(a, b, c)), stars, forks, people, kinds=["bigint"] * 3) == expected


def test_activity_maintenance_community(one):
    act = lambda d, c, r: S.points(S.activity(d, c, r))
    assert one(act, 0, 0, 9) == 0.0 and one(act, 7, 10, 5) == 100.0 and one(act, 999, 0, 0) == 17.0 and one(act, 31, 3, 2) == 62.0
    maint = lambda a, b, r, d: S.points(S.maintenance(a, b, r, d))
    assert one(maint, True, True, None, 7, kinds=[None, None, "bigint", None]) == 82.5
    assert one(maint, False, False, 31, 91) == 10.0
    comm = lambda p, f, i: S.points(S.community(p, f, i))
    assert one(comm, 20, 1000, 0) == 100.0 and one(comm, 0, 0, 501) == 6.0 and one(comm, 0, 0, 10) == 27.0


def test_license_security_quality(one):
    lic = lambda k: S.points(S.license_points(k))
    assert [one(lic, k, kinds=["string"]) for k in (None, "", "MIT", "gpl-3.0", "agpl-3.0", "limited", "custom")] == [0, 0, 100, 50, 50, 100, 25]
    quality = lambda has, is_list, cats: S.points(S.list_quality(has, is_list, cats))
    three = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    assert one(lambda: quality(F.lit(False), F.lit(True), three)) == 50.0
    assert one(lambda: quality(F.lit(True), F.lit(True), three)) == 100.0
    assert one(lambda: quality(F.lit(True), F.lit(None).cast("boolean"), F.lit(None).cast("array<string>"))) == 50.0


def test_security_flags(spark):
    rows = spark.createDataFrame([("Trivy-x", None, ["Security"]), ("x", "runs NPM Audit", ["securityx"]), (None, None, None)], "n string, d string, t array<string>")
    got = [tuple(r["f"]) for r in rows.select(S.security_flags("n", "d", "t").alias("f")).collect()]
    assert got == [(True, True, False, False), (False, True, False, False), (False, False, False, False)]


@pytest.mark.parametrize("days, release, people, archived, expected", [
    (0, 14, 3, False, "ACTIVE"), (7, 15, 3, False, "MAINTAINED"), (7, 14, 2, False, "MAINTAINED"), (7, None, None, False, "MAINTAINED"), (8, 1, 9, False, "MAINTAINED"),
    (30, 0, 9, False, "MAINTAINED"), (31, 0, 9, False, "SLOW"), (90, 0, 9, False, "SLOW"), (91, 0, 9, False, "STALE"), (None, 0, 9, False, "UNKNOWN"), (0, 0, 9, True, "ARCHIVED"),
])
def test_health(one, days, release, people, archived, expected):
    assert one(S.health_status, days, release, people, archived, kinds=["bigint", "bigint", "bigint", "boolean"]) == expected


@pytest.mark.parametrize("status, collected, due", [
    ("ACTIVE", "2026-10-31", True), ("ACTIVE", "2026-10-31 00:00:01", False), ("MAINTAINED", "2026-10-29", True), ("MAINTAINED", "2026-10-30", False),
    ("SLOW", "2026-10-25", True), ("STALE", "2026-10-03", False), ("ARCHIVED", "2026-08-03", True), ("ARCHIVED", "2026-08-04", False), (None, "2026-10-18", True),
    ("WEIRD", "2026-10-19", False), ("ACTIVE", None, True), ("", "2026-10-19", False),
])
def test_due(one, status, collected, due):
    assert one(lambda s, c: S.is_due(s, c, "2026-11-01"), status, collected, kinds=["string", "timestamp"]) is due


def test_base64_and_caps(one):
    enc = lambda b: base64.b64encode(b).decode()
    assert one(files.decode_base64, enc("héllo".encode())) == "héllo"
    assert one(files.decode_base64, enc(b"a\xffb")) == "a�b"
    assert one(files.decode_base64, "a") == "" and one(files.decode_base64, None, kinds=["string"]) == ""
    assert one(files.decode_base64, "aGVs\nbG8=") == "hello"
    cut = one(lambda c: files.capped_text(c, 2), "aé")
    assert tuple(cut) == ("a�", 4, True)
    assert tuple(one(lambda c: files.capped_text(c, 3), "aé")) == ("aé", 3, False)
