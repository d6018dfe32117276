"""Keyed tables, ranking, diff, findings, content, ingest: invariants and hot groups."""

import random

import pytest
from pyspark.sql import functions as F

from shelfmark import constants as K
from shelfmark.operators import catalog, content, diff, discover, findings, keyed, ranking, records, refresh, reports
from shelfmark.plans import collect, publish
from shelfmark.schemas import REPOSITORY, SEARCH_HIT
from shelfmark.sources import tables
from shelfmark.taxonomy import EXAMPLE


def test_upsert_is_idempotent_and_latest_wins(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    new = spark.createDataFrame([("b", 5, 1), ("b", 6, 2), ("c", 7, 1)], "id string, v int, seq bigint")
    once = keyed.upsert(old, new, ["id"])
    twice = keyed.upsert(once, new, ["id"])
    expected = {("a", 1), ("b", 6), ("c", 7)}
    assert {tuple(r) for r in once.collect()} == {tuple(r) for r in twice.collect()} == expected


def test_finding_conflict_keeps_first_url(spark):
    cols = "source string, advisory_id string, package string, repository_id string, ecosystem string, severity string, summary string, url string, cve_ids array<string>, observed_at timestamp"
    old = spark.createDataFrame([("osv", "A", "p", None, "e", "LOW", "s", "u1", ["c"], None)], cols)
    new = spark.createDataFrame([("osv", "A", "p", "", "x", "HIGH", "t", "u2", [], None, 1)], cols + ", seq bigint")
    row = keyed.upsert_findings(old, new).collect()
    assert len(row) == 1 and (row[0]["severity"], row[0]["summary"], row[0]["url"], row[0]["ecosystem"], row[0]["cve_ids"]) == ("HIGH", "t", "u1", "e", ["c"])


def test_category_rows_keep_first_parent(spark):
    rows = spark.createDataFrame([("r1", "x", "A", 1), ("r2", "x", "B", 2), ("r3", "A", "C", 3), ("r4", "y", None, 4), ("r5", "z", "z", 5)],
                                 "repository_id string, category string, parent string, seq bigint")
    got = {r["name"]: r["parent"] for r in keyed.category_rows(rows).collect()}
    assert got == {"x": "A", "A": None, "B": None, "C": None, "y": None, "z": None}


def test_category_rows_read_once_and_null_seq_first(spark):
    rnd = random.Random(3)
    rows = [(f"r{i}", rnd.choice(["x", "y", "z", "A", None]), rnd.choice(["A", "B", "x", "", None]), rnd.choice([None, 1, 2, 3])) for i in range(60)]
    shape = "repository_id string, category string, parent string, seq bigint"
    for given in [rows, *(rnd.sample(rows, 8) for _ in range(4))]:
        low = lambda v: (v is not None, v if v is not None else 0)
        found = {}
        for _, name, parent, seq in given:
            leaf = parent if parent and name is not None and parent != name else None
            for key, step, value in [(name, 1, leaf)] + ([(parent, 0, None)] if parent is not None else []):
                found.setdefault(key, []).append((low(seq), step, (value is not None, value or "")))
        expected = {key: min(all_)[2][1] or None for key, all_ in found.items()}
        got = keyed.category_rows(spark.createDataFrame(given, shape))
        assert {r["name"]: r["parent"] for r in got.collect()} == expected
    plan = keyed.category_rows(spark.createDataFrame(rows, shape))._jdf.queryExecution().executedPlan().toString()
    reading = plan[plan.rindex("Exchange hashpartitioning(category"):]
    assert plan.count("ExistingRDD") == 1 and "HashAggregate" in reading and "Sort" not in reading


def test_parents_are_looked_up_by_leaf(spark):
    from shelfmark.plans import collect

    one = spark.createDataFrame([("r", 1, ["Storage", "Python", "nobody", None, *EXAMPLE.leaves])], "id string, seq bigint, categories array<string>")
    got = collect.assigned_categories(one, EXAMPLE)
    assert [(r["category"], r["parent"]) for r in got.collect()] == [(c, EXAMPLE.leaf_parent.get(c)) for c in one.first()["categories"]]
    assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_upsert_ranks_nothing_for_the_keys(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "id string, v int")
    new = spark.createDataFrame([("a", 2, 1), ("a", 3, 2), ("c", 4, 1), (None, 5, 1)], "id string, v int, seq bigint")
    merged = keyed.upsert(old, new, ["id"])
    assert {tuple(r) for r in merged.collect()} == {("a", 3), ("b", 1), ("c", 4), (None, 5)} and merged.count() == 4
    assert merged._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1
    assert "Window" not in keyed.upsert(old, new, ["id"], once=True)._jdf.queryExecution().optimizedPlan().toString()


def test_hot_key_ships_one_row_per_task(spark):
    plan = keyed.first_per_key(spark.range(10).withColumn("k", F.col("id") % 2), ["k"], [F.asc("id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_large_groups_are_rows_like_small_ones(spark):
    pairs = [(i, f"list{j}", "s") for i in range(3) for j in range(400 if i == 0 else 3)]
    rows = spark.createDataFrame([(i, [{"repository": r, "section": s}]) for i, r, s in pairs + pairs[:5]], "id int, sources array<struct<repository:string,section:string>>")
    got = records.fold_sources(rows).collect()
    expected = {(i, n + 1, r, s) for i in range(3) for n, (_, r, s) in enumerate(sorted(p for p in pairs if p[0] == i))}
    assert {(r["id"], r["position"], r["repository"], r["section"]) for r in got} == expected and len(got) == len(pairs)


def test_ties_with_the_first_row_are_duplicates(spark):
    rows = spark.createDataFrame([("a", 1, 0), ("a", 1, None), ("a", 1, 0), ("a", 2, 0), ("b", 1, 0)], "id string, seq bigint, stars bigint")
    assert sorted(r["seq"] for r in records.duplicates(rows).collect()) == [1, 1, 2]
    assert records.dedupe(rows, ["stars"]).count() == 1  # null and zero are one key


def test_upsert_reads_the_stored_side_without_a_window(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    new = spark.createDataFrame([("b", 5, 1), ("b", 6, 2), ("c", 7, 1), (None, 8, 1)], "k string, v int, seq bigint")
    out = keyed.upsert(old, new, ["k"])
    assert {tuple(r) for r in out.collect()} == {("a", 1), ("b", 6), ("c", 7), (None, 8)}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Window ") <= 2  # only over incoming rows


def test_refresh_stamps_and_takes_one_fresh_row(spark):
    old = records.complete(spark.createDataFrame([("github:a/b", "a", "b", "old")], "id string, owner string, name string, url string"))
    fresh = records.complete(spark.createDataFrame([("github:a/b", 1, "2026-01-01"), ("github:a/b", 2, "2026-01-05")], "id string, stars bigint, day string").withColumn(
        "pushed_at", F.col("day").cast("timestamp")).drop("day"))
    got = refresh.merge(old, fresh, "2026-02-01 00:00:00").collect()
    assert [(r["stars"], r["url"], str(r["collected_at"])[:10]) for r in got] == [(2, "https://github.com/a/b", "2026-02-01")]
    assert refresh.report(old, fresh, "2026-02-01 00:00:00").first()["skipped"] == 0


def test_position_in_group_equals_window(spark):
    rnd = random.Random(3)
    rows = [(None if rnd.random() < .1 else "g" if rnd.random() < .7 else rnd.choice("abc"), rnd.randint(0, 4), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, id int")
    got = ranking.position_in_group(df, ["g"], [F.desc("v"), F.asc("id")], "pos").collect()
    groups = {}
    for g, v, i in rows:
        groups.setdefault(g, []).append((-v, i))
    expected = {i: n + 1 for items in groups.values() for n, (_, i) in enumerate(sorted(items))}
    assert {r["id"]: r["pos"] for r in got} == expected


def test_dedupe_and_duplicates_partition_the_rows(spark):
    df = spark.createDataFrame([(i, f"Own{i % 3}", f"N{i % 4}") for i in range(50)], "seq bigint, owner string, name string")
    rows = records.normalize(records.complete(df))
    kept, dropped = records.dedupe(rows), records.duplicates(rows)
    assert kept.count() == kept.select("id").distinct().count() == 12
    assert kept.select("seq").union(dropped.select("seq")).distinct().count() == 50
    assert records.duplicate_counts(rows).agg(F.sum("duplicates")).first()[0] == 38


def _snap(spark, rows):
    cols = "id string, owner string, name string, url string, stars bigint, topics array<string>, archived boolean, pushed_at timestamp, health_status string, score_overall double, seq bigint"
    return spark.createDataFrame(rows, cols)


def test_diff_kinds(spark):
    from datetime import datetime

    base = lambda i, stars=1, topics=("a",), archived=False, pushed=datetime(2026, 10, 30), status="ACTIVE", seq=0: (
        i, "o", "n", "u", stars, list(topics), archived, pushed, status, 1.0, seq)
    old = _snap(spark, [base("same"), base("gain", None), base("gone"), base("topics"), base("twice", 1), base("twice", 5, seq=1)])
    new = _snap(spark, [base("same"), base("gain", 500), base("fresh", status="STALE"), base("topics", topics=("b",)), base("twice", 5, status="", archived=True),
                        base("old", pushed=datetime(2026, 1, 1)), base("edge", pushed=datetime(2026, 5, 5))])
    out = diff.changes(old, new, "2026-11-01", order="seq")
    by = {r["id"]: r for r in out.collect()}
    assert {i for i, r in by.items() if r["presence"] == "new"} == {"fresh", "old", "edge"}
    assert {i for i, r in by.items() if r["presence"] == "removed"} == {"gone"}
    assert {i for i, r in by.items() if r["is_trending"]} == {"gain"}
    assert {i: set(r["changes"]) for i, r in by.items() if r["is_updated"]} == {"gain": {"stars"}, "topics": {"topics"}, "twice": {"archived", "health_status"}}
    assert {i for i, r in by.items() if r["is_stale"]} == {"fresh", "old"}  # edge: exactly 180 days
    assert {i for i, r in by.items() if r["is_archived"]} == {"twice"}
    assert by["topics"]["changes"]["topics"]["from"] == '["a"]'
    snaps = old.withColumn("date", F.lit("d1"))
    with pytest.raises(ValueError):
        diff.between(snaps, "d1", "d2", "2026-11-01")


def test_stale_is_three_valued(spark):
    rows = spark.createDataFrame([
        ("null status", False, None, None), ("never", False, "STALE", None), ("archived", True, "STALE", None), ("edge", False, "SLOW", "2026-05-05 00:00:00"),
        ("over", False, "SLOW", "2026-05-04 23:59:59"), ("flag", False, "ARCHIVED", None)], "id string, archived boolean, health_status string, p string")
    df = rows.withColumn("pushed_at", F.col("p").cast("timestamp"))
    assert {r["id"] for r in catalog.stale(df, "2026-11-01").collect()} == {"never", "over"}


def _greedy(files, budget, per_listing):
    kept, used, count = [], 0, {}
    for listing, order, size in sorted(files):
        if count.get(listing, 0) < per_listing and used + size <= budget:
            kept.append((listing, order))
            used += size
            count[listing] = count.get(listing, 0) + 1
    return kept


@pytest.mark.parametrize("seed, budget, per_listing", [(1, 100, 3), (2, 1000, 10), (3, 37, 1), (4, 60, 50)])
def test_budget_equals_plain_greedy(spark, seed, budget, per_listing):
    rnd = random.Random(seed)
    repos = {f"r{i}": [(rnd.randint(0, 5), k, rnd.randint(1, 40)) for k in range(rnd.choice([1, 5, 400]))] for i in range(12)}
    rows = [(r, *f) for r, fs in repos.items() for f in fs]
    df = spark.createDataFrame(rows, "repository_id string, listing_no int, file_order bigint, bytes bigint")
    got = {}
    for r in content.within_budget(df, budget, per_listing).collect():
        got.setdefault(r["repository_id"], []).append((r["listing_no"], r["file_order"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(g) for k, f in repos.items() if (g := _greedy(f, budget, per_listing))}


def test_budget_of_many_distinct_sizes(spark):
    n = 100_000
    files = [(k % 6, k, 1 + (k * 7919) % n) for k in range(n)]  # every size once
    df = spark.createDataFrame([("big", *f) for f in files] + [("small", 0, 0, 5)], "repository_id string, listing_no int, file_order bigint, bytes bigint")
    kept = content.within_budget(df, 30_000_000, 150)
    assert "collect_list" not in kept._jdf.queryExecution().toString()
    got = sorted((r["listing_no"], r["file_order"]) for r in kept.filter("repository_id = 'big'").collect())
    assert got == sorted(_greedy(files, 30_000_000, 150)) and len(got) > 500
    assert kept.filter("repository_id = 'small'").count() == 1


def test_first_owner_and_vendor_only_match(spark):
    recs = spark.createDataFrame([("github:a/x", "X_Y", 1, 5), ("github:b/x", "x-y", 0, 5), ("github:c/v", "vend", 2, 5), ("github:d/z", "zz", 3, 0)], "id string, name string, seq bigint, stars bigint")
    owners = findings.package_owners(catalog.min_stars(recs, 1))
    assert {r["package"]: r["repository_id"] for r in owners.collect()} == {"x-y": "github:b/x", "vend": "github:c/v"}
    feed = spark.createDataFrame([([("CVE-1", "nobody", "x.y", "n", "d"), (None, "Vend", "other", None, "2024-01-01"), ("CVE-3", "no", "no", "n", "d"), ("CVE-4", "vend", "", "n", "d")],)],
                                 "vulnerabilities array<struct<cveID:string,vendorProject:string,product:string,vulnerabilityName:string,dateAdded:string>>")
    rows = findings.kev_rows(findings.kev_matches(findings.kev_entries(feed), owners), "2026-01-01")
    got = {r["advisory_id"]: (r["package"], r["repository_id"], r["cve_ids"]) for r in rows.collect()}
    assert got == {"CVE-1": ("x-y", "github:b/x", ["CVE-1"]), "2024-01-01": ("other", None, []), "CVE-4": ("vend", "github:c/v", ["CVE-4"])}


def test_refresh_limit_and_report(spark):
    rows = spark.createDataFrame([(f"github:o/r{i}", "STALE" if i % 2 else "ACTIVE", None if i == 3 else "2026-10-20") for i in range(6)], "id string, health_status string, c string")
    recs = records.from_flat(rows.select("id", "health_status", F.lit(1.0).alias("score_overall"), F.col("c").cast("timestamp").alias("collected_at")))
    due = refresh.select_due(recs, "2026-11-01", limit=2)
    assert [r["id"] for r in due.collect()] == ["github:o/r3", "github:o/r0"]
    fresh = records.complete(spark.createDataFrame([("github:o/r0",)], "id string"))
    assert refresh.report(recs, fresh, "2026-11-01", limit=2).first().asDict() == {"checked": 2, "updated": 1, "skipped": 4, "failed": 1, "due": 4}


def test_validation_messages(spark):
    df = spark.createDataFrame([("github:a/b", "a", "b", "u", "t"), (None, "a", "", "u", "t"), ("github:c/d", "c", "d", None, None)], "id string, owner string, name string, url string, collected_at string")
    assert records.validate(df).first().asDict() == {"total": 3, "valid": 1, "errors": 2}
    assert [r["message"] for r in records.validation_errors(df).collect()] == ["unknown: missing id, name", "github:c/d: missing url, collected_at"]


def test_search_names_and_caps(spark):
    df = spark.createDataFrame([(f"i{k}", n, k) for k, n in enumerate(["awesome", "Awesome-x", "an-awesome", "awesome-list"])], "id string, name string, stars bigint")
    got = {(r["query"], r["name"]) for r in discover.search_names(df).collect()}
    assert got == {("awesome", "awesome"), ("awesome-*", "Awesome-x"), ("awesome-*", "awesome-list"), ("awesome-list", "awesome-list")}
    capped = discover.cap_hits(discover.search_names(df), 1).collect()
    assert {(r["query"], r["name"]) for r in capped} == {("awesome", "awesome"), ("awesome-*", "awesome-list"), ("awesome-list", "awesome-list")}


def test_report_files_are_ordered(spark, tmp_path):
    rows = [(f"github:o/{i}", "o", str(i), "u", None, i % 3 * 10, None, float(i % 2), None, "L" if i else "P", "P") for i in range(200)]
    entries = reports.tree_entries(spark.createDataFrame(rows, "id string, owner string, name string, url string, description string, stars bigint, language string, score_overall double, health_status string, category string, parent string"))
    reports.write_lines(reports.sitemap_lines(entries, "now"), str(tmp_path / "map"))
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "map")).collect()]
    text = [line for f in sorted((tmp_path / "map").glob("part-*")) for line in f.read_text().splitlines()]
    assert len(lines) == len(text) == 205
    assert text[:4] == ["# Catalog tree", "Generated: now", "Records: 200", "## P"]
    body = [t for t in text if t.startswith("- [")]
    keys = [(-float(t.rsplit(" ", 1)[1]), -int(t.split(") - ")[1].split(" ")[0])) for t in body[:-1] if not t.startswith("- [o/0]")]
    assert keys == sorted(keys)


def _odd_placed(spark):
    """Placed records: one comes twice, one is in two leaves, one in a leaf of no known category; null and empty fields, no id."""
    flat = spark.createDataFrame([
        ("github:o/a", "o", "a", "u", "  some text ", 1234567, None, 1.5, None), ("github:o/a", "o", "a", "u", "  some text ", 1234567, None, 1.5, None),
        ("github:o/b", "o", "b", "u", "", None, "Go", None, "ACTIVE"), ("github:o/c", None, "c", "u", None, 1, None, 0.0, None), (None, "o", "d", "u", None, 5, None, 10.0, None),
    ], "id string, owner string, name string, url string, description string, stars bigint, language string, score_overall double, health_status string")
    bridge = spark.createDataFrame([("github:o/a", "Leaf"), ("github:o/b", "Leaf"), ("github:o/b", "Top"), ("github:o/c", "Gone"), (None, "Leaf"), ("github:o/b", None)], "repository_id string, category string")
    cats = spark.createDataFrame([("Leaf", "Top"), ("Top", "Top"), ("Unused", "Top")], "name string, parent string")
    return reports.tree_entries(catalog.placed(flat, bridge, cats))


def test_sitemap_places_its_entries_once(spark):
    entries = _odd_placed(spark)
    lines = reports.sitemap_lines(entries, "now")
    assert "Join" not in lines._jdf.queryExecution().executedPlan().toString()  # headings and entries are read from the store
    assert "Join" in entries._jdf.queryExecution().executedPlan().toString()
    a, b = "- [o/a](u) - 1,234,567 stargazers, points 1.5", "- [o/b](u) - 0 stargazers, points 0"
    none = "- [o/d](u) - 5 stargazers, points 10.0"
    got = [tuple(r) for r in lines.select("block", "parent", "leaf", "slot", "neg_score", "neg_stars", "id", "line").collect()]
    assert sorted(got, key=str) == sorted([
        (0, "", "", 0, 0.0, 0, "", "# Catalog tree"), (0, "", "", 1, 0.0, 0, "", "Generated: now"), (0, "", "", 2, 0.0, 0, "", "Records: 3"),
        (1, "Top", "", 0, 0.0, 0, "", "## Top"), (1, "Uncategorized", "", 0, 0.0, 0, "", "## Uncategorized"), (1, "Top", "Leaf", 1, 0.0, 0, "", "### Leaf"),
        *[(1, "Top", "Leaf", 2, -1.5, -1234567, "github:o/a", a)] * 2, (1, "Top", "Leaf", 2, 0.0, 0, "github:o/b", b), (1, "Top", "Top", 2, 0.0, 0, "github:o/b", b),
        (1, "Uncategorized", "Uncategorized", 2, 0.0, -1, "github:o/c", None), (1, "Uncategorized", "Uncategorized", 2, -10.0, -5, None, none)], key=str)
    empty = reports.sitemap_lines(entries.filter("false")).select("line").collect()
    assert [r["line"] for r in empty] == ["# Catalog tree", "Records: 0"]


def test_index_text_shuffles_its_entries_once(spark):
    entries = _odd_placed(spark)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        lines = reports.index_text_lines(entries)
        plan = lines._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    moved = [line.split("hashpartitioning(")[1].split(", ")[:-2] for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    keys = sorted(",".join(k.split("#")[0] for k in by if "#" in k) for by in moved)
    assert keys == ["id", "parent", "parent,category"]  # the total by id; headings are reduced to a row for each group before they move
    text = lambda name, about: f"- [o/{name}](u): {about}"
    assert sorted((r["parent"], r["leaf"], r["id"], r["line"]) for r in lines.filter("slot = 2 AND block = 1").collect() if r["id"] and r["line"]) == [
        ("Top", "Leaf", "github:o/a", text("a", "some text")), ("Top", "Leaf", "github:o/a", text("a", "some text")),
        ("Top", "Leaf", "github:o/b", text("b", "(no text)")), ("Top", "Top", "github:o/b", text("b", "(no text)"))]
    rest = [tuple(r) for r in lines.filter("slot < 2 OR block = 0 OR id IS NULL OR line IS NULL").select("parent", "leaf", "line").collect()]
    assert sorted(rest, key=str) == sorted([
        ("", "", "# Catalog lines"), ("", "", "> One line for each record."), ("", "", "Records: 3"), ("Top", "", "## Top"), ("Top", "Leaf", "### Leaf"),
        ("Uncategorized", "", "## Uncategorized"), ("Uncategorized", "Uncategorized", None), ("Uncategorized", "Uncategorized", text("d", "(no text)"))], key=str)


def test_publish_keeps_output_without_records(spark, tmp_path):
    flat = spark.createDataFrame([], "id string, owner string, name string, url string, description string, stars bigint, language string, score_overall double, health_status string")
    bridge = spark.createDataFrame([], "repository_id string, category string")
    cats = spark.createDataFrame([], "name string, parent string")
    assert publish.publish(flat, bridge, cats, str(tmp_path / "out"), "d") is False
    assert not (tmp_path / "out").exists()


def test_json_scan_skips_broken_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n"id": "github:a/b", "stars": 3, "nope": 1\n}')
    (tmp_path / "b.json").write_text("{broken")
    got = tables.read_records(spark, str(tmp_path)).collect()
    assert [(r["id"], r["stars"], r["archived"]) for r in got] == [("github:a/b", 3, False)]
    rejects = tables.read_rejects(spark, str(tmp_path), REPOSITORY, multi_line=True).collect()
    assert [r["_corrupt_record"] for r in rejects] == ["{broken"]


def test_content_store_lookup_reads_one_bucket(spark, tmp_path):
    docs = spark.createDataFrame([(f"github:o/{i}", "t") for i in range(50)], "repository_id string, content string")
    tables.write_content(docs, str(tmp_path / "c"))
    found = tables.read_content(spark, str(tmp_path / "c"), "github:o/7")
    assert [r["repository_id"] for r in found.collect()] == ["github:o/7"]
    assert "PartitionFilters: [isnotnull(bucket" in found._jdf.queryExecution().executedPlan().toString()


def test_snapshot_read_prunes_dates(spark, tmp_path):
    for date in ("2026-01-01", "2026-01-02"):
        tables.write_snapshot(spark.createDataFrame([(date + "x",)], "id string"), str(tmp_path / "s"), date)
    tables.write_snapshot(spark.createDataFrame([("again",)], "id string"), str(tmp_path / "s"), "2026-01-02")
    assert [r["id"] for r in tables.read_snapshot(spark, str(tmp_path / "s"), "2026-01-02").collect()] == ["again"]
    assert [r["date"] for r in tables.snapshot_dates(spark, str(tmp_path / "s")).collect()] == ["2026-01-01", "2026-01-02"]


def test_collect_filter_limits_saved_rows_only(spark):
    hit = lambda i, topics: (i, "s", "q", (f"n{i}", (f"o{i % 2}",), None, None, 1, None, 2, 3, None, topics, None, None, None, None, None))
    hits = spark.createDataFrame([hit(1, ["sql"]), hit(2, ["streaming"]), hit(3, None), hit(1, ["streaming"])], SEARCH_HIT)
    made = collect.collect(hits, EXAMPLE, "2026-01-01", "Stores")
    assert made["summary"].first().asDict() == {"collected": 3, "categorized": 2, "duplicates_merged": 0}
    assert [r["id"] for r in made["records"].collect()] == ["github:o1/n1"]
    assert {(r["name"], r["parent"]) for r in made["categories"].collect()} == {("Stores", "Data Systems"), ("Data Systems", None)}


def test_facts_meet_hits_where_they_were_deduplicated(spark, tmp_path):
    hit = lambda seq, owner, name, license: (seq, "s", "q", (name, (owner,), "elsewhere", None, 1, None, 2, 3, None, ["own"], (license,), None, None, None, None))
    hits = spark.createDataFrame([
        hit(2, "O", "N", "late"), hit(1, " o ", "n", "mit"), hit(3, "o/p", "q", None), hit(4, "o", "p/q", None), hit(5, None, "x", None), hit(6, "x", "", None), hit(7, "o", "z", None)], SEARCH_HIT)
    topics = spark.createDataFrame([("github:o/n", ["a"]), ("github:o/n", ["b"]), (None, ["c"]), ("github:gone/g", ["d"])], "id string, topics array<string>")
    licenses = spark.createDataFrame([("github:o/p/q", None, "spdx"), ("github:o/n", None, None)], "id string, key string, spdx_id string")
    counts = spark.createDataFrame([("github:o/z", 4)], "id string, contributors bigint")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        made = collect.collect(hits, EXAMPLE, "2026-01-01", facts=(topics, licenses, counts), staging=False)["records"]
        plan = made._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert plan.count("SortMergeJoin") == 3 and plan.count("Exchange hashpartitioning") == 4  # hits once, and each table of facts
    assert sorted((r["id"], r["seq"], r["owner"], r["name"], r["url"], r["topics"], r["license"]) for r in made.collect()) == [
        ("github:o/n", 1, "o", "n", "https://github.com/o/n", ["a"], "mit"), ("github:o/n", 1, "o", "n", "https://github.com/o/n", ["b"], "mit"),
        ("github:o/p/q", 3, "o/p", "q", "https://github.com/o/p/q", ["own"], "spdx"), ("github:o/z", 7, "o", "z", "https://github.com/o/z", ["own"], None)]
    collect.collect(hits, EXAMPLE, "2026-01-01", facts=(topics, licenses, counts), staging=str(tmp_path / "kept"))
    assert spark.read.parquet(str(tmp_path / "kept")).columns == [*REPOSITORY.fieldNames(), "seq", "categories"]  # no output reads source and query


def test_index_of_a_large_parent_is_written_by_many_tasks(spark, tmp_path):
    from pathlib import Path

    entries = spark.range(4000).selectExpr("if(id % 4 = 0, 'Small', 'Hot') AS parent", "'Leaf' AS category", "cast(id AS string) AS id", "cast(id % 97 AS double) AS score", "id % 13 AS stars")
    flat = entries.selectExpr("id", "'o' AS owner", "id AS name", "'u' AS url", "stars", "score AS score_overall", "'h' AS health_status")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        tables.write_index(entries, flat, str(tmp_path))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    for kind, leaf in (("members", "Leaf"), ("parents", None)):
        assert len(list(Path(tmp_path, kind, "parent=Hot").glob("*.parquet"))) > 2
        rows = tables.read_index(spark, str(tmp_path), "Hot", leaf).collect()
        assert sorted(r.position for r in rows) == list(range(1, 3001)) and len({r.id for r in rows}) == 3000


def _index_entries(spark, n):
    return spark.range(n).selectExpr("'P' AS parent", "if(id % 2 = 0, 'A', 'B') AS category", "cast(id div 2 AS string) AS id", "cast(id div 2 % 7 AS double) AS score", "id div 2 % 5 AS stars")


def test_index_makes_its_entries_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def seen(category):
        made.add(1)
        return category

    entries = _index_entries(spark, 400).withColumn("category", F.udf(seen, "string")("category"))
    flat = _index_entries(spark, 2).selectExpr("id", "'o' AS owner", "id AS name", "'u' AS url", "stars", "score AS score_overall", "'h' AS health_status")
    tables.write_index(entries, flat, str(tmp_path))
    assert made.value == 400
    assert sorted(r.position for r in tables.read_index(spark, str(tmp_path), "P", "B").collect()) == list(range(1, 201))


def test_index_lists_take_more_tasks_as_the_rows_grow(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SLICE_ROWS", 50)
    entries = _index_entries(spark, 2000)
    for made, n in ((tables.index_parents(entries), 1000), (tables.index_lists(entries), 2000)):
        assert made.rdd.getNumPartitions() >= 30 and made.count() == n
        assert "Exchange hashpartitioning" not in made._jdf.queryExecution().optimizedPlan().toString()


def test_flagged_rows_equal_full_comparison(spark):
    kinds = "id string, name string, stars bigint, forks bigint, topics array<string>, health_status string, archived boolean, pushed_at timestamp"
    time = "2026-01-01 00:00:00.000001"
    old = [("a", "n", 1, None, ["x"], None, False, None), ("b", "n", 1, 0, None, "STALE", False, None), ("c", "n", None, 0, [], "", True, None), ("d", "", 5, 5, ["p", "q"], "ACTIVE", None, None),
           ("e", None, 9, 9, None, None, None, None), ("gone", "n", 1, 1, None, None, None, None), ("f", "n", 1, 1, None, None, False, None)]
    new = [("a", "n", 1, 0, ["x"], None, False, None), ("b", "n", 1, 0, None, "STALE", False, None), ("c", "n", None, 0, None, "", True, None), ("d", "", 5, 5, ["q", "p"], "ACTIVE", None, None),
           ("e", None, 9000, 9, None, None, None, None), ("come", "n", 1, 1, None, None, None, None), ("f", "n", 1, 1, None, None, False, None)]
    frames = [spark.createDataFrame(rows, kinds).withColumn("pushed_at", F.when(F.col("id") == "f", F.lit(time).cast("timestamp"))) for rows in (old, new)]
    frames[1] = frames[1].withColumn("pushed_at", F.when(F.col("id") == "f", F.lit("2026-01-01 00:00:00.000002").cast("timestamp")))
    flags = ["id", "presence", "star_gain", "changes", "is_trending", "is_updated", "is_stale", "is_archived"]
    full = diff.changes(*frames, "2026-02-01").filter("presence <> 'both' or is_trending or is_updated or is_stale or is_archived")
    few = diff.flagged(*frames, "2026-02-01")
    assert few.columns and sorted(few.columns) == sorted(full.columns)
    key = lambda df: sorted(str(r) for r in df.select(*flags).collect())
    assert key(few) == key(full)
    assert diff.summary(few).first() == diff.summary(diff.changes(*frames, "2026-02-01")).first()
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    wide = plan[: plan.index("FullOuter")].count("LeftSemi")
    assert wide == 0 and plan.count("LeftSemi") == 2 and "LeftAnti" in plan  # whole rows meet behind the semi joins


def test_positions_of_wide_rows_stage_keys_only(spark):
    rnd = random.Random(5)
    rows = [(None if rnd.random() < .1 else rnd.choice("ab"), rnd.choice([None, 1, 2, 3]), i, "wide" * 50) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, v int, id int, body string")
    order = [F.coalesce(F.col("v"), F.lit(0)).desc(), F.asc("id")]
    wide = ranking.position_in_group(df, ["g"], order, "pos")
    narrow = ranking.position_by_id(df, ["g"], ["id"], order, ["v"], "pos")
    assert sorted(map(str, wide.collect())) == sorted(map(str, narrow.collect()))
    staged = [line for line in narrow._jdf.queryExecution().executedPlan().toString().splitlines() if "ExistingRDD" in line]
    assert staged and not any("body" in line and "__row" in line for line in staged)


def test_narrow_rows_are_ranked_without_a_join(spark):
    df = spark.createDataFrame([("a" if i % 3 else None, i % 4, i) for i in range(200)], "g string, v int, id int")
    order = [F.desc("v"), F.asc("id")]
    ranked = ranking.position_by_id(df, ["g"], ["id"], order, ["v"], "pos")
    assert sorted(map(str, ranked.collect())) == sorted(map(str, ranking.position_in_group(df, ["g"], order, "pos").collect()))
    twice = df.unionByName(df.filter("id < 3"))  # an identity that repeats meets each of its positions, as wide rows do
    wide = ranking.position_by_id(twice.withColumn("body", F.lit("b")), ["g"], ["id"], order, ["v"], "pos").drop("body")
    assert wide.count() == 209 and sorted(map(str, wide.collect())) == sorted(map(str, ranking.position_by_id(twice, ["g"], ["id"], order, ["v"], "pos").collect()))
    assert "SortMergeJoin" not in (plan := ranked._jdf.queryExecution().executedPlan().toString()) and "hashpartitioning(g" not in plan.split("BroadcastExchange")[0]


def test_extraction_reads_files_once(spark):
    selected = spark.createDataFrame([("github:a/b",)], "id string")
    text = "aGVsbG8="
    rows = [("github:a/b", K.README_LISTING, "file", 0, "README.md", "README.md", None, text), ("github:c/d", K.README_LISTING, "file", 0, "README.md", "README.md", None, text)]
    files = spark.createDataFrame(rows, "repository_id string, listing string, type string, file_order bigint, name string, path string, html_url string, content_base64 string")
    docs = content.documents(selected, files)
    assert [(r["repository_id"], r["content"]) for r in docs.collect()] == [("github:a/b", "hello")]
    assert "content_base64" not in docs._jdf.queryExecution().executedPlan().toString()  # decoded once, then read from the stage
    empty = content.documents(selected.limit(0), files)
    assert empty.count() == 0 and content.statuses(selected, empty).first()["status"] == "skipped"
