"""Ledger of the ingest, bucketed findings and clustered content: what is read, written and left alone."""

import gzip
import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shelfmark.operators import keyed, records
from shelfmark.schemas import REPOSITORY
from shelfmark.sources import tables
from shelfmark.streaming import ingest
from shelfmark.taxonomy import EXAMPLE

FINDING = "source string, advisory_id string, package string, repository_id string, ecosystem string, severity string, summary string, url string, cve_ids array<string>, observed_at timestamp"


def arriving(spark, rows):
    """Records (name, stars, day, topics, list)."""
    df = spark.createDataFrame(rows, "name string, stars bigint, day string, topics array<string>, seen string")
    full = df.select("name", "stars", "topics", F.lit("o").alias("owner"), F.col("day").cast("timestamp").alias("collected_at"),
                     F.array(F.struct(F.col("seen").alias("repository"), F.lit("s").alias("section"))).alias("sources"))
    return records.complete(full).select(*REPOSITORY.fieldNames())


def state(spark, log, base=None):
    got = {name: ingest.current(spark, log, base, name).collect() for name in ingest.TABLES}
    return ({(r["id"], r["stars"]) for r in got["records"]}, {(r["repository_id"], r["source_repository"]) for r in got["sources"]},
            {(r["name"], r["parent"]) for r in got["categories"]}, {(r["repository_id"], r["category"]) for r in got["bridge"]})


def test_batches_count_once_they_are_entered(spark, tmp_path):
    log = str(tmp_path / "log")
    first = arriving(spark, [("a", 1, "2026-01-01", ["sql"], "l1"), ("b", 1, "2026-01-01", [], "l1")])
    assert ingest.land(first, 0, log, "run", EXAMPLE)
    before = state(spark, log)
    assert before[0] == {("github:o/a", 1), ("github:o/b", 1)} and before[2] == {("Stores", "Data Systems"), ("Data Systems", None)}
    arriving(spark, [("a", 9, "2026-02-01", [], "l1")]).withColumn("batch", F.lit(1).cast("bigint")).write.parquet(f"{log}/records/batch_no=1")
    assert state(spark, log) == before  # written, not entered: the writer was lost
    assert not ingest.land(arriving(spark, [("z", 1, "2026-03-01", [], "l9")]), 0, log, "run", EXAMPLE)
    assert state(spark, log) == before  # entered before: a replay changes nothing
    assert ingest.land(arriving(spark, [("a", 2, "2026-02-02", ["streaming"], "l2"), ("b", 7, "2025-01-01", [], "l1")]), 1, log, "run", EXAMPLE)
    after = state(spark, log)
    assert after[0] == {("github:o/a", 2), ("github:o/b", 1)}  # the newest record of an id, however late it lands
    assert after[1] == {("github:o/a", "l1"), ("github:o/a", "l2"), ("github:o/b", "l1")} and len(after[3]) == 2
    with pytest.raises(ValueError):
        ingest.land(first, 1, log, "another run", EXAMPLE)


def test_compaction_folds_and_drops_what_it_names(spark, tmp_path):
    log, one, two = (str(tmp_path / x) for x in ("log", "v1", "v2"))
    batch = lambda n: arriving(spark, [("hot", n, f"2026-01-{n + 1:02}", ["sql"], f"l{n}"), (f"r{n}", n, "2026-01-01", ["streaming"], "l")])
    for n in (0, 1):
        ingest.land(batch(n), n, log, "run", EXAMPLE)
    assert ingest.compact(spark, log, None, one) == [0, 1]
    ingest.land(batch(2), 2, log, "run", EXAMPLE)  # meanwhile
    expected = state(spark, log, one)
    assert ingest.open_batches(spark, log, one) == [2] and len(expected[0]) == 4
    assert ingest.drop_folded(spark, log, one) == [0, 1]
    assert state(spark, log, one) == expected and sorted(x.name for x in Path(log, "records").iterdir()) == ["batch_no=2"]
    assert ingest.compact(spark, log, one, two) == [2]
    assert state(spark, log, two) == expected
    assert ingest.drop_folded(spark, log, two) == [2] and state(spark, log, two) == expected
    assert ingest.compact(spark, log, two, str(tmp_path / "v3")) == []
    with pytest.raises(ValueError):
        ingest.current(spark, str(tmp_path / "nothing"))


def findings(spark, rows):
    return spark.createDataFrame([("osv", a, p, None, "e", sev, f"about {sev}", url, [], None, seq) for a, p, sev, url, seq in rows], FINDING + ", seq bigint")


def test_only_touched_buckets_are_read_and_replaced(spark, tmp_path):
    path = str(tmp_path / "f")
    tables.upsert_finding_buckets(spark, path, findings(spark, [(f"A{i}", "p", "LOW", f"u{i}", 0) for i in range(200)]), buckets=16)
    files = lambda: {f: f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}
    before = files()
    touched = tables.upsert_finding_buckets(spark, path, findings(spark, [("A7", "p", "MID", "x", 1), ("A7", "p", "HIGH", "y", 2), ("new", "p", "LOW", "n", 1)]))
    assert 1 <= len(touched) <= 2
    kept = {f for f, t in files().items() if before.get(f) == t}
    assert {f.parent.name for f in kept} == {f"bucket={b}" for b in range(16)} - {f"bucket={b}" for b in touched}
    rows = {r["advisory_id"]: r for r in spark.read.parquet(path).collect()}
    assert len(rows) == 201 and (rows["A7"]["severity"], rows["A7"]["url"], rows["new"]["url"]) == ("HIGH", "u7", "n")
    assert tables.upsert_finding_buckets(spark, path, findings(spark, []).limit(0)) == []


def test_stored_findings_meet_no_aggregate(spark, tmp_path):
    path = str(tmp_path / "f")
    findings(spark, [("A", "p", "LOW", "u", 0)]).drop("seq").write.parquet(path)
    merged = keyed.merge_findings(spark.read.parquet(path), keyed.reduced_findings(findings(spark, [("A", "p", "HIGH", "v", 1)])))
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1  # that of the new rows
    assert "Aggregate" not in plan[plan.index("Relation ["):].split("\n")[0] and plan.index("FullOuter") < plan.index("Aggregate [")
    assert [(r["severity"], r["url"]) for r in merged.collect()] == [("HIGH", "u")]


def test_content_lookup_reads_few_row_groups(spark, tmp_path):
    path = str(tmp_path / "c")
    docs = spark.range(6000).selectExpr("if(id % 3 = 0, 'github:o/hot', concat('github:o/', id % 500)) AS repository_id", "cast(id AS string) AS path", "repeat(sha2(cast(id AS string), 256), 20) AS content")
    tables.write_content(docs, path, buckets=8)
    found = tables.read_content(spark, path, "github:o/7")
    expected = {str(i) for i in range(6000) if i % 3 and i % 500 == 7}
    assert {r["path"] for r in found.collect()} == expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(repository_id,github:o/7)" in plan
    files = {d.name: list(d.glob("*.parquet")) for d in Path(path).glob("bucket=*")}
    hot = {f for fs in files.values() for f in fs if "github:o/hot" in pq.read_table(f, columns=["repository_id"], partitioning=None)["repository_id"].to_pylist()}
    assert len(hot) > 1  # a repository with a third of all documents is written by several tasks
    assert sum(len(fs) for fs in files.values()) <= 2 * 8 + len(hot)
    for fs in files.values():  # ids lie together: no two files of a bucket overlap but at their edge
        spans = sorted((pq.ParquetFile(f).metadata.row_group(0).column(0).statistics.min, pq.ParquetFile(f).metadata.row_group(0).column(0).statistics.max) for f in fs)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    tables.write_content(docs.limit(10), path, buckets=3)
    assert spark.read.json(f"{path}.layout").first()["buckets"] == 3


def test_published_texts_come_from_one_sort_in_order(spark, tmp_path):
    from shelfmark.operators import reports
    from shelfmark.plans import publish

    rows = [(f"github:o/{i}", "o", str(i), "u", None if i % 5 else " about ", i % 3 * 10, None, float(i % 4), None) for i in range(300)]
    flat = spark.createDataFrame(rows, "id string, owner string, name string, url string, description string, stars bigint, language string, score_overall double, health_status string")
    bridge = spark.createDataFrame([(f"github:o/{i}", c) for i in range(290) for c in (["Leaf"] if i % 3 else ["Other", "Top"])], "repository_id string, category string")
    cats = spark.createDataFrame([("Leaf", "Top"), ("Other", "Top"), ("Top", "Top")], "name string, parent string")
    assert publish.publish(flat, bridge, cats, str(tmp_path / "out"), "2026-01-01", "now")
    made = publish.generate(flat, bridge, cats, "now")
    for name in ("sitemap", "index_text", "category_index"):
        expected = [r["line"] for r in made[name].orderBy(*reports.ORDER).collect()]
        got = [line for f in sorted((tmp_path / "out" / name).glob("part-*")) for line in f.read_text().splitlines()]
        assert got == expected
    layout = reports.ordered_layout(made["entries"], "now")
    positions = {tuple(r) for r in tables.layout_positions(layout).collect()}
    assert positions == {(r["parent"], r["leaf"], r["position"], r["id"]) for r in tables.index_lists(made["entries"]).collect()}
    assert "Exchange" not in reports.layout_lines(layout, "sitemap")._jdf.queryExecution().executedPlan().toString()


def test_published_entries_are_made_once_and_the_layout_is_narrow(spark, tmp_path, monkeypatch):
    from shelfmark.operators import reports
    from shelfmark.plans import publish

    rows = [(f"github:o/{i // 2 if i < 20 else i}", "o", str(i), "u", None, i % 3, None, float(i % 4), None) for i in range(80)]
    flat = spark.createDataFrame(rows, "id string, owner string, name string, url string, description string, stars bigint, language string, score_overall double, health_status string")
    bridge = spark.createDataFrame([(f"github:o/{i}", c) for i in range(70) for c in ("Leaf", "Top")], "repository_id string, category string")
    cats = spark.createDataFrame([("Leaf", "Top"), ("Top", "Top")], "name string, parent string")
    read, layouts, real = [], [], reports.ordered_layout
    monkeypatch.setattr(reports, "ordered_layout", lambda entries, at: read.append(entries) or layouts.append(real(entries, at)) or layouts[0])
    assert publish.publish(flat, bridge, cats, str(tmp_path / "out"), "2026-01-01", "now")
    plan = read[0]._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "InMemoryTableScan" not in plan and all("/daily_entries/" in f for f in read[0].inputFiles())
    assert set(layouts[0].columns) == {"row", "entry", "parent", "leaf", "id", "line", "report", "name", "url", "description", "stars", "score"}
    made = publish.generate(flat, bridge, cats, "now")
    lines = lambda df: sorted(r["line"] for r in df.collect() if not r["line"].startswith("| ["))
    guide = spark.read.text(str(tmp_path / "out" / "agent_guide")).withColumnRenamed("value", "line")
    assert lines(guide) == lines(made["agent_guide"])
    best = [r["line"] for r in guide.filter("line LIKE '| [%'").collect()]
    assert len(best) == 50 and "- Records: 70" in lines(guide) and "- Leaves: 3" in lines(guide) and "- Parents: 2" in lines(guide)
    stored = spark.read.parquet(str(tmp_path / "out" / "daily_entries")).drop("date")
    assert sorted(map(str, stored.collect())) == sorted(map(str, made["entries"].select(*stored.columns).collect()))


def _catalog(spark, n=300):
    rows = [(f"github:o/{i}", "o", str(i), "u", None if i % 5 else " about ", i % 3 * 10, None, float(i % 4), None) for i in range(n)]
    flat = spark.createDataFrame(rows, "id string, owner string, name string, url string, description string, stars bigint, language string, score_overall double, health_status string")
    bridge = spark.createDataFrame([(f"github:o/{i}", c) for i in range(n - 10) for c in (["Leaf"] if i % 3 else ["Other", "Top"])], "repository_id string, category string")
    return flat, bridge, spark.createDataFrame([("Leaf", "Top"), ("Other", "Top"), ("Top", "Top")], "name string, parent string")


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_publish_leaves_no_shuffles_and_no_checkpoints(spark, tmp_path):
    from shelfmark.plans import publish
    from shelfmark.session import ensure_checkpoint_dir

    kept = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    flat, bridge, cats = _catalog(spark)
    checkpoints, setting, shuffles = set(kept.glob("rdd-*")), spark.conf.get(key), _shuffle_files(spark)
    assert publish.publish(flat, bridge, cats, str(tmp_path / "out"), "2026-01-01", "now")
    assert set(kept.glob("rdd-*")) <= checkpoints and spark.conf.get(key) == setting
    for _ in range(50):  # the files go in the background
        left = _shuffle_files(spark) - shuffles
        if not left:
            break
        time.sleep(0.1)
    assert not left


def test_dropped_checkpoints_are_only_those_read(spark):
    from shelfmark.session import drop_checkpoints, ensure_checkpoint_dir

    kept = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(kept.glob("rdd-*"))
    first, second = spark.range(10).checkpoint(), spark.range(20).checkpoint()
    drop_checkpoints(first.alias("a").join(first.alias("b"), "id").join(spark.range(5), "id").select("id"))
    assert len(set(kept.glob("rdd-*")) - before) == 1 and second.count() == 20
    drop_checkpoints(spark.range(3))


def test_published_texts_may_be_compressed(spark, tmp_path):
    from shelfmark.plans import publish

    flat, bridge, cats = _catalog(spark)
    plain, packed = tmp_path / "plain", tmp_path / "packed"
    publish.publish(flat, bridge, cats, str(plain), "2026-01-01", "now")
    publish.publish(flat, bridge, cats, str(packed), "2026-01-01", "now", text_codec="gzip")
    for name in ("sitemap", "index_text", "category_index"):
        text = "".join(f.read_text() for f in sorted((plain / name).glob("part-*")))
        assert "".join(gzip.open(f, "rt").read() for f in sorted((packed / name).glob("part-*.gz"))) == text
        assert sorted(r["value"] for r in spark.read.text(str(packed / name)).collect()) == sorted(text.splitlines())
    members = lambda path: sorted(map(str, spark.read.parquet(str(path / "index" / "members")).collect()))
    assert len(members(plain)) == 397 and members(plain) == members(packed)
    assert spark.read.parquet(str(plain / "index" / "repositories")).count() == 300


def test_published_lines_are_counted_report_by_report(spark):
    from workload import q_reports

    flat, bridge, cats = _catalog(spark)
    views = {"repos": flat.withColumns({"created_at": F.lit(None).cast("timestamp")}), "bridge": bridge, "categories": cats}
    seen, grouped = [], type(flat).groupBy

    def watched(df, *cols):
        if cols == ("report", "line"):
            seen.append({f.split("/")[-2] for f in df.inputFiles()})
        return grouped(df, *cols)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(flat), "groupBy", watched)
        patch.setattr("shelfmark.plans.publish.diff.with_digest", lambda rows: rows)  # these rows lack its fields
        lines = q_reports.layout_lines(lambda name: views[name])
    assert seen == [{"sitemap"}, {"index_text"}, {"category_index"}]
    counts = {(r["report"], r["line"]): r["n"] for r in lines.collect()}
    assert sum(n for (report, _), n in counts.items() if report == "category_index") == 1 + 2 + 397
    assert counts["category_index", "- github:o/3"] == 2 and counts["sitemap", "## Top"] == 1
    assert "Exchange" not in lines._jdf.queryExecution().executedPlan().toString()


def test_broken_documents_and_feeds_become_messages(spark, tmp_path):
    from shelfmark.plans import maintain

    osv, kev = tmp_path / "osv", tmp_path / "kev"
    osv.mkdir(), kev.mkdir()
    good = '{"seq": 1, "package": "zed", "ecosystem": "e", "vulns": [{"id": "V-1", "summary": "s"}]}'
    (osv / "a.json").write_text("\n".join([good, "", "  ", '{"seq": 2, "package":', '[{"seq": 3}]', "null", "7", '{"seq": "four", "package": "zed"}', '{"seq": 5, "package": "zed", "vulns": 6}', good.replace("1", "8")]))
    (kev / "feed.json").write_text('{"vulnerabilities": [\n{"cveID": "CVE-9", "product": "Zed"}\n]}')
    (kev / "cut.json").write_text('{"vulnerabilities": [\n{"cveID": "CVE-')
    recs = spark.createDataFrame([("github:a/zed", "zed", 0, 5)], "id string, name string, seq bigint, stars bigint")
    for staging in (None, str(tmp_path / "staged")):
        made = maintain.enrich_feeds(recs, {"osv": str(osv), "kev": str(kev), "cve": str(tmp_path / "none")}, "2026-01-01", staging=staging)
        assert sorted((r["source"], r["advisory_id"], r["repository_id"]) for r in made["findings"].collect()) == [
            ("cisa-kev", "CVE-9", "github:a/zed"), ("osv", "V-1", "github:a/zed"), ("osv", "V-8", "github:a/zed")]
        messages = sorted((r["provider"], r["message"]) for r in made["errors"].collect())
        assert [p for p, _ in messages] == ["cve", "kev"] + ["osv"] * 6 and messages[0][1] == "cve: cannot open feed: PATH_NOT_FOUND"
        assert all(m.startswith(f"{p}: unreadable document: ") for p, m in messages[1:])
        assert made["report"].first()["error_count"] == 8
    nothing = maintain.enrich_feeds(recs, {"cve": str(tmp_path / "none")}, "2026-01-01")
    assert nothing["findings"].count() == 0 and nothing["errors"].count() == 1


def test_feed_files_are_compressed_and_bounded(spark, monkeypatch):
    from shelfmark.sources import feeds
    from workload import q_findings
    from workload.common import hits

    monkeypatch.setattr(q_findings, "FEED_LINES", 100)
    flat = spark.range(1000).selectExpr(
        "id AS seq", "'topic' AS source", "'q' AS query", "'o' AS owner", "'n' AS name", "'u' AS html_url", "'d' AS description", "id AS stars", "id AS forks_count",
        "id AS forks", "id AS issues", "'Go' AS language", "array('t') AS topics", "'mit' AS license", "false AS archived")
    _, path = q_findings.feed_file(hits(flat.coalesce(1)), "t")
    files = list(Path(path.removeprefix("file:")).glob("part-*.json*"))
    assert len(files) == 10 and all(f.name.endswith(".lz4") for f in files)
    assert sum(f.stat().st_size for f in files) < 100 * 1000
    assert sorted(r["seq"] for r in feeds.read_hits(spark, path).collect()) == list(range(1000))
