import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfmark.llm import decontamination, duplicates, substrings
from shelfmark.llm.common import shingle_sets
from shelfmark.llm.components import components

from .conftest import EDGE, LONG


def _sets(rows, size=4):
    made = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        made.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set()))
    return made


def _expected(rows, size=4):
    sets = _sets(rows, size)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = Counter()
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        component = min(ids) if ids and sets[i] else doc_id
        out[doc_id, len(sets[i]), component, component == doc_id] += 1
    return out


def _crowd(seed=1):
    """Copies, near copies, texts that share a passage but are no copies, and chains of edits."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    rows, base, passage = [], fresh(120), fresh(60)
    for i in range(70):
        text = list(base)
        for _ in range(rng.randrange(0, 4)):
            text[rng.randrange(len(text))] = "edit"
        rows.append((1000 + i, " ".join(text)))
    for i in range(90):
        rows.append((2000 + i, " ".join(fresh(rng.randrange(10, 60)) + passage + fresh(20))))
    text = fresh(100)
    for i in range(12):
        text = list(text)
        text[8 * i] = f"step{i}"
        rows.append((3000 + i, " ".join(text)))
    rows += [(4000 + i, "Same Text of five words") for i in range(30)] + [(4100 + i, rng.choice(["a", "a b", "A", "b"])) for i in range(12)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("few", [2, 16])
def test_near_duplicates_equal_brute_force(docs_of, monkeypatch, few):
    monkeypatch.setattr(duplicates, "FEW", few)
    rows = _crowd() + EDGE
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in duplicates.near_duplicates(docs_of(rows)).collect())
    assert got == _expected(rows)


def test_block_links_of_tiny_sets_span_the_components(spark, monkeypatch):
    """Many members of few shingles in one list: the returned edges are links, and join what brute force joins."""
    monkeypatch.setattr(duplicates, "BLOCK", 40 * duplicates.LIGHTEST)
    rng = random.Random(8)
    sets = sorted({tuple(sorted(rng.sample(range(12), rng.randint(1, 9)))) for _ in range(160)})
    name = lambda k: b"%04d" % k
    weight = len(sets) * duplicates.LIGHTEST
    mixed = spark.createDataFrame([(1, len(sets), weight, name(k), len(v), name(k)) for k, v in enumerate(sets)], "key long, size long, weight long, node binary, n long, root binary")
    full = spark.createDataFrame([(name(k), np.array(v, np.uint64).tobytes()) for k, v in enumerate(sets)], "set_id binary, shingles binary")
    edges = {(int(r.a), int(r.b)) for r in duplicates.block_links(mixed, full, 80).collect()}
    linked = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if 100 * len(set(sets[i]) & set(sets[j])) >= 80 * len(set(sets[i]) | set(sets[j]))}

    def classes(pairs):
        label = list(range(len(sets)))
        for i, j in pairs:
            low, high = sorted((label[i], label[j]))
            label = [low if c == high else c for c in label]
        return label

    assert edges <= linked and classes(edges) == classes(linked) and len(set(classes(linked))) < len(sets)


def test_long_lists_are_compared_in_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(duplicates, "FEW", 3)
    monkeypatch.setattr(duplicates, "BLOCK", 2000)
    rng = random.Random(4)
    stock = [f"s{i}" for i in range(200)]
    rows = []
    for i in range(40):  # families whose leads agree, so that lists stay long and hold several components
        text = stock[: 150 + i % 4 * 12] + [f"own{i % 4}{k}" for k in range(30)]
        text[rng.randrange(150)] = "edit"
        rows.append((i, " ".join(text)))
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in duplicates.near_duplicates(docs_of(rows)).collect())
    assert got == _expected(rows)


def test_deduplication_keeps_one_of_each_group(docs_of, nothing):
    rows = _crowd(2) + EDGE
    docs = docs_of(rows)
    kept = duplicates.deduplicated(docs, 4)
    assert kept.columns == docs.columns
    want = Counter()
    for (doc_id, n, component, _), times in _expected(rows).items():
        if n == 0:
            want[doc_id] += times
        elif component == doc_id:
            want[doc_id] = 1
    got = Counter(r.doc_id for r in kept.collect())
    got_none, want_none = got.pop(None, 0), want.pop(None, 0)
    assert got == want and got_none == 2 and want_none >= 1
    assert duplicates.near_duplicates(nothing).count() == 0 and duplicates.deduplicated(nothing).count() == 0


@pytest.mark.parametrize("size", [4, 5])
def test_blocks_of_few_words(size):
    import pyarrow as pa
    for n in range(7):
        text = " ".join(f"w{i}" for i in range(n))
        want = 0 if not n else max(1, n - size + 1)
        assert [(row, len(made)) for row, made in shingle_sets(pa.array([text]), size)] == [(0, want)]
        split = [f"w{i}" for i in range(n)] + [None, ""]
        assert [len(made) for _, made in shingle_sets(pa.array(split, pa.string()), size)] == [1] * n + [0, 0]
        alone = list(shingle_sets(pa.array([text, "long " * 300_000]), size))
        assert [(row, len(made)) for row, made in alone] == [(0, want), (1, 1)]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 120)] + [(5, 5), (7, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 120)}}


def _removed(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = Counter()
    for (doc_id, _), b in zip(rows, raw):
        mask = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                mask[i : i + length] = b"\1" * length
        kept = bytes(c for c, m in zip(b, mask) if not m)
        out[doc_id, len(b), sum(mask), len([r for r in bytes(mask).split(b"\0") if r]), hashlib.sha256(kept).hexdigest()] += 1
    return out


def _passages():
    rng = random.Random(7)
    noise = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared, edge, loop = noise(420), noise(199), "ab" * 300
    rows = [(i, noise(rng.randrange(300)) + shared + noise(rng.randrange(300))) for i in range(25)]
    rows += [(100 + i, noise(50) + edge + noise(90)) for i in range(4)] + [(200, loop), (201, noise(100) + shared[100:330] + noise(10) + shared[:210])]
    rows += [(300 + i, noise(500)) for i in range(5)] + [(400, rows[0][1]), (401, rows[0][1]), (0, rows[0][1])]
    return rows + [r for r in EDGE if r[1] != LONG]


@pytest.mark.parametrize("crowd", [3, 20_000])
def test_repeated_bytes_equal_brute_force(docs_of, monkeypatch, crowd):
    monkeypatch.setattr(substrings, "CROWD", crowd)
    rows = _passages()
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substrings.repeated_bytes(docs_of(rows)).collect())
    assert got == _removed(rows, 200)


def test_text_without_repeats(docs_of, nothing):
    rows = _passages()
    docs = docs_of(rows)
    cut = substrings.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    by = {r.doc_id: r for r in cut.collect()}
    assert by[1].text is None and by[400].text == "" and by[400].n_chars == 0 and by[300].text == dict(rows)[300]
    assert substrings.repeated_bytes(nothing).count() == 0 and substrings.without_repeats(nothing).count() == 0


ITEMS = [(1, "What colour has the sea on a clear day in summer? It is mostly blue or green."), (2, "Élan vital was coined by whom? By Bergson in 1907, they say in France."), (3, "one word"), (4, None), (5, ""), (5, "What colour has the sea on a clear day in summer? It is mostly blue or green.")]


def test_leaks(spark, docs_of, nothing):
    rng = random.Random(9)
    noise = lambda n: " ".join(f"w{rng.randrange(50)}" for _ in range(n))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [(1, noise(500) + " " + ITEMS[0][1] + " " + noise(300)), (2, ITEMS[1][1].upper()), (3, noise(900)), (4, "What colour has the sea on a clear day in summer? " + noise(40)),
            (5, noise(63) + " " + ITEMS[1][1]), (6, "here is one word alone"), *[(i + 100 if i is not None else None, t) for i, t in EDGE]]
    found = decontamination.find_leaks(docs_of(rows), items)
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert got == {(1, 1), (1, 5), (2, 2), (5, 2), (6, 3)}
    assert all(r.contaminated and r.bm25 > 0 and min(r.question_overlap, r.answer_overlap) >= 0.6 for r in found.collect())
    kept = decontamination.decontaminated(docs_of(rows), items)
    assert kept.columns == docs_of(rows).columns and Counter(r.doc_id for r in kept.collect()) == Counter(i for i, _ in rows if i not in (1, 2, 5, 6))
    assert decontamination.find_leaks(nothing, items).count() == 0 and decontamination.find_leaks(docs_of(rows), items.filter("false")).count() == 0
    assert decontamination.decontaminated(docs_of(rows), items.filter("false")).count() == len(rows)


def test_search_returns_all_items_above_their_floor():
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(6, 40)))) for i in range(70)]
    index = decontamination.build(items, share=0.3)
    texts = [" ".join(rng.choice(vocabulary[:200]) for _ in range(rng.randrange(1, 400))) for _ in range(40)]
    texts += [t + " " + items[k][1] for k, t in enumerate(texts[:20])]
    import numpy as np
    hashes = decontamination._hashes(texts)
    at = np.concatenate(([0], np.cumsum([len(h) for h in hashes])))
    got = {(r, s, i) for r, s, i, _ in decontamination.search(index, np.concatenate(hashes), at)}
    want = set()
    for r, words in enumerate(hashes):
        for start in range(0, len(words) + index.stride, index.stride):
            held = np.unique(words[max(0, start) : start + 2 * index.stride])
            for b, (own, matrix) in enumerate(index.blocks):
                for column in range(matrix.shape[1]):
                    i = b * decontamination.BLOCK_ITEMS + column
                    if len(held) and matrix[np.isin(index.terms[own], held), column].sum() >= index.floors[i] - 1e-9:
                        want.add((r, start, i))
    assert got == want and len(got) > 20


def test_edited_items_are_found():
    import pyarrow as pa
    import pyarrow.parquet as pq
    items = [(r["item_id"], r["text"]) for r in pq.read_table("/root/testdata/sf0.1/benchmark.parquet").to_pylist()]
    index, rng = decontamination.build(items), random.Random(3)
    assert min(len(t.split()) for _, t in items) >= 15

    def edited(text, count, how):
        words = text.split()
        for i in sorted(rng.sample(range(len(words)), count), reverse=True):
            words[i : i + (how != "insert")] = [] if how == "delete" else [f"zz{rng.randrange(10**6)}"]
        return " ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(90))) + " " + " ".join(words) + " tail"

    for how in ("replace", "delete", "insert"):
        for count in (1, 2, 3):
            found = {(r, int(index.items[i])) for r, i, *_ in decontamination.leaks(index, pa.array([edited(t, count, how) for _, t in items]))}
            assert found >= {(r, i) for r, (i, _) in enumerate(items)}
    # a question without its answer is no leak
    halves = [" ".join(t.split()[: -len(index.parts[k][1])]) + " " + " ".join(f"w{rng.randrange(50)}" for _ in range(60)) for k, (_, t) in enumerate(items)]
    assert not list(decontamination.leaks(index, pa.array(halves)))


def test_unfinished_components_raise(spark, monkeypatch):
    from shelfmark.llm import components as module

    monkeypatch.setattr(module, "ROUNDS", 1)
    path = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    with pytest.raises(RuntimeError):
        components(path)


def _in_place_plainly(part, passage):
    best, count = [False] * len(part), -1
    for shift in range(-len(part) + 1 - decontamination.EDITS, len(passage)):
        held = [any(0 <= i + d < len(passage) and passage[i + d] == w for d in range(shift, shift + decontamination.EDITS + 1)) for i, w in enumerate(part)]
        if sum(held) > count:
            best, count = held, sum(held)
    return best


def test_words_in_place_equal_plain_count(monkeypatch):
    import numpy as np
    rng = random.Random(11)
    for case in range(300):
        monkeypatch.setattr(decontamination, "MATCHES", rng.choice([1, 7, 1 << 18]))
        part = np.array([rng.randrange(rng.choice([2, 5, 40])) for _ in range(rng.randrange(1, 25))], np.uint64)
        passage = np.array([rng.randrange(rng.choice([2, 5, 40])) for _ in range(rng.randrange(1, 50))], np.uint64)
        assert decontamination._in_place(part, passage).sum() == sum(_in_place_plainly(part.tolist(), passage.tolist())), case


def test_long_items_take_little_memory():
    import tracemalloc
    import pyarrow as pa
    rng = random.Random(4)
    words = [f"w{rng.randrange(3000)}" for _ in range(8000)]
    index = decontamination.build([(1, " ".join(words)), (2, "another short item of some words in a row")])
    words[4000] = "edited"
    column = pa.array(["before " * 50 + " ".join(words) + " after" * 50])
    tracemalloc.start()
    found = [f[1] for f in decontamination.leaks(index, column)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [0] and peak < 200e6


def test_found_items_do_not_depend_on_the_cut(spark, docs_of, monkeypatch):
    rng = random.Random(9)
    common = "which of the following is the most common"
    items = [(i, f"{common} {' '.join(f'k{i}x{j}' for j in range(rng.randrange(1, 12)))} answer {'really ' * (i % 4)}yes{i}") for i in range(16)]
    items += [(16, common + " thing here"), (17, " ".join(f"long{j}" for j in range(90))), (18, "one"), (19, " "), (17, " ".join(f"long{j}" for j in range(90)))]
    table = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of([(100 + i, f"some words before {t} and some behind") for i, t in items] + [(1, common), (2, None), (3, "")])
    got = []
    for chunk in (1024, 7, 1):
        monkeypatch.setattr(decontamination, "CHUNK_ITEMS", chunk)
        got.append(sorted((r.doc_id, r.item_id, round(r.bm25, 9), r.question_overlap, r.answer_overlap) for r in decontamination.find_leaks(docs, table).collect()))
        if chunk > 1:
            assert sorted(r.doc_id for r in decontamination.decontaminated(docs, table).collect()) == sorted(set(r.doc_id for r in docs.collect()) - {g[0] for g in got[-1]})
    assert got[0] == got[1] == got[2] and {g[:2] for g in got[0]} >= {(100 + i, i) for i in range(19)}


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(step(spark, docs, sf), name)
        assert docs.columns == columns and docs.count() > 0
    packed = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_stages_on_edge_rows(spark, docs_of, empty):
    """Nulls, blanks, repeated rows and clashing column names pass all stages; columns stay, and what is packed is what was kept."""
    sf = "/root/testdata/sf0.001"
    docs = docs_of([] if empty else EDGE)
    docs = docs.withColumn("_own", F.lit(1)).withColumn("key", F.lit("x"))
    columns = docs.columns
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(step(spark, docs, sf), name)
        assert docs.columns == columns
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    ids = Counter(r.doc_id for r in docs.select("doc_id").collect())
    assert Counter(r.doc_id for r in packed.filter("piece = 0").select("doc_id").collect()) == ids and (not empty or not ids)
