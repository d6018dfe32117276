"""Prefix trie, collocations and top-k search against brute force and their SQL forms."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from shelfmark.llm import phrases, queries, topk, tries
from shelfmark.llm.common import Rolling

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, depth long, ref long, owner string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "conversations"):
        con.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    got = queries.QUERIES[key](spark, SF)
    result = con.sql(queries.ORACLES[key])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(got.columns)
    expected = sorted(result.fetchall(), key=lambda r: tuple((v is None, str(v)) for v in r))
    assert rows_of(got.select(*names)) == expected


# --- prefix trie


def brute_trie(rows, heads=6, spread=100):
    convs = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append((t is not None, t or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest(), role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        built[c] = own.get(c - int(math.fmod(c, spread)), [])[:h] + turns[h:]
    members = collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(k))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 7, 8, "x") for r in rows], TURNS)


def many_turns(seed, convs, low=0):
    rng = random.Random(seed)
    rows = []
    for c in range(low, low + convs):
        for t in range(rng.choice([1, 2, 2, 3, 5, 8, 12])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "b", "", None, "long text ☃"])))
    return rows + rows[::5]  # repeated rows


@pytest.mark.parametrize("seed, convs, low", [(1, 60, 0), (2, 150, -130), (3, 40, 95)])
def test_trie_equals_brute_force(spark, seed, convs, low):
    rows = many_turns(seed, convs, low)
    assert rows_of(tries.prefix_trie(conversations(spark, rows), chunk=3)) == brute_trie(rows)


def test_trie_of_one_very_long_and_many_equal_conversations(spark):
    long = [(100, i, "user", f"turn {i % 50}") for i in range(9_000)] + [(101, i, "user", f"turn {i % 50}") for i in range(9_000)]
    same = [(c, i, "user", "hello" if i == 0 else "there") for c in range(1_000, 1_700) for i in range(7)]
    rows = same + [(c, 0, "user", "hello") for c in range(2_000, 2_100)]
    assert rows_of(tries.prefix_trie(conversations(spark, rows), chunk=16)) == brute_trie(rows)
    got = {(r["conv_id"], r["depth"]): r for r in tries.prefix_trie(conversations(spark, long)).collect()}
    assert len(got) == 9_001 and all(r["n_convs"] == 2 and r["n_leaves"] == 1 for r in got.values())
    ahead = [len(f"turn {i % 50}") for i in range(9_000)]
    assert all(got[100, d]["saved_tokens"] == sum(ahead[max(0, d - 1) :]) for d in (0, 1, 2, 4_095, 4_096, 4_097, 8_191, 9_000))


def test_trie_of_nothing_and_of_turns_without_conversation(spark):
    assert rows_of(tries.prefix_trie(conversations(spark, []))) == []
    assert rows_of(tries.prefix_trie(conversations(spark, [(None, 1, "user", "x")]))) == []
    only = [c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 0][0]
    rows = [(only, None, None, None)]  # its one turn gives way to the head of a base that is absent: turnless
    assert rows_of(tries.prefix_trie(conversations(spark, rows))) == brute_trie(rows)
    assert len(brute_trie(rows)) == 1


def test_trie_takes_other_bases_when_sequences_share_a_fingerprint(spark):
    rows = [(100, 0, "u", "a"), (100, 1, "u", "b"), (200, 0, "u", "b"), (200, 1, "u", "a")]
    commuting = (1, 1)  # a sum without powers: order is lost
    assert rows_of(tries.prefix_trie(conversations(spark, rows), heads=1, bases=(commuting, tries.BASES[0]))) == brute_trie(rows, heads=1)
    with pytest.raises(ValueError):
        tries.prefix_trie(conversations(spark, rows), heads=1, bases=(commuting,))


def test_products_modulo_the_prime():
    rng = random.Random(4)
    a, b = ([rng.randrange(tries.PRIME) for _ in range(500)] + [0, 1, tries.PRIME - 1] for _ in range(2))
    got = tries.times(np.array(a, np.uint64), np.array(b, np.uint64))
    assert got.tolist() == [x * y % tries.PRIME for x, y in zip(a, b)]
    assert tries.powers(12345, 40).tolist() == [pow(12345, i, tries.PRIME) for i in range(40)]


# --- collocations


def brute_phrases(docs, least, longest=5, top=2000):
    counts, n = collections.defaultdict(collections.Counter), collections.Counter()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(low)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = collections.Counter()
        for p, a in frequent.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i : i + size]] = max(longer[p[i : i + size]], a)
        found = []
        for p, a in frequent.items():
            if longer[p] < a:
                score, k = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]], score))
        out += [(lang, i, x[2].decode(), *x[3:6], n[lang], x[6]) for i, x in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def some_texts(seed, count):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "naïve", "ß", "x\0y", "a b", "c"] + [f"w{i}" for i in range(30)]
    made = []
    for i in range(count):
        parts = [rng.choice(["new york city hall now", "of the", rng.choice(words), rng.choice(words), rng.choice(words)]) for _ in range(rng.randrange(40))]
        made.append((i, "".join(p + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ","]) for p in parts), rng.choice(["en", "en", "fr", None])))
    return made


@pytest.mark.parametrize("seed, count, least, shards", [(1, 200, 5, 3), (2, 120, 2, 4), (3, 60, 1, 2), (4, 300, 40, 1)])
def test_collocations_equal_brute_force(spark, docs_of, seed, count, least, shards):
    made = some_texts(seed, count)
    got = phrases.collocations(docs_of(made), least=least, shards=shards)
    assert rows_of(got) == brute_phrases([(t, lang) for _, t, lang in made], least)


def test_collocations_of_edge_rows(spark, edge, nothing, docs_of):
    assert rows_of(phrases.collocations(nothing)) == []
    expected = brute_phrases([(r["text"], r["lang"]) for r in edge.collect()], 4)
    assert rows_of(phrases.collocations(edge, least=4)) == expected and expected
    ties = [(i, "d c. a b. b a", "en") for i in range(10)] + [(None, None, None)]
    assert [r["phrase"] for r in phrases.collocations(docs_of(ties), least=10, top=2).orderBy("rank").collect()] == ["d c", "a b"]


def test_collocations_with_a_crowded_table(spark, docs_of):
    made = some_texts(5, 150)  # with so few slots hardly one stays free: all phrases pass the table
    assert rows_of(phrases.collocations(docs_of(made), least=4, slots=64)) == brute_phrases([(t, lang) for _, t, lang in made], 4)


def test_score_beyond_64_bits(spark):
    row = spark.sql("select (cast(1000 as decimal(38,0)) * cast(900000000000 as decimal(38,0)) * cast(5000000000000 as decimal(38,0))) div (cast(900000000001 as decimal(38,0)) * cast(900000000000 as decimal(38,0))) as x").first()
    assert row["x"] == 1000 * 900000000000 * 5000000000000 // (900000000001 * 900000000000)


def test_word_spans_of_pieces():
    text = "One two.three\tfour \n é,".encode()
    starts, ends, rows, last = phrases.pieces(np.frombuffer(text, np.uint8), np.array([0, 7, len(text)]))
    assert [text[a:b].decode() for a, b in zip(starts, ends)] == ["One", "two", "three", "four", "é"]
    assert rows.tolist() == [0, 0, 1, 1, 1] and last.tolist() == [False, True, False, True, True]
    assert len(Rolling(np.zeros(0, np.uint8)).sums) == 1


# --- top-k


def brute_top(rows, k=20, every=20):
    usable = [(i, v, [math.floor(64 * x) for x in e]) for i, (v, e) in enumerate(rows) if e is not None and all(x is not None and math.isfinite(x) and abs(x) * 64 < math.inf for x in e)]
    out = []
    for i, q, a in usable:
        if q is not None and q % every == 0:
            scored = sorted((-min(max(sum(x * y for x, y in zip(a, b)), topk.LEAST), topk.MOST), v is None, v or 0) for j, v, b in usable if j != i)
            out += [(q, r, None if x[1] else x[2], -x[0]) for r, x in enumerate(scored[:k], 1)]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 3, "x") for r in rows], "vec_id long, embedding array<double>, block long, team string")


@pytest.mark.parametrize("sizes", [{}, {"block": 4, "unit_vectors": 16, "unit_queries": 3}, {"block": 1, "unit_vectors": 5, "unit_queries": 1}])
def test_top_k_equals_brute_force(spark, sizes):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(-3, 4, 6) / 64).tolist()) for i in range(-40, 150)]
    rows += [(20, [1.0] * 6), (20, [1.0] * 6), (7, [1.0] * 6), (None, [2.0, 2.0]), (None, [2.0, 2.0]), (40, []), (60, [0.3]), (61, None), (80, [None, 1.0]), (81, [math.nan]), (100, [math.inf]), (120, [1e308, 1.0]), (140, [0.5] * 9)]
    assert rows_of(topk.top_k(vectors(spark, rows), k=5, **sizes)) == brute_top(rows, 5)


def test_top_k_of_huge_components_and_of_few_rows(spark):
    rows = [(0, [1e300, -1.0]), (1, [-1e300, 3.0]), (2, [2.0**40, 2.0**41]), (20, [2.0**30, -(2.0**29)]), (21, [0.015, 2.0**45]), (40, [0.25, 0.5])]
    assert rows_of(topk.top_k(vectors(spark, rows))) == brute_top(rows)
    assert rows_of(topk.top_k(vectors(spark, rows[:1]))) == []
    assert rows_of(topk.top_k(vectors(spark, []))) == []


def test_walk_of_blocks_stops_at_the_bound():
    rng = np.random.default_rng(6)
    made, seen = [], []
    for i in range(40):
        m = rng.integers(0, 5, (8, 4)).astype(float) + 10 * (i == 17)
        made.append({"block": i, "size": 8, "dims": 4, "forward": m.tobytes(), "high": m.max(axis=0).tobytes(), "low": m.min(axis=0).tobytes(), "order": np.arange(8) + 8 * i})
    scores = topk._scores

    def counted(q, m):
        seen.append(len(m))
        return scores(q, m)

    topk._scores = counted
    try:
        who, what, where, slot = topk.best(np.ones((1, 4)), np.array([topk.LEAST]), np.array([[99, 0]]), made, 3)
    finally:
        topk._scores = scores
    assert where.tolist() == [17] * 3 and len(seen) == 1
