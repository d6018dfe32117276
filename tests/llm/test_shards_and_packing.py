import random
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st

from shelfmark.llm import packing, shards

from .conftest import EDGE


def jump(key, n):
    key, b, j = (key or 0) & (2**64 - 1), -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & (2**64 - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_shards_follow_the_published_loop(docs_of):
    ids = [0, 1, -1, 2**63 - 1, -(2**63), *range(100, 300)]
    rows = shards.assign_shards(docs_of([(i, f"t{i}") for i in ids])).collect()
    assert {(r.doc_id, r.shard, r.grown_shard) for r in rows} == {(i, jump(i, 24), jump(i, 25)) for i in ids}
    assert all(r.grown_shard in (r.shard, 24) for r in rows)


def test_shard_slots_and_edge_rows(edge, nothing):
    rows = shards.assign_shards(edge, 3).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in EDGE)
    for shard in range(3):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert {r.law for r in rows} == {"key"}
    assert shards.assign_shards(nothing).count() == 0


def test_fast_ids_equal_the_tokenizer_file():
    ids = packing.ids_of(packing.TOKENIZER)
    texts = ["", " a  b\n\n c\t", "it's we'll 12,345 — “x” é ß", "<|endoftext|> x", "日本語 text 🙂", "\x00\x1f\x85  end", "a" * 3000, LATIN]
    for text in texts:
        assert ids(text).tolist() == ids.exact.encode(text, add_special_tokens=False).ids


LATIN = "".join(chr(c) for c in range(1, 0x250)) * 3 + " Straße  naïve\r\n\r\n x"


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
def test_solution_holds_every_item_once(histogram):
    patterns = packing.solve(histogram, 64, rounds=20)
    held = Counter()
    for pattern, times in patterns:
        assert times > 0 and sum(k * v for k, v in pattern.items()) <= 64
        for size, n in pattern.items():
            held[size] += n * times
    assert held == Counter(histogram)
    total = sum(k * v for k, v in histogram.items())
    assert sum(t for _, t in patterns) <= max(1, 2 * total // 64 + 1)


def test_planted_packings_are_found():
    def used(histogram):
        return sum(t for _, t in packing.solve(histogram, 2048))

    assert used({603: 1048, 861: 1048, 571: 1048}) == 1048
    assert used({500: 3000, 548: 1000}) == 1000
    rng, over = random.Random(1), []
    for _ in range(12):
        histogram, planted = Counter(), 0
        for _ in range(rng.choice([1, 2, 3])):
            cuts = sorted(rng.sample(range(1, 2048), rng.choice([1, 2, 3])))
            n = rng.choice([64, 300, 1000])
            planted += n
            histogram.update({b - a: n for a, b in zip([0, *cuts], [*cuts, 2048])})
        over.append(used(dict(histogram)) / planted - 1)
    assert max(over) <= 0.04 and sum(x <= 0.002 for x in over) >= 9


def test_patterns_take_a_length_as_often_as_it_fits_and_is_there():
    supply = np.zeros(101, np.int64)
    supply[[30, 10, 7]] = 5, 2, 9
    pattern = packing.price_pattern(np.arange(101, dtype=float), supply, 100)
    assert sum(s * n for s, n in pattern.items()) == 100 and all(n <= supply[s] for s, n in pattern.items())
    assert packing.least_sequences({60: 3, 10: 1}, 100) == 3 and packing.solve({}, 100) == []


def test_packing_is_a_partition_of_all_ids(edge, nothing):
    rows = packing.pack(edge).collect()
    ids = packing.ids_of(packing.TOKENIZER)
    want = Counter()
    for doc_id, text in EDGE:
        tokens = np.append(ids(text or ""), 0).astype("<u4")
        first = len(tokens) % 2048 or 2048
        cuts = [0, *range(first, len(tokens), 2048), len(tokens)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc_id, i, a, b - a, zlib.crc32(tokens[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in sequences.values():
        end = 0
        for offset, length in sorted(members):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) == -(-sum(r.length for r in rows) // 2048)
    assert packing.pack(nothing).count() == 0
