"""Benchmark items found in documents: BM25 over the items with block-max pruning, confirmed on question and answer."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import stage, utf8_blocks, word_hashes

K1, B = 1.2, 0.75  # usual BM25 constants
SHARE = 0.6  # of an item's own score that a passage must reach
OVERLAP = 0.6  # of the words of question and of answer that the passage must hold
EDITS, SPARE = 3, 5  # words that may differ in any place whatever the two shares say; at most one for each SPARE words of an item
BLOCK_ITEMS = 16  # items under one maximum
CHUNK_ITEMS, CHUNK_BYTES = 1024, 1 << 20  # of one index; more items make further indexes, with the same results
MATCHES = 1 << 18  # equal words looked at in one slice
STRIDE = 64  # words; the least
_SENTENCE = re.compile(r"(?<=[.?!:\n])\s+")


def _hashes(texts: list[str]) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for first, last, data, offsets in utf8_blocks(pc.utf8_lower(pa.array(texts, pa.string()))):
        words, at = word_hashes(data, offsets)
        out += [words[at[i] : at[i + 1]] for i in range(last - first)]
    return out


def _chained(words: np.ndarray) -> np.ndarray:
    """Hashes of three words in a row."""
    with np.errstate(over="ignore"):
        return (words[:-2] * np.uint64(0x9E3779B97F4A7C15) + words[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + words[2:]


def _in_place(part: np.ndarray, passage: np.ndarray) -> np.ndarray:
    """Which words of a part stand at their place in the best copy, give or take EDITS words.

    A word that stands at shift d (its place there less that in the part) counts for each of the EDITS + 1 stretches that
    allow d. Its shifts rise with its places, so the stretches it adds to earlier ones are one interval each, and a
    running sum of interval ends counts words by stretch. Matches are taken in slices: time follows their number, memory
    that of the words.
    """
    n, m = len(part), len(passage)
    order = np.argsort(passage, kind="stable")
    low = np.searchsorted(passage[order], part, "left")
    each = np.searchsorted(passage[order], part, "right") - low
    ends, total, first = np.zeros(n + m + EDITS + 1, np.int64), np.cumsum(each), 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(total, total[first] - each[first] + MATCHES, "right")))
        sizes = each[first:last]
        word = np.repeat(np.arange(first, last), sizes)
        nth = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        shift = order[np.repeat(low[first:last], sizes) + nth] - word + n - 1
        start = shift.copy()
        start[1:] = np.where(word[1:] == word[:-1], np.maximum(shift[1:], shift[:-1] + EDITS + 1), shift[1:])
        ends += np.bincount(start, minlength=len(ends)) - np.bincount(shift + EDITS + 1, minlength=len(ends))
        first = last
    best = int(np.cumsum(ends)[: n + m - 1 + EDITS].argmax())  # shifts best - EDITS to best, less n - 1
    found = np.zeros(n, bool)
    for shift in range(best - EDITS, best + 1):
        place = np.arange(n) + shift - n + 1
        inside = (place >= 0) & (place < m)
        found[inside] |= passage[place[inside]] == part[inside]
    return found


def held_words(part: np.ndarray, passage: np.ndarray) -> float:
    """How many words of a part the passage holds: in runs of three, wherever they stand, or at their place in a copy.

    Places may shift by up to EDITS words, as inserted and lost words shift them; of all such stretches of the passage,
    the one with most words counts. A part that repeats itself may count by its distinct runs instead. Of a part of one
    or two words, each word may stand anywhere.
    """
    n = len(part)
    if n < 3:
        return float(np.isin(part, passage).sum())
    held, distinct = np.zeros(n, bool), 0.0
    if len(passage) > 2:
        runs = _chained(part)
        found = np.isin(runs, _chained(passage))
        held[:-2] |= found
        held[1:-1] |= found
        held[2:] |= found
        first = np.unique(runs, return_index=True)[1]
        distinct = n * float(found[first].mean())
    if len(passage) and not held.all():
        held |= _in_place(part, passage)
    return max(float(held.sum()), distinct)


def edits_of(length: int) -> int:
    """Words of an item of ``length`` words that may differ in any place."""
    return min(EDITS, length // SPARE)


def stride_of(length: int) -> int:
    """Words between passages for an item of ``length`` words: a power of two, so that an item and EDITS words fit."""
    return max(STRIDE, 1 << (length + EDITS - 1).bit_length())


def question_and_answer(text: str, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of both parts. The answer is the last sentence; either part has at least 8 words, or half of an item of
    under 16 words. An item of under 6 words is both."""
    if len(words) < 6:
        return words, words
    least = min(8, len(words) // 2)
    size = min(max(least, len(_SENTENCE.split(text.strip())[-1].split())), len(words) - least)
    return words[:-size], words[-size:]


@dataclass
class Index:
    """Inverted index of some items. Terms are word hashes; a posting's impact is its BM25 share."""

    items: np.ndarray  # item ids, in index order
    terms: np.ndarray  # sorted word hashes
    needed: np.ndarray  # whether some item can't pass without one of such terms
    floors: np.ndarray  # score each item must reach
    least: np.ndarray  # lowest floor of each block
    peaks: np.ndarray  # blocks x terms: highest impact of the term in the block
    blocks: list[tuple[np.ndarray, np.ndarray]]  # per block: its terms, their impacts on its items
    parts: list[tuple[np.ndarray, np.ndarray]]  # words of each item's question and answer
    lengths: list[int]  # words of each item
    stride: int  # words between passages; no item is longer, EDITS more words included


@dataclass
class Statistics:
    """Of all items, whatever part of them an index holds."""

    count: int  # items with a word
    words: int
    frequency: dict[int, int]  # items with a term, for the terms of the index


def build(items: list[tuple[int, str]], share: float = SHARE, all_items: Callable[[np.ndarray], Statistics] | None = None) -> Index | None:
    """The index of items with at least one word; none gives None. ``all_items`` gives the statistics for its terms;
    without it, these items are all."""
    words = _hashes([text for _, text in items])
    items, words = [i for i, w in zip(items, words, strict=True) if len(w)], [w for w in words if len(w)]
    if not items:
        return None
    terms = np.unique(np.concatenate(words))
    counted = [np.unique(np.searchsorted(terms, w), return_counts=True) for w in words]
    if all_items is None:
        count, total, df = len(items), sum(map(len, words)), np.bincount(np.concatenate([t for t, _ in counted]), minlength=len(terms))
    else:
        known = all_items(terms)
        count, total, df = known.count, known.words, np.array([known.frequency[t] for t in terms.view(np.int64).tolist()])
    idf = np.log1p((count - df + 0.5) / (df + 0.5))
    mean = total / count
    impacts = [idf[t] * n * (K1 + 1) / (n + K1 * (1 - B + B * len(w) / mean)) for (t, n), w in zip(counted, words, strict=True)]
    floors = np.array([min(share * v.sum(), np.sort(v)[: len(v) - edits_of(len(w))].sum()) for v, w in zip(impacts, words, strict=True)])
    needed = np.zeros(len(terms), bool)
    for (t, _), v, floor in zip(counted, impacts, floors, strict=True):
        order = np.argsort(v, kind="stable")
        needed[t[order[np.cumsum(v[order]) >= floor - 1e-9]]] = True  # the weaker terms together stay below the floor
    height = -(-len(items) // BLOCK_ITEMS)
    peaks, blocks = np.zeros((height, len(terms)), np.float32), []
    for b in range(height):
        inside = range(b * BLOCK_ITEMS, min(len(items), (b + 1) * BLOCK_ITEMS))
        own = np.unique(np.concatenate([counted[i][0] for i in inside]))
        matrix = np.zeros((len(own), len(inside)))
        for column, i in enumerate(inside):
            matrix[np.searchsorted(own, counted[i][0]), column] = impacts[i]
        peaks[b, own] = np.nextafter(matrix.max(1).astype(np.float32), np.float32(np.inf))
        blocks.append((own, matrix))
    least = np.minimum.reduceat(floors, np.arange(0, len(items), BLOCK_ITEMS))
    parts = [question_and_answer(text, w) for (_, text), w in zip(items, words, strict=True)]
    return Index(np.array([i for i, _ in items], object), terms, needed, floors, least, peaks, blocks, parts, [len(w) for w in words], max(stride_of(len(w)) for w in words))


def search(index: Index, words: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
    """(row, first word, item position, score) of every passage and item at or above the item's floor.

    ``at`` bounds the rows' words. Passages are 2 x stride words long and start every stride words, so any item lies
    whole in one. A passage without a needed term can't reach any floor; for the others, the sums of the blocks'
    highest impacts rule out blocks of items, and what is left is scored in full.
    """
    place = np.searchsorted(index.terms, words)
    place[place == len(index.terms)] = 0
    known = np.flatnonzero(index.terms[place] == words)
    row = np.searchsorted(at, known, "right") - 1
    start = (known - at[row]) // index.stride
    base = np.concatenate(([0], np.cumsum((np.diff(at) - 1) // index.stride + 2)))  # passage numbers of each row
    number, term = base[row] + start, place[known]
    number = np.concatenate((number, number[start > 0] - 1))  # each word is in the passage that starts before, too
    term = np.concatenate((term, term[start > 0]))
    live = np.unique(number[index.needed[term]])
    use = np.isin(number, live)
    cells = np.unique(number[use] * len(index.terms) + term[use])
    if not len(cells):
        return
    number, term = cells // len(index.terms), cells % len(index.terms)
    starts = np.flatnonzero(np.append(True, np.diff(number) > 0))
    sizes = np.diff(np.append(starts, len(number)))
    for b, (own, matrix) in enumerate(index.blocks):
        bound = np.add.reduceat(index.peaks[b, term], starts)
        chosen = bound * 1.0001 >= index.least[b]
        if not chosen.any():
            continue
        mine = term[np.repeat(chosen, sizes)]
        found = np.searchsorted(own, mine)
        found[(found == len(own)) | (own[np.minimum(found, len(own) - 1)] != mine)] = len(own)  # the row of zeros
        padded = np.vstack([matrix, np.zeros((1, matrix.shape[1]))])
        scores = np.add.reduceat(padded[found], np.cumsum(sizes[chosen]) - sizes[chosen], axis=0)
        first, passages = b * BLOCK_ITEMS, number[starts[chosen]]
        for p, column in zip(*np.nonzero(scores >= index.floors[first : first + matrix.shape[1]] - 1e-9), strict=True):
            r = int(np.searchsorted(base, passages[p], "right") - 1)
            yield r, int(passages[p] - base[r]) * index.stride, first + int(column), float(scores[p, column])


def leaks(index: Index, column: pa.Array, overlap: float = OVERLAP) -> Iterator[tuple[int, int, float, float, float]]:
    """(row, item position, best score, question overlap, answer overlap) of confirmed items of each text, once each."""
    for first, _, data, offsets in utf8_blocks(pc.utf8_lower(column)):
        words, at = word_hashes(data, offsets)
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        for row, start, item, score in search(index, words, at):
            passage = words[at[row] + start : min(at[row] + start + 2 * index.stride, at[row + 1])]
            parts = index.parts[item]
            held = [held_words(part, passage) for part in parts]
            spare = edits_of(index.lengths[item])
            if all(h >= min(overlap * len(part), len(part) - spare) - 1e-9 for h, part in zip(held, parts, strict=True)):
                shares = [h / len(part) for h, part in zip(held, parts, strict=True)]
                best[row, item] = max(best.get((row, item), (0.0, 0.0, 0.0)), (score, *shares))
        for (row, item), found in sorted(best.items()):
            yield first + row, item, *found


def _measured(items: DataFrame) -> DataFrame:
    """item_id, text, n_words and distinct terms of each item with a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _hashes(batch.column(1).to_pylist())
            keep = [i for i, w in enumerate(words) if len(w)]
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c).take(pa.array(keep, pa.int64())) for c in (0, 1)], pa.array([len(words[i]) for i in keep], pa.int64()),
                pa.array([np.unique(words[i]).view(np.int64) for i in keep], pa.list_(pa.int64()))], ["item_id", "text", "n_words", "terms"])

    source = items.filter("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    return source.mapInArrow(run, "item_id long, text string, n_words long, terms array<long>")


def indexes(items: DataFrame) -> Iterator[Index]:
    """Indexes over chunks of the items, so that none is larger than CHUNK_ITEMS items and about CHUNK_BYTES of text.

    Frequencies and lengths are those of all items, counted in Spark; the driver fetches them for the terms of one chunk at
    a time. The step of passages follows from an item alone, and a chunk holds items of one step. So neither scores nor
    found items depend on how the items are cut, and one long item doesn't widen the passages of the others.
    """
    spark = items.sparkSession
    read = stage(_measured(items), "items")
    count, total = read.agg(F.count("*"), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    if not count:
        return
    frequency = stage(read.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")), "frequencies")

    def all_items(terms: np.ndarray) -> Statistics:
        own = spark.createDataFrame(pa.table({"term": terms.view(np.int64)}))
        found = frequency.join(F.broadcast(own), "term").toArrow()
        return Statistics(count, total, dict(zip(found["term"].to_pylist(), found["n"].to_pylist(), strict=True)))

    chunk: list[tuple[int, str]] = []
    size, step = 0, 0
    rows = read.select("item_id", "text", "n_words").orderBy("n_words", "item_id", "text")
    for r in rows.toLocalIterator():
        if chunk and (len(chunk) >= CHUNK_ITEMS or size + len(r["text"]) > CHUNK_BYTES or stride_of(r["n_words"]) != step):
            yield build(chunk, all_items=all_items)
            chunk, size = [], 0
        chunk.append((r["item_id"], r["text"]))
        size, step = size + len(r["text"]), stride_of(r["n_words"])
    yield build(chunk, all_items=all_items)


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """A row for each document row and benchmark item found in it: doc_id, item_id, bm25, question_overlap, answer_overlap, contaminated.

    Every passage of every document is a query. A null or empty text or item matches nothing; repeated rows are reported
    each, repeated items each; without items or documents there are no rows; other columns are ignored. An index is
    bounded, and more items mean more passes over the documents, but the same rows.
    """
    schema = "doc_id long, item_id long, bm25 double, question_overlap double, answer_overlap double, contaminated boolean"
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = docs.sparkSession.createDataFrame([], schema)
    for index in indexes(items):
        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = list(leaks(index, batch.column(1)))
                ids = batch.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[f[0]] for f in found], pa.int64()), pa.array([index.items[f[1]] for f in found], pa.int64()),
                    *[pa.array([f[i] for f in found], pa.float64()) for i in (2, 3, 4)], pa.array([True] * len(found), pa.bool_())],
                    ["doc_id", "item_id", "bm25", "question_overlap", "answer_overlap", "contaminated"])
        part = source.mapInArrow(run, schema)
        out = part if out.isLocal() else out.unionByName(part)
    return out


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found. Columns stay as they are."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    kept, at = docs.withColumnsRenamed(names), docs.columns.index("text")
    for index in indexes(items):
        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[f[0] for f in leaks(index, batch.column(at))]] = False
                yield batch.filter(pa.array(clean))
        kept = kept.mapInArrow(run, kept.schema)
    return kept.withColumnsRenamed({v: k for k, v in names.items()})
