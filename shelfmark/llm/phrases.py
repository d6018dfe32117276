"""Collocations by dynamic itemset counting: cyclic scans of shards, longer phrases joining in as soon as their parts are frequent."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Rolling, mix, ranked, stage, utf8_blocks, _LOWER

SHARDS = 3  # steps of a cycle; each step is a Spark job over its shard
LONGEST, LEAST, TOP = 5, 100, 2000
TABLE_BITS = 24  # a byte for each of 2**24 slots: a size that doesn't grow with the data
BLOCK_WORDS = 1 << 20

_SALTS = [np.uint64(x) for x in (0x9DDFEA08EB382D69, 0xC3A5C85C97CB3127, 0xB492B66FBE98F273, 0x9AE16A3B2F90404F, 0xCBF29CE484222325)]
_OTHER = [np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x87C37B91114253D5, 0x4CF5AD432745937F)]
_BETWEEN, _BREAK = np.zeros(256, bool), np.zeros(256, bool)
_BETWEEN[[0x20, 0x09]] = True
_BREAK[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = True
_ZERO = np.zeros(1, np.uint64)


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word of a block, and whether it is the last one of its piece."""
    breaks = _BREAK[data]
    inside = ~(_BETWEEN[data] | breaks)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    outside = ~np.concatenate(([False], inside, [False]))
    starts = np.flatnonzero(inside & (outside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside & (outside[2:] | edge[1:])) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    piece = np.concatenate(([0], np.cumsum(breaks)))[starts] if len(starts) else starts
    last = np.ones(len(starts), bool)
    last[:-1] = (piece[1:] != piece[:-1]) | (rows[1:] != rows[:-1])
    return starts, ends, rows, last


def lang_hash(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def _word_ids(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.maximum(Rolling(data).spans(starts, ends), np.uint64(1))  # 0 parts pieces


def _with_breaks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Word ids of a block with a 0 after the last one of each piece, the place there of each word, and start, end, row of words."""
    starts, ends, rows, final = pieces(data, offsets)
    place = np.arange(len(starts)) + np.cumsum(final) - final
    words = np.zeros(len(starts) + int(final.sum()), np.uint64)
    words[place] = _word_ids(data, starts, ends)
    return words, place, starts, ends, rows, final


def _tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in utf8_blocks(batch.column("text")):
            with np.errstate(over="ignore"):
                words, _, _, _, rows, final = _with_breaks(_LOWER[data], offsets)
            each = np.bincount(rows, minlength=last - first)
            sizes = each + np.bincount(rows[final], minlength=last - first)
            at = np.concatenate(([0], np.cumsum(sizes) * 8)).astype(np.int64)
            held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), last - first, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(words.tobytes())])
            part = batch.slice(first, last - first)
            yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("shard"), held.cast(pa.binary()), pa.array(each)], ["lang", "shard", "words", "n"])


def _phrase_ids(words: np.ndarray, langs: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    total = langs[at]
    for j in range(k):
        total = total + mix(words[at + j] * _SALTS[j])
    return mix(total)


def _slots(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    shift = np.uint64(65 - size.bit_length())
    return ids >> shift, (ids * _SALTS[0]) >> shift


def _steps(table: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """1 + the step at which each phrase became frequent, or later; 0 if it surely did not."""
    one, two = _slots(ids, len(table))
    return np.minimum(table[one], table[two])


def _levels(words: np.ndarray, langs: np.ndarray, table: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For k = 1, 2 ...: the places of the phrases of k words both of whose parts are known, their ids, and the later of the
    steps of the two parts."""
    at = np.flatnonzero(words)
    later = np.zeros(len(at), np.uint8)
    for k in range(1, longest + 1):
        ids = _phrase_ids(words, langs, at, k)
        yield k, at, ids, later
        if k == longest:
            return
        step = np.zeros(len(words) + 1, np.uint8)
        step[at] = _steps(table, ids)
        at = np.flatnonzero((step[:-1] > 0) & (step[1:] > 0))
        at = at[at + k < len(words)]
        at = at[words[at + k] > 0]
        if not len(at):
            return
        later = np.maximum(step[at], step[at + 1])


def _surroundings(words: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """16 bits of a hash of the two words before and after each phrase, as far as its piece reaches."""
    padded = np.concatenate((_ZERO, _ZERO, words, _ZERO, _ZERO))
    before, after = padded[at + 1], padded[at + k + 2]
    total = mix(before * _OTHER[0]) + mix(after * _OTHER[1])
    total += mix(np.where(before > 0, padded[at], 0) * _OTHER[2]) + mix(np.where(after > 0, padded[at + k + 3], 0) * _OTHER[3])
    return (mix(total) >> np.uint64(48)).astype(np.int32)


def _scan(t: int, lengths: range, shards: int, table):
    """Count, in each block of texts, the phrases that are active at step ``t``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, np.uint64] = {}
        for batch in batches:
            langs = np.array([names.setdefault(x, lang_hash(x)) for x in batch.column("lang").to_pylist()], np.uint64)
            column = batch.column("words").cast(pa.large_binary())
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] // 8
            every = np.frombuffer(column.buffers()[2], np.uint64) if len(langs) and offsets[-1] else _ZERO[:0]
            first = 0
            while first < len(langs):
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK_WORDS, "right")) - 1)
                words = every[offsets[first] : offsets[last]]
                with np.errstate(over="ignore"):
                    salt = np.repeat(langs[first:last], np.diff(offsets[first : last + 1]))
                    for k, at, ids, later in _levels(words, salt, table.value, lengths.stop - 1):
                        if k in lengths and len(at):
                            if k > 1:
                                fresh = later.astype(np.int64) + shards > t  # the cycle began at step ``later``
                                at, ids, later = at[fresh], ids[fresh], later[fresh]
                            yield _counted(words, at, ids, later, k)
                first = last

    return run


def _counted(words: np.ndarray, at: np.ndarray, ids: np.ndarray, later: np.ndarray, k: int) -> pa.RecordBatch:
    order = np.argsort(ids)
    edges = np.flatnonzero(np.concatenate(([True], ids[order][1:] != ids[order][:-1]))) if len(ids) else order
    one = order[edges]
    where = np.minimum.reduceat(_surroundings(words, at, k)[order], edges) if len(ids) else np.zeros(0, np.int32)
    return pa.RecordBatch.from_arrays([
        pa.array(ids[one].view(np.int64)), pa.array(np.full(len(one), k, np.int32)),
        pa.array(later[one].astype(np.int32)), pa.array(where), pa.array(np.diff(np.append(edges, len(ids))))], ["id", "k", "start", "place", "found"])


def _chosen(ids: np.ndarray, where: np.ndarray) -> np.ndarray:
    """One number for a phrase and a place."""
    return mix(ids + where.astype(np.uint64) * _SALTS[1])


def _marks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(over="ignore"):
                ids = batch.column("id").to_numpy().view(np.uint64)
                if "place" in batch.schema.names:
                    ids = _chosen(ids, batch.column("place").to_numpy())
                at = np.concatenate(_slots(ids, size))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int32)), pa.array(np.left_shift(np.uint64(1), at & np.uint64(63)).view(np.int64))], ["place", "bit"])

    return run


def _occupied(phrases: DataFrame, size: int) -> np.ndarray:
    """Whether each slot holds one of the ids, or of the ids at their places; at most size / 64 rows come to the driver, however many phrases there are."""
    words = np.zeros(size // 64, np.uint64)
    bits = phrases.mapInArrow(_marks(size), "place int, bit long").groupBy("place").agg(F.bit_or("bit").alias("bits")).toArrow()
    words[bits["place"].to_numpy()] = bits["bits"].to_numpy().view(np.uint64)
    return np.unpackbits(words.view(np.uint8), bitorder="little").view(bool)


def _named(longest: int, table, places):
    """Names of phrases, from the places that were chosen for them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for first, last, data, offsets in utf8_blocks(batch.column("text")):
                data = _LOWER[data]
                with np.errstate(over="ignore"):
                    words, place, starts, ends, rows, _ = _with_breaks(data, offsets)
                    salt, word = np.zeros(len(words), np.uint64), np.zeros(len(words), np.int64)
                    salt[place] = np.array([lang_hash(x) for x in langs[first:last]], np.uint64)[rows]
                    word[place] = np.arange(len(place))
                    for k, at, ids, _ in _levels(words, salt, table.value, longest):
                        at, ids = (x[_steps(table.value, ids) > 0] for x in (at, ids))
                        where = _surroundings(words, at, k)
                        here = np.flatnonzero(_steps(places.value, _chosen(ids, where)) > 0)
                        here = here[np.unique(_chosen(ids[here], where[here]), return_index=True)[1]]
                        which = word[at[here]]
                        yield pa.RecordBatch.from_arrays([
                            pa.array(ids[here].view(np.int64)), pa.array(where[here]),
                            pa.array([langs[first + r] for r in rows[which].tolist()], pa.string()), _strings(data, starts, ends, which, k)], ["id", "place", "lang", "phrase"])

    return run


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, k: int) -> pa.Array:
    """The phrases of ``k`` words from word ``at`` on, words joined by one space."""
    data = np.append(data, np.uint8(0x20))
    first = np.full((len(at), 2 * k - 1), len(data) - 1)
    size = np.ones_like(first)
    for j in range(k):
        first[:, 2 * j], size[:, 2 * j] = starts[at + j], ends[at + j] - starts[at + j]
    offsets = np.concatenate(([0], np.cumsum(size.sum(axis=1)))).astype(np.int32)
    first, size = first.ravel(), size.ravel()
    before = np.cumsum(size) - size
    body = data[np.repeat(first - before, size) + np.arange(offsets[-1])]
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.tobytes()), pa.py_buffer(body.tobytes()))


def frequent_ids(texts: DataFrame, least: int, longest: int, shards: int, slots: int = 1 << TABLE_BITS) -> DataFrame:
    """(id, k, place, found) of the phrases with at least ``least`` occurrences in the staged texts.

    Step t scans shard t modulo ``shards``. Words are counted in the first cycle; a longer phrase from the step after both
    phrases one word shorter have reached ``least``, for one cycle. A table of fixed size tells the step at which a phrase
    became frequent. What it lets pass by mistake is rarer than ``least``, or is counted again with the same result, as each
    shard's count of a phrase is kept. A phrase goes by a 64-bit hash; its place is the smallest hash of the words around it.
    """
    context = texts.sparkSession.sparkContext
    key, counts = ["id", "k"], [f"c{s}" for s in range(shards)]
    total = sum((F.col(c) for c in counts[1:]), F.col(counts[0]))
    table = np.zeros(slots, np.uint8)
    active, done, newest = None, [], -shards
    for t in range(longest * shards):
        if t >= shards and newest + shards < t:
            break
        lengths = range(t // shards + 1, longest + 1)  # phrases of k words begin their cycle by step (k - 1) * shards
        shared = context.broadcast(table)
        found = texts.filter(F.col("shard") == t % shards).select("lang", "words").mapInArrow(
            _scan(t, lengths, shards, shared), "id long, k int, start int, place int, found long")
        found = found.groupBy(*key).agg(F.max("start").alias("start"), F.min("place").alias("place"), F.sum("found").alias("found"))
        found = found.select(*key, "start", "place", F.lit(None).cast("int").alias("reach"), *(F.col("found").alias(c) if s == t % shards else F.lit(0).cast("long").alias(c) for s, c in enumerate(counts)))
        if active is not None:
            found = active.unionByName(found).groupBy(*key).agg(
                F.max("start").alias("start"), F.min("place").alias("place"), F.min("reach").alias("reach"), *(F.max(c).alias(c) for c in counts))
        found = found.withColumn("reach", F.when(total >= least, F.coalesce("reach", F.lit(t))))
        open_ = F.col("start") + shards - 1 > t
        found = stage(found.filter(open_ | F.col("reach").isNotNull()), "counts")
        shared.destroy()
        active = found.filter(open_)
        done.append(found.filter(~open_))
        if t < longest * shards - 1:
            new = _occupied(found.filter((F.col("reach") == t) & (F.col("k") < longest)).select("id"), slots)
            table = np.where(new, np.uint8(t + 1), table)
            newest = t if new.any() else newest
    every = active
    for more in done:
        every = every.unionByName(more)
    every = every.groupBy(*key).agg(F.min("place").alias("place"), *(F.max(c).alias(c) for c in counts)).select(*key, "place", total.alias("found"))
    return stage(every.filter(F.col("found") >= least), "frequent")


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS, slots: int = 1 << TABLE_BITS) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, found) of the phrases with at least ``least`` occurrences, and (lang, n) with all word occurrences.

    Phrases are counted under hashes; a last scan of the texts names each frequent one, from the place kept with its count.
    """
    context = docs.sparkSession.sparkContext
    shard = (F.monotonically_increasing_id() % shards).cast("int")
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    texts = stage(docs.withColumn("shard", shard).mapInArrow(_tokenised, "lang string, shard int, words binary, n long"), "words", ["shard"])
    ids = frequent_ids(texts, least, longest, shards, slots)
    table, places = (context.broadcast(_occupied(ids.select(*x), slots).view(np.uint8)) for x in (["id"], ["id", "place"]))
    names = docs.mapInArrow(_named(longest, table, places), "id long, place int, lang string, phrase string")
    named = ids.join(names, ["id", "place"]).groupBy("id", "k", "found").agg(F.min(F.struct("lang", "phrase")).alias("name"))
    found = stage(named.select("name.*", "k", "found"), "phrases")
    return found, texts.groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, shards: int = SHARDS, slots: int = 1 << TABLE_BITS) -> DataFrame:
    """The ``top`` collocations of each lang: lang, rank, phrase, a, l, r, n, score.

    Words are runs of anything but space and tab in pieces between ``.,;:!?`` and line ends, A-Z lowered; a null text is empty,
    a null lang ``und``. Of each phrase of 2 to ``longest`` words with a >= ``least`` occurrences, the cut with the smallest
    floor(1000 * a * n / (l * r)) counts, then the earliest. A phrase goes if a longer one that holds it is as frequent. Ties go
    by a, then by the bytes of the phrase. Repeated rows count each; an empty table gives no rows; other columns are ignored.
    """
    all_, sizes = frequent_phrases(docs, least, longest, shards, slots)
    counts = all_.select("lang", "phrase", "found")
    candidates = all_.filter("k > 1").select("lang", "k", "phrase", F.col("found").alias("a"), F.split("phrase", " ").alias("words"))
    part = lambda start, size: F.array_join(F.slice("words", start, size), " ")
    cuts = candidates.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("head"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"))
    for name, side in (("l", "head"), ("r", "rest")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("found").alias(name)), ["lang", side])
    wide = "cast({} as decimal(38,0))".format
    score = F.expr(f"({wide(1000)} * {wide('a')} * {wide('n')}) div ({wide('l')} * {wide('r')})")
    cuts = cuts.join(sizes, "lang").withColumn("score", score)
    cuts = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))

    inner = candidates.filter("k > 2").select("lang", "k", "a", "words", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
    inner = inner.select("lang", F.array_join(F.slice("words", F.col("at"), F.col("size")), " ").alias("phrase"), "a")
    inner = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = cuts.join(inner, ["lang", "phrase"], "left").filter("longer is null or longer < a")
    kept = kept.select("lang", "phrase", "a", "n", "low.l", "low.r", "low.score")
    out = ranked(kept, "lang", [F.desc("score"), F.desc("a"), F.col("phrase")], "place").filter(F.col("place") < top)
    return out.select("lang", (F.col("place") + 1).alias("rank"), "phrase", "a", "l", "r", "n", "score")
