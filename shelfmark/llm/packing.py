"""Packing of tokenised documents into sequences of bounded length."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ranked, stage, texts_of

TOKENIZER = "byte_bpe_50k"
LENGTH = 2048
# Characters on which both libraries' classes of letters, digits and white space surely agree; the second
# library reads the same vocabulary several times faster.
_PLAIN = re.compile(r"[^\t\n\r\x20-\x7e¡-ɏ‐-‧€]")
_SPECIAL = "<|endoftext|>"


class Ids:
    """Ids of the tokenizer file ``<name>.json`` without added special tokens.

    Plain text is encoded from the same vocabulary in ``<name>.tiktoken``, which gives equal ids (tested);
    text with other characters or with a special string goes to the tokenizer file itself.
    """

    def __init__(self, name: str):
        import base64
        import os

        import public_tokenizers
        import tiktoken

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        self.exact.no_truncation()
        self.exact.no_padding()
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if _SPECIAL in text or _PLAIN.search(text):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.fast.encode_ordinary(text), "<u4")


@lru_cache(maxsize=2)
def ids_of(name: str) -> Ids:
    return Ids(name)


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each document's ids and a closing 0, cut to ``length`` from its end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ids_of(tokenizer)
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                rows: list[tuple] = []
                for doc_id, text in zip(part.column(0).to_pylist(), texts_of(part.column(1)), strict=True):
                    ids = np.append(encode(text), np.uint32(0)).astype("<u4")
                    cuts = [0, *range(len(ids) % length or length, len(ids), length), len(ids)]
                    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                        rows.append((doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes())))
                columns = zip(*rows, strict=True) if rows else [[]] * 5
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def price_pattern(values: np.ndarray, supply: np.ndarray, room: int) -> dict[int, int]:
    """The most valuable pattern of at most ``room`` tokens: knapsack by dynamic programming.

    ``values`` and ``supply`` are indexed by length. A length may be taken as often as there are pieces of it and room for
    them; its copies are cut into lots of 1, 2, 4 ... so that any number is a choice of lots. best[c] is the value of the best
    pattern within c tokens.
    """
    lots = []
    for size in np.flatnonzero(supply)[::-1].tolist():
        copies, lot = min(int(supply[size]), room // size), 1
        while copies > 0:
            lots.append((size, min(lot, copies)))
            copies, lot = copies - lot, lot * 2
    best, taken = np.zeros(room + 1), np.zeros((len(lots), room + 1), bool)
    for i, (size, n) in enumerate(lots):
        span = size * n
        better = best[:-span] + values[size] * n
        taken[i, span:] = better > best[span:]
        np.maximum(best[span:], better, out=best[span:])
    pattern, left = Counter(), room
    for i in range(len(lots) - 1, -1, -1):
        if taken[i, left]:
            size, n = lots[i]
            pattern[size] += n
            left -= size * n
    return dict(pattern)


Patterns = list[tuple[dict[int, int], int]]


def _take(pattern: dict[int, int], times: int, left: np.ndarray, made: Patterns) -> None:
    """Place a pattern up to ``times``, as far as pieces are left."""
    times = min([times, *(int(left[s]) // n for s, n in pattern.items())])
    if times > 0 and pattern:
        for s, n in pattern.items():
            left[s] -= n * times
        made.append((pattern, times))


def _fractional(total: np.ndarray, room: int, rounds: int, step: float = 0.1) -> Patterns:
    """The configuration program over fractional multiplicities, by multiplicative weights, rounded down.

    Covered shares start at 0. Each round prices the best pattern under weights exp(-share / step) / count, gives it the
    multiplicity that covers ``step`` of its scarcest length, and raises the shares of what it holds. In the end the
    multiplicities are scaled so that no length is covered more than once, and rounded down; what that leaves is peeled.
    """
    sizes = np.flatnonzero(total)
    share, x = np.zeros(room + 1), Counter()
    lots = sum(max(1, room // int(size)).bit_length() for size in sizes)
    for _ in range(max(rounds, 100_000 // lots)):  # with few lengths a round is cheap, and each must be covered often
        weights = np.zeros(room + 1)
        weights[sizes] = np.exp(-(share[sizes] - share[sizes].min()) / step) / total[sizes]
        pattern = price_pattern(weights, total, room)
        amount = step * min(total[s] / n for s, n in pattern.items())
        for s, n in pattern.items():
            share[s] += n * amount / total[s]
        x[tuple(sorted(pattern.items()))] += amount
    cover = share[sizes].max()
    left, made = total.copy(), []
    for items, amount in sorted(x.items(), key=lambda e: -e[1]):
        _take(dict(items), int(amount / cover), left, made)
    return made + _peeled(left, room, rounds, 0.5, 0.0)


def _peeled(total: np.ndarray, room: int, rounds: int, rate: float, least: float) -> Patterns:
    """Patterns priced by length times weight, each placed at once for a share ``rate`` of its scarcest length, while the
    best one is at least ``least`` full."""
    left, made = total.copy(), []
    weights, lengths = np.ones(room + 1), np.arange(room + 1)
    for _ in range(rounds):
        if left.sum() < 64 or np.count_nonzero(left) < 2:
            break
        pattern = price_pattern(lengths * weights, left, room)
        if sum(s * n for s, n in pattern.items()) < room * least:
            break
        times = max(1, int(rate * min(left[s] // n for s, n in pattern.items())))
        for s, n in pattern.items():
            weights[s] *= (1 - 0.1) ** (n * times / max(1, total[s]) * 4)
        _take(pattern, times, left, made)
    return made


def _best_fit(left: np.ndarray, room: int) -> Patterns:
    """What rounding leaves, longest first into the fullest sequence that has room; equal sequences are handled at once."""
    open_bins: dict[int, Patterns] = {}
    for size in range(room, 0, -1):
        need = int(left[size])
        while need:
            space = min((s for s in open_bins if s >= size), default=None)
            if space is None:
                fit = min(room // size, need)
                bins, rest = divmod(need, fit)
                open_bins.setdefault(room - fit * size, []).append(({size: fit}, bins))
                if rest:
                    open_bins.setdefault(room - rest * size, []).append(({size: rest}, 1))
                break
            pattern, bins = open_bins[space].pop()
            if not open_bins[space]:
                del open_bins[space]
            fit = min(space // size, -(-need // bins))
            use = min(bins, need // fit)
            if use < bins:
                open_bins.setdefault(space, []).append((pattern, bins - use))
            open_bins.setdefault(space - fit * size, []).append((pattern | {size: pattern.get(size, 0) + fit}, use))
            need -= fit * use
    return [(pattern, times) for entries in open_bins.values() for pattern, times in entries if times]


def least_sequences(histogram: dict[int, int], room: int) -> int:
    """A bound from below: all tokens, and pieces of which no two fit together."""
    return max(-(-sum(s * n for s, n in histogram.items()) // room), sum(n for s, n in histogram.items() if 2 * s > room))


def solve(histogram: dict[int, int], room: int, rounds: int = 120) -> Patterns:
    """Patterns with whole multiplicities that hold every item of the histogram exactly once.

    The configuration program (fewest patterns that cover each length's count) is solved by multiplicative weights with
    knapsack pricing: over fractional multiplicities, rounded down, and with multiplicities rounded as they are taken, full
    patterns first or any. What rounding leaves is put best-fit. The solution with the fewest sequences counts; one that
    meets the bound from below ends the search. The work depends on ``room`` and ``rounds``, not on the number of documents.
    """
    total = np.zeros(room + 1, np.int64)
    for size, n in histogram.items():
        total[size] = n
    whole = [({room: 1}, int(total[room]))] if total[room] else []
    total[room] = 0
    bound = least_sequences({int(s): int(total[s]) for s in np.flatnonzero(total)}, room)
    if not bound:
        return whole
    ways = (lambda: _peeled(total, room, rounds, 0.5, 0.999), lambda: _peeled(total, room, rounds, 0.5, 0.0),
            lambda: _peeled(total, room, rounds, 1.0, 0.0), lambda: _fractional(total, room, rounds), lambda: [])
    best = None
    for way in ways:
        made = way()
        left = total.copy()
        for pattern, times in made:
            for s, n in pattern.items():
                left[s] -= n * times
        made = made + _best_fit(left, room)
        if best is None or sum(t for _, t in made) < sum(t for _, t in best):
            best = made
        if sum(t for _, t in best) == bound:
            break
    return whole + best


def place_table(patterns: list[tuple[dict[int, int], int]], room: int) -> dict[str, np.ndarray]:
    """For each length, runs of ranks: the sequence and offset of the first, and how many stand in one sequence."""
    rows, used, sequence = [], Counter(), 0
    for pattern, times in patterns:
        offset = 0
        for size in sorted(pattern, reverse=True):
            each = pattern[size]
            rows.append((size, used[size], each, sequence, offset))
            used[size] += each * times
            offset += each * size
        sequence += times
    rows.sort()
    size, first, each, start, offset = (np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 5
    edges = np.searchsorted(size, np.arange(room + 2))
    return {"first": first, "each": each, "start": start, "offset": offset, "edges": edges}


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, length: int = LENGTH) -> DataFrame:
    """Pack whole documents into sequences of at most ``length`` tokens; only longer documents are cut.

    Returns a row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null or empty text is the
    closing id alone. Repeated rows are packed each; an empty table gives no rows; other columns are ignored. Tokens
    are made once and only their lengths staged; the driver sees the length histogram (at most ``length`` rows); a
    piece finds its place from its rank among pieces of its length.
    """
    cut = stage(pieces(docs, tokenizer, length), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = place_table(solve(histogram, length), length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            low, high = table["edges"][size], table["edges"][size + 1]
            while (low + 1 < high).any():  # last run that starts at or below the rank
                middle = (low + high) // 2
                right = (middle < high) & (table["first"][np.minimum(middle, len(table["first"]) - 1)] <= rank)
                low, high = np.where(right & (low + 1 < high), middle, low), np.where(~right & (low + 1 < high), middle, high)
            nth = rank - table["first"][low]
            sequence = table["start"][low] + nth // table["each"][low]
            offset = table["offset"][low] + nth % table["each"][low] * size
            keep = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    placed = ranked(cut, "length", [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], "_rank")
    return placed.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
