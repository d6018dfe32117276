"""Removal of every byte that lies in a string of 200 bytes that also starts elsewhere."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Rolling, slices, stage, texts_of, utf8_blocks

LENGTH = 200  # bytes of a repeated string
LEAD = 64  # bytes by which suffixes are dealt out and first compared
CROWD = 20_000  # different surroundings of one lead that one task compares; beyond, its windows are compared by a shuffle


def zones(data: np.ndarray, offsets: np.ndarray, length: int, lead: int) -> tuple[np.ndarray, ...]:
    """(row, low, high, lead hash, zone hash) of each zone of a block; low and high count from the row's start.

    A window is any ``length`` bytes of one row. The window's suffix of interest starts where its ``lead`` bytes have the
    smallest hash in the window (the first of equals), which its content alone decides. Consecutive windows with one
    such start form a zone, windows low to high; so equal windows lie in zones of equal leads at equal distances.
    """
    n, span = len(data), length - lead + 1
    sizes = np.diff(offsets)
    if n < length or not (sizes >= length).any():
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    starts = np.arange(n - lead + 1)
    hashes = Rolling(data).spans(starts, starts + lead)
    bits = np.uint64(max(20, n.bit_length()))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    ordered = (hashes & ~mask) | starts.astype(np.uint64)
    padded = np.full(-(-len(ordered) // span) * span, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(ordered)] = ordered
    grid = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - length + 1
    chosen = (np.minimum(behind[:windows], ahead[span - 1 : span - 1 + windows]) & mask).astype(np.int64)
    change = np.zeros(n + 1, np.int64)
    whole = sizes >= length
    np.add.at(change, offsets[:-1][whole], 1)
    np.add.at(change, offsets[1:][whole] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(change)[:windows])
    picked = chosen[at]
    fresh = np.append(True, (np.diff(at) != 1) | (np.diff(picked) != 0))
    first = np.flatnonzero(fresh)
    low, high, anchor = at[first], at[np.append(first[1:], len(at)) - 1], picked[first]
    with np.errstate(over="ignore"):
        zone = Rolling(data, 1).spans(low, high + length) + (anchor - low).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    row = np.searchsorted(offsets, low, "right") - 1
    return row, low - offsets[row], high - offsets[row], hashes[anchor], zone


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with _d and _h: id and text hash, which name a text. Rows that agree in both are copies."""
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    return docs.withColumn("_d", d).withColumn("_h", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))


def all_zones(docs: DataFrame, length: int, lead: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, h = batch.column("_d").to_numpy(), batch.column("_h").to_numpy()
            for first, _, data, offsets in utf8_blocks(batch.column("text")):
                row, low, high, lead_hash, zone_hash = zones(data, offsets, length, lead)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (lead_hash.view(np.int64), zone_hash.view(np.int64), d[first + row], h[first + row], low, high)], ["a", "c", "_d", "_h", "low", "high"])

    return keyed(docs.select("doc_id", "text")).select("_d", "_h", "text").mapInArrow(run, "a long, c long, _d long, _h long, low long, high long")


def _runs(repeated: np.ndarray, owner: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, start, end) of the byte runs under consecutive repeated windows."""
    owner, at = owner[repeated], at[repeated]
    if not len(at):
        return owner, at, at
    first = np.flatnonzero(np.append(True, (np.diff(owner) != 0) | (np.diff(at) != 1)))
    last = np.append(first[1:], len(at)) - 1
    return owner[first], at[first], at[last] + length


def _windows(table: pa.Table | pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(zone, position in the text, hash) of each window of the zones' bytes."""
    column = table.column("bytes")
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_binary())
    _, offsets, raw = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data, at = np.frombuffer(raw, np.uint8)[at[0] : at[-1]], at - at[0]
    counts = np.maximum(np.diff(at) - length + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = at[owner] + within
    return owner, table.column("low").to_numpy()[owner] + within, Rolling(data).spans(starts, starts + length)


def compared(pieces: DataFrame, length: int) -> DataFrame:
    """(_d, _h, start, end): repeated runs inside zones whose lead repeats while their whole content does not.

    The zones' suffixes are range-partitioned by their leads with sampled splitters and sorted; equal leads are always
    in one bucket, whole in a task. There all windows of a lead are sorted and neighbours compared.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of the lead that may go on in the next batch

        def found(table: pa.Table) -> pa.RecordBatch:
            owner, position, hashes = _windows(table, length)
            order = np.argsort(hashes, kind="stable")
            same = np.diff(hashes[order]) == 0 if len(order) else np.zeros(0, bool)
            repeated = np.zeros(len(order), bool)
            repeated[order[1:][same]] = True
            repeated[order[:-1][same]] = True
            repeated &= table.column("single").to_numpy()[owner]
            zone, start, end = _runs(repeated, owner, position, length)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (table.column("_d").to_numpy()[zone], table.column("_h").to_numpy()[zone], start, end)], ["_d", "_h", "start", "end"])

        for batch in batches:
            leads = batch.column("a").to_numpy()
            cut = int(np.searchsorted(leads, leads[-1], "left")) if len(leads) else 0
            if cut:
                yield found(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            if len(leads):
                if held and held[0].column("a")[0].as_py() != leads[0]:
                    yield found(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(cut))
        if held:
            yield found(pa.Table.from_batches(held))

    dealt = pieces.repartitionByRange(slices(pieces.sparkSession), "a").sortWithinPartitions("a")
    return dealt.mapInArrow(run, "_d long, _h long, start long, end long")


def compared_crowd(pieces: DataFrame, length: int) -> DataFrame:
    """As ``compared``, for leads with any number of surroundings: a row for each window, counted by its hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, position, hashes = _windows(batch, length)
            yield pa.RecordBatch.from_arrays([
                pa.array(hashes.view(np.int64)), pa.array(batch.column("single").to_numpy(zero_copy_only=False)[owner]),
                *[pa.array(batch.column(c).to_numpy()[owner]) for c in ("_d", "_h")], pa.array(position)], ["w", "single", "_d", "_h", "start"])

    rows = pieces.mapInArrow(run, "w long, single boolean, _d long, _h long, start long")
    repeated = rows.groupBy("w").agg(F.count("*").alias("n")).filter("n > 1").select("w")
    return rows.filter("single").join(repeated, "w").select("_d", "_h", "start", (F.col("start") + length).alias("end"))


def with_spans(docs: DataFrame, length: int = LENGTH, lead: int = LEAD) -> DataFrame:
    """``docs`` with _spans: byte ranges (start, end) to remove, possibly overlapping and in any order; null for none.

    1. Each text is cut into zones; zones whose lead occurs once in the corpus hold no repeated window and go.
    2. A zone whose whole content occurs again is repeated throughout.
    3. Of the others, and one example of each repeated content, the bytes are fetched and windows compared.
    """
    every = stage(all_zones(docs, length, lead), "zones")
    again = every.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").select("a")
    shared = stage(every.join(again, "a"), "shared")
    contents = shared.groupBy("a", "c").agg(F.count("*").alias("n"), F.min(F.struct("_d", "_h", "low", "high")).alias("one"))
    contents = stage(contents, "contents")
    whole = shared.join(contents.filter("n > 1").select("a", "c"), ["a", "c"]).select("_d", "_h", F.col("low").alias("start"), (F.col("high") + length).alias("end"))
    mixed = contents.groupBy("a").agg(F.count("*").alias("m")).filter("m > 1")
    asked = contents.join(mixed, "a").select("a", "m", (F.col("n") == 1).alias("single"), "one.*")
    asked = asked.groupBy("_d", "_h").agg(F.collect_list(F.struct("a", "m", "single", "low", "high")).alias("_asked"))  # bounded by the text
    source = keyed(docs)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("m", pa.int64()), ("single", pa.bool_()), ("_d", pa.int64()), ("_h", pa.int64()), ("low", pa.int64()), ("bytes", pa.binary())])
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                rows: list[tuple] = []
                for d, h, text, wanted in zip(*[part.column(c).to_pylist() for c in ("_d", "_h")], texts_of(part.column("text")), part.column("_asked").to_pylist(), strict=True):
                    raw = text.encode("utf-8")
                    rows += [(z["a"], z["m"], z["single"], d, h, z["low"], raw[z["low"] : z["high"] + length]) for z in wanted]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 7, schema, strict=True)], schema=schema)

    fetched = source.join(asked, ["_d", "_h"]).select(*source.columns, "_asked").mapInArrow(
        fetch, "a long, m long, single boolean, _d long, _h long, low long, bytes binary")
    fetched = stage(fetched, "suffixes")
    spans = whole.unionByName(compared(fetched.filter(F.col("m") <= CROWD), length)).unionByName(compared_crowd(fetched.filter(F.col("m") > CROWD), length))
    spans = spans.groupBy("_d", "_h").agg(F.collect_set(F.struct("start", "end")).alias("_spans"))  # bounded by the text
    return source.join(spans, ["_d", "_h"], "left").select(*docs.columns, "_spans")


def _cut(raw: bytes, spans: list | None) -> tuple[bytes, int]:
    """(what remains, number of maximal removed runs)."""
    kept, runs, reached, done = [], 0, 0, -1
    for span in sorted((s["start"], s["end"]) for s in spans or ()):
        if span[0] > done:  # neither overlaps nor touches the run before
            runs += 1
            kept.append(raw[reached : span[0]])
        done = max(done, span[1])
        reached = done
    return b"".join([*kept, raw[max(reached, 0) :]]), runs


def repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row.

    A null text is empty; a text under ``length`` bytes keeps all; a copy of a longer text loses all, the first one too.
    Rows that repeat id and text are copies. An empty table gives no rows; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                raw = [t.encode("utf-8") for t in texts_of(part.column(1))]
                cut = [_cut(r, s) for r, s in zip(raw, part.column(2).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(r) for r in raw], pa.int64()), pa.array([len(r) - len(k) for r, (k, _) in zip(raw, cut, strict=True)], pa.int64()),
                    pa.array([n for _, n in cut], pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k, _ in cut], pa.string())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), length)
    return found.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """All rows of ``docs`` with the repeated bytes cut from text; n_chars, where there is one, follows. Null stays null.

    A character of which some bytes go, goes whole. Other columns stay as they are.
    """
    names = {c: c if c in ("doc_id", "text") else f"_c{i}" for i, c in enumerate(docs.columns)}  # none clashes with ours
    text, count = docs.columns.index("text"), docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns[:-1])
            made = [None if t is None else _cut(t.encode("utf-8"), s)[0].decode("utf-8", "ignore") if s else t
                    for t, s in zip(columns[text].to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True)]
            columns[text] = pa.array(made, columns[text].type)
            if count is not None:
                columns[count] = pa.array([n if t is None else len(t) for t, n in zip(made, columns[count].to_pylist(), strict=True)], columns[count].type)
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(batch.schema)[:-1]))

    renamed = docs.withColumnsRenamed(names)
    return with_spans(renamed, length).mapInArrow(run, renamed.schema).withColumnsRenamed({v: k for k, v in names.items()})
