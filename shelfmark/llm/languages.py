"""Language identification by mixtures of n-gram models, fitted to each document by expectation-maximisation."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import SMALL_BLOCK, texts_of, utf8_blocks

BUCKETS = 1 << 14
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_FOLD = np.arange(256, dtype=np.uint8)  # lower case; ASCII that is no letter becomes a space
_FOLD[:128] = 32
_FOLD[65:91] = _FOLD[97:123] = np.arange(97, 123)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each three-byte gram of a block that lies in one row and holds no two spaces in a row."""
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    folded = _FOLD[data].astype(np.uint64)
    a, b, c = folded[:-2], folded[1:-1], folded[2:]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    good = (row[:-2] == row[2:]) & ~((a == 32) & (b == 32)) & ~((b == 32) & (c == 32))
    with np.errstate(over="ignore"):
        h = ((a << np.uint64(16)) | (b << np.uint64(8)) | c) * np.uint64(0x9E3779B97F4A7C15)
    return row[:-2][good], (h >> np.uint64(50)).astype(np.int64)[good]


def learned_rows(docs: DataFrame) -> DataFrame:
    """Rows whose crc32(doc_id) modulo 4 is not 2 and whose text and lang are not null."""
    return docs.filter(F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2, F.lit(False)) & F.col("text").isNotNull() & F.col("lang").isNotNull())


def gram_counts(docs: DataFrame) -> DataFrame:
    """lang, bucket, n over whole texts of all learned rows; summed inside each task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for first, last, data, offsets in utf8_blocks(batch.column("text"), SMALL_BLOCK):
                row, bucket = grams(data, offsets)
                names, codes = np.unique(langs[first:last].astype(str), return_inverse=True)
                counts = np.bincount(codes[row] * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(len(names), BUCKETS)
                for name, own in zip(names, counts, strict=True):
                    sums[str(name)] = sums.get(str(name), 0) + own
        for name, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(own[at])], ["lang", "bucket", "n"])

    parts = learned_rows(docs).select("text", F.col("lang").cast("string").alias("lang")).mapInArrow(run, "lang string, bucket long, n long")
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, smoothing: float = 0.5) -> tuple[list[str], np.ndarray]:
    """The learned languages and P(gram bucket | language), buckets x languages. Its size is languages x BUCKETS."""
    counts = gram_counts(docs).toPandas()
    names = sorted(counts["lang"].unique())
    table = np.zeros((BUCKETS, len(names)))
    table[counts["bucket"].to_numpy(np.int64), np.searchsorted(names, counts["lang"].to_numpy(str))] = counts["n"]
    return [str(n) for n in names], ((table + smoothing) / (table.sum(0) + smoothing * BUCKETS)).astype(np.float32)


def _fit(shares: np.ndarray, row: np.ndarray, chance: np.ndarray, n: np.ndarray, starts: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """EM of the language shares of consecutive rows; returns shares and log-likelihoods."""
    size = np.maximum(np.add.reduceat(n, starts), 1e-9)[:, None]
    for _ in range(rounds):
        whole = np.einsum("ik,ik->i", chance, shares[row])
        shares = shares * np.add.reduceat(chance * (n / np.maximum(whole, 1e-30))[:, None], starts, axis=0) / size
    whole = np.einsum("ik,ik->i", chance, shares[row])
    return shares, np.add.reduceat(n * np.log(np.maximum(whole, 1e-30)), starts)


def mixtures(row: np.ndarray, bucket: np.ndarray, rows: int, model: np.ndarray, penalty: float = 4.0, rounds: int = 10) -> np.ndarray:
    """Language shares (rows x languages) of each row's selected set; zero for rows without grams.

    EM over all languages orders them by share. The set grows from the first language along that order, each time
    refitted, while log-likelihood - penalty * log(1 + grams) * languages rises.
    """
    out = np.zeros((rows, model.shape[1]), np.float32)
    cells, n = np.unique(row * BUCKETS + bucket, return_counts=True)
    n = n.astype(np.float32)
    if not len(cells):
        return out
    owner, chance = cells // BUCKETS, model[cells % BUCKETS]
    present, starts, local = np.unique(owner, return_index=True, return_inverse=True)
    k = model.shape[1]
    full, _ = _fit(np.full((len(present), k), 1 / k, np.float32), local, chance, n, starts, rounds)
    order = np.argsort(-full, axis=1, kind="stable")
    cost = penalty * np.log1p(np.add.reduceat(n, starts))
    best, score = np.zeros_like(full), np.full(len(present), -np.inf)
    active = np.arange(len(present))
    for j in range(1, k + 1):
        allowed = np.zeros((len(active), k), bool)
        np.put_along_axis(allowed, order[active, :j], True, axis=1)
        start = np.where(allowed, np.maximum(full[active], 1e-3), 0)
        start /= start.sum(1, keepdims=True)
        position = np.full(len(present), -1)
        position[active] = np.arange(len(active))
        mine = np.flatnonzero(position[local] >= 0)
        where = position[local[mine]]
        shares, likelihood = _fit(start.astype(np.float32), where, chance[mine], n[mine], np.flatnonzero(np.append(True, np.diff(where) > 0)), 1 if j == 1 else rounds)
        value = likelihood - cost[active] * j
        better = value > score[active]
        best[active[better]], score[active[better]] = shares[better], value[better]
        active = active[better]
        if not len(active):
            break
    out[present] = best
    return out


def _predicted(source: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """The columns of ``source``, whose last one is text, with lang_pred and score."""
    names, table = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            predicted, scores = np.full(batch.num_rows, UNKNOWN, object), np.zeros(batch.num_rows)
            lettered = np.array([bool(_LETTER.search(t)) for t in texts_of(column)], bool)
            for first, last, data, offsets in utf8_blocks(column, SMALL_BLOCK):
                if not names:
                    break
                shares = mixtures(*grams(data, offsets), last - first, table)
                best = shares.argmax(1)
                own = lettered[first:last]
                predicted[first:last][own] = np.array(names, object)[best[own]]
                scores[first:last][own] = np.where(shares.sum(1) > 0, shares.max(1), 1 / len(names))[own]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(predicted.tolist(), pa.string()), pa.array(np.clip(scores, 0, 1))], schema=pa.schema(
                [*batch.schema, pa.field("lang_pred", pa.string()), pa.field("score", pa.float64())]))

    return source.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema) + ", lang_pred string, score double")


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray] | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every whole text.

    ``lang_pred`` is the largest share of the selected language set and ``score`` that share. A null text or one without
    a letter is ``und`` with score 0, as is every text when nothing could be learned; a text with letters but no gram takes
    the first language with an even share. Repeated rows get equal answers; an empty table gives no rows. held_out is false
    for a null doc_id, which is never learned from. The model has BUCKETS numbers for each learned language.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    return _predicted(source, model or learn(docs)).drop("text")


def identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text has a language: those found ``und`` go. Columns stay as they are."""
    rest = [c for c in docs.columns if c != "text"]
    source = docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(rest)], "text")
    found = _predicted(source, learn(docs)).filter(F.col("lang_pred") != UNKNOWN)
    back = {c: f"_c{i}" for i, c in enumerate(rest)} | {"text": "text"}
    return found.select(*[F.col(back[c]).alias(c) for c in docs.columns])
