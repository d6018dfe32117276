"""Toxicity scores from non-negative positive-unlabelled learning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import _LOWER, Rolling, utf8_blocks, word_spans

BITS = 20  # features are hashed to 2**BITS weights
SAMPLE = 6000  # documents at most of each of: confirmed toxic, unlabelled
PREFIXES = (2, 3, 4, 5, 6, 7)  # bytes of word beginnings, besides whole words


def features(data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted (row, feature) pairs, each once: whole words in lower case without outer ASCII signs, and their beginnings.

    With ``wanted`` (a mask over features) only those are returned.
    """
    data = _LOWER[data]
    starts, ends, _ = word_spans(data, offsets)
    letter = ((data >= 97) & (data <= 122)) | ((data >= 48) & (data <= 57)) | (data >= 128)
    for _ in range(3):  # outer quotes, brackets, stops
        live = ends > starts
        starts = starts + (live & ~letter[np.minimum(starts, len(data) - 1)]) if len(data) else starts
        live = ends > starts
        ends = ends - (live & ~letter[np.maximum(ends - 1, 0)]) if len(data) else ends
    keep = ends > starts
    starts, ends = starts[keep], ends[keep]
    row = np.searchsorted(offsets, starts, "right") - 1
    rolling, cells = Rolling(data), []
    for size in (0, *PREFIXES):
        use = ends - starts > size if size else np.ones(len(starts), bool)
        a, b = starts[use], (starts[use] + size if size else ends[use])
        with np.errstate(over="ignore"):
            feature = ((rolling.spans(a, b) + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).astype(np.int64)
        if wanted is not None:
            hit = wanted[feature]
            cells.append((row[use][hit] << BITS) | feature[hit])
        else:
            cells.append((row[use] << BITS) | feature)
    cells = np.unique(np.concatenate(cells))
    return cells >> BITS, cells & ((1 << BITS) - 1)


def sampled(docs: DataFrame, labels: DataFrame, size: int) -> tuple[list[tuple[int, bytes]], float]:
    """The class prior, and (1 for confirmed toxic or 0 for unlabelled, packed features) of bounded samples of the learned fold's labelled rows.

    Rows of the fold are those whose crc32(doc_id) modulo 3 is not 1. The positive sample is drawn from the toxic ones, the
    unlabelled sample from all of them whatever their label; both by a hash of doc_id, at most ``size`` each.
    """
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1, F.lit(False))
    marked = labels.filter(fold & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = [
        marked.filter(F.col("toxic") == 1).orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(size).select("doc_id", F.lit(1).alias("kind")),
        marked.orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id").limit(size).select("doc_id", F.lit(0).alias("kind")),
    ]
    wanted = chosen[0].unionByName(chosen[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = batch.column("kind")
            for first, last, data, offsets in utf8_blocks(batch.column("text")):
                row, feature = features(data, offsets)
                at = np.searchsorted(row, np.arange(last - first + 1))
                packed = [feature[at[i] : at[i + 1]].astype("<u4").tobytes() for i in range(last - first)]
                yield pa.RecordBatch.from_arrays([kinds[first:last], pa.array(packed, pa.binary())], ["kind", "features"])

    # at most 2 x size ids, so the small side of the join has a proven bound
    rows = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id").select("kind", "text").mapInArrow(run, "kind int, features binary").collect()
    prior = marked.agg(F.avg("toxic")).first()[0] or 0.0
    distinct = sorted({(r["kind"], bytes(r["features"])) for r in rows})  # copies of a text must not count as evidence
    return distinct, float(prior)


def fit(sample: list[tuple[int, bytes]], prior: float, rounds: int = 150, keep: int = 1 << 12) -> tuple[np.ndarray, np.ndarray, float]:
    """(feature ids, weights, bias) of a logistic model that minimises the non-negative positive-unlabelled risk.

    risk = prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives)); where the bracket would be negative its
    gradient is reversed. Features are presence in the document, weighed by their rarity; full-batch Adam with decay.
    """
    kinds = np.array([k for k, _ in sample])
    if not len(kinds) or not kinds.any() or kinds.all() or not 0 < prior < 1:
        return np.zeros(0, np.int64), np.zeros(0), float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    arrays = [np.frombuffer(f, "<u4") for _, f in sample]
    positive, unlabelled = kinds == 1, kinds == 0

    def share(members: np.ndarray) -> np.ndarray:  # of documents with each feature
        seen = np.zeros(1 << BITS)
        for i in np.flatnonzero(members):
            seen[arrays[i]] += 1
        return seen / members.sum()

    in_positive, in_all = share(positive), share(unlabelled)
    # features that tell: several times as frequent among the positives as in all, beyond chance
    spread = np.sqrt((in_all * (1 - in_all) + 1e-4) * (1 / positive.sum() + 1 / unlabelled.sum()))
    surprise = np.where(in_positive > 2.5 * in_all + 0.002, (in_positive - in_all) / spread, 0)
    ids = np.sort(np.argsort(-surprise, kind="stable")[:keep])
    ids = ids[surprise[ids] > 6]
    place = np.full(1 << BITS, -1, np.int32)
    place[ids] = np.arange(len(ids))
    known = [place[x][place[x] >= 0] for x in arrays]
    row, column = np.repeat(np.arange(len(known)), [len(x) for x in known]), np.concatenate(known)
    scale = 1 / np.sqrt(in_all[ids] + 0.05)
    value = scale[column]
    weights, bias = np.zeros(len(ids)), float(np.log(prior / (1 - prior)))
    m, v, step = np.zeros(len(ids) + 1), np.zeros(len(ids) + 1), 0.02
    for t in range(1, rounds + 1):
        logit = np.bincount(row, weights[column] * value, len(kinds)) + bias
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        loss_negative = -np.log(np.maximum(1 - p, 1e-12))
        bracket = loss_negative[unlabelled].mean() - prior * loss_negative[positive].mean()
        slope = np.zeros(len(kinds))
        slope[positive] = prior * (p[positive] - 1) / positive.sum()
        sign = 1.0 if bracket >= 0 else -1.0
        if bracket < 0:
            slope[positive] = 0
        slope[unlabelled] += sign * p[unlabelled] / unlabelled.sum()
        slope[positive] -= sign * prior * p[positive] / positive.sum()
        gradient = np.append(np.bincount(column, slope[row] * value, len(ids)) + 1e-6 * weights, slope.sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        move = step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return ids, weights * scale, bias


def score_toxicity(docs: DataFrame, labels: DataFrame, size: int = SAMPLE, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text.

    The model is fitted on a bounded sample (``size`` documents of each kind) of the learned fold and holds at most 4,096
    weights. A null or empty text gets the score of a text without features; without toxic labels every score is the prior's.
    Repeated rows get equal scores; an empty table gives no rows; other columns are ignored; held_out is false for a null doc_id.
    """
    sample, prior = sampled(docs, labels, size)
    ids, weights, bias = fit(sample, prior)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << BITS)
        table[ids] = weights
        wanted = table != 0
        for batch in batches:
            logit = np.full(batch.num_rows, bias)
            for first, last, data, offsets in utf8_blocks(batch.column("text")):
                row, feature = features(data, offsets, wanted)
                logit[first:last] += np.bincount(row, table[feature], last - first)
            score = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
