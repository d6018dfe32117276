"""Homomorphic multiset fingerprints of documents, and of documents edited with their neighbour's text."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import mix, slices

STRICT = 16  # lanes modulo 2**32 of each paragraph's digest: equality
SOFT = 128  # lanes modulo 2**32 of each paragraph's signed features: likeness; no text has 2**31 windows
_WINDOW = 16  # bytes of one feature


def vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The two sums over each text's paragraphs (its lines): (rows x STRICT) uint32 and (rows x SOFT) uint32.

    A paragraph's vector depends on the paragraph alone, so the sum ignores their order, and adding or
    subtracting a paragraph's vector inserts or deletes it. The strict part hashes the whole paragraph; the soft
    part counts every 16-byte window of it, up or down by one, in a lane.
    """
    strict, soft = np.zeros((len(texts), STRICT), np.uint32), np.zeros((len(texts), SOFT), np.uint32)
    first = 0
    while first < len(texts):
        last, size = first, 0
        raw: list[bytes] = []
        while last < len(texts) and (not raw or size < 1 << 19):
            raw.append(texts[last].encode("utf-8"))
            size += len(raw[-1])
            last += 1
        digests, counts = [], []
        for text in raw:
            lines = text.split(b"\n") if text else []
            counts.append(len(lines))
            digests += [hashlib.blake2b(line, digest_size=4 * STRICT).digest() for line in lines]
        sums = np.zeros((len(digests) + 1, STRICT), np.uint32)
        if digests:
            np.cumsum(np.frombuffer(b"".join(digests), "<u4").reshape(-1, STRICT), axis=0, dtype=np.uint32, out=sums[1:])
        ends = np.cumsum(counts)
        strict[first:last] = sums[ends] - sums[ends - np.array(counts)]
        # each paragraph is followed by zeros, so that no window reaches into the next one; NUL bytes become a space
        padded = [text.replace(b"\0", b" ").replace(b"\n", bytes(_WINDOW)) + bytes(_WINDOW) for text in raw]
        owner = np.repeat(np.arange(last - first), [len(p) for p in padded])
        data = b"".join(padded) + bytes(_WINDOW)
        n = len(data) - _WINDOW
        words = np.ndarray((n + 8,), "<u8", data, strides=(1,))
        at = np.flatnonzero(np.frombuffer(data, np.uint8, n))
        with np.errstate(over="ignore"):
            h = mix(words[at] * np.uint64(0x9E3779B97F4A7C15) + words[at + 8] * np.uint64(0xC2B2AE3D27D4EB4F))
        lane = owner[at] * SOFT + (h & np.uint64(SOFT - 1)).astype(np.int64)
        signed = np.bincount(lane, 1.0 - 2.0 * (h >> np.uint64(63)).astype(np.float64), (last - first) * SOFT)
        soft[first:last] = signed.astype(np.int64).astype(np.uint32).reshape(-1, SOFT)
        first = last
    return strict, soft


def encoded(strict: np.ndarray, soft: np.ndarray) -> list[str]:
    return [base64.b64encode(a.astype("<u4").tobytes() + b.astype("<u4").tobytes()).decode() for a, b in zip(strict, soft, strict=True)]


def decoded(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    raw = base64.b64decode(fingerprint)
    return np.frombuffer(raw[: 4 * STRICT], "<u4"), np.frombuffer(raw[4 * STRICT :], "<u4")


def changed(fingerprint: str, insert: list[str] = (), delete: list[str] = ()) -> str:
    """The fingerprint after paragraphs are inserted and deleted, without the text."""
    strict, soft = (x.copy() for x in decoded(fingerprint))
    for paragraphs, sign in ((insert, 1), (delete, -1)):
        for paragraph in paragraphs:
            a, b = vectors([paragraph])
            strict += a[0] if sign > 0 else -a[0]
            soft += b[0] if sign > 0 else -b[0]
    return encoded(strict[None], soft[None])[0]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of common features, 0 to 1, of pairs of soft vectors: twice their product over the sum of squares."""
    x, y = a.astype(np.uint32).view(np.int32).astype(np.float64), b.astype(np.uint32).view(np.int32).astype(np.float64)
    squares = (x * x).sum(1) + (y * y).sum(1)
    return np.where(squares > 0, np.clip(2 * (x * y).sum(1) / np.maximum(squares, 1), 0, 1), 1.0)


def with_neighbours(docs: DataFrame) -> DataFrame:
    """doc_id and text dealt into id ranges, each followed by the first row of the next range (``_head``).

    The ranges come from approximate quantiles of doc_id; the first rows are found from the ids alone and picked
    by id, one a range, so texts are shuffled once. Inside a range rows are sorted by doc_id (null first), then text.
    """
    from pyspark.ml.feature import Bucketizer

    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    source = source.withColumn("_key", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))))
    n = slices(spark)
    cuts = source.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 10000)).first()[0] or []
    splits = [float("-inf"), *sorted({float(c) for c in cuts} or {0.0}), float("inf")]
    ranged = Bucketizer(splits=splits, inputCol="_key", outputCol="_range", handleInvalid="keep").transform(source)
    ranged = ranged.withColumn("_range", F.col("_range").cast("int"))
    starts = ranged.groupBy("_range").agg(F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("null")).orderBy("_range").collect()
    if not starts:
        return ranged.select("_range", F.lit(False).alias("_head"), "doc_id", "text")
    ids = [None if r["null"] else r["least"] for r in starts]
    previous = {starts[i]["_range"]: starts[i - 1]["_range"] for i in range(len(starts))}  # of the first: the last
    wanted = F.col("doc_id").isin([i for i in ids if i is not None])
    if None in ids:
        wanted = wanted | F.col("doc_id").isNull()
    heads = ranged.filter(wanted).groupBy("_range", "doc_id").agg(F.min("text").alias("text"))
    first_id = F.create_map(*[x for r, i in zip(starts, ids, strict=True) for x in (F.lit(r["_range"]), F.lit(i).cast("long"))])
    before = F.create_map(*[x for k, v in previous.items() for x in (F.lit(k), F.lit(v))])
    heads = heads.filter(F.col("doc_id").eqNullSafe(first_id[F.col("_range")]))
    heads = heads.select(before[F.col("_range")].alias("_range"), F.lit(True).alias("_head"), "doc_id", "text")
    both = ranged.select("_range", F.lit(False).alias("_head"), "doc_id", "text").unionByName(heads)
    return both.repartition(n, "_range").sortWithinPartitions("_range", "_head", "doc_id", "text")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited text (its last half replaced from the next document).

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. A null text is
    empty; equal texts have equal fingerprints; documents with equal ids follow each other by text; a single row is its
    own neighbour; an empty table gives no rows; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the last row, whose neighbour is still to come
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                heads, ids, texts = (part.column(c).to_pylist() for c in ("_head", "doc_id", "text"))
                strict, soft = vectors(texts)
                if held:
                    heads, ids, texts = [held[0], *heads], [held[1], *ids], [held[2], *texts]
                    strict, soft = np.vstack([held[3], strict]), np.vstack([held[4], soft])
                held = heads[-1], ids[-1], texts[-1], strict[-1:], soft[-1:]
                rows = [i for i in range(len(ids) - 1) if not heads[i]]
                if not rows:
                    continue
                edited = [texts[i][: len(texts[i]) - len(texts[i]) // 2] + texts[i + 1][: len(texts[i]) // 2] for i in rows]
                other, blurred = vectors(edited)
                following = [i + 1 for i in rows]
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[i] for i in rows], pa.int64()), pa.array([len(texts[i]) for i in rows], pa.int64()),
                    pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in edited]),
                    pa.array(encoded(strict[rows], soft[rows])), pa.array(encoded(other, blurred)),
                    pa.array(likeness(soft[rows], blurred)), pa.array(likeness(soft[rows], soft[following])),
                ], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_neighbours(docs).mapInArrow(run, schema)
