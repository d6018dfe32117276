"""Exact top-k inner products: blocks of vectors in the order of their bounds, until no bound reaches the k-th score."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from .common import slices, stage

K, EVERY = 20, 20
BLOCK = 128  # vectors of a block
UNIT_VECTORS, UNIT_QUERIES = 32_768, 4_096  # about what one task scores at once
SAFE = float(1 << 52)  # sums of products below it are exact in doubles
LEAST, MOST = -(1 << 63), (1 << 63) - 1

_INDEX = "block long, size int, dims int, ids array<long>, forward binary, high binary, low binary"
_QUERIES = "ref long, query_id long, x array<double>"
_HITS = pa.schema([("ref", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, x) of the vectors that take part; x are doubles."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) * 64 < F.lit(float("inf"))))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).filter(F.col("x").isNotNull() & finite)


def _rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat doubles of a list column, and where each row starts."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.concatenate(([0], np.cumsum(np.diff(column.offsets.to_numpy()))))


def _matrix(column: pa.Array, first: int = 0, last: int | None = None) -> np.ndarray:
    """Rows of a list column as one matrix; shorter rows end in zeros."""
    flat, at = _rows(column)
    at = at[first : (len(at) if last is None else last + 1)]
    sizes = np.diff(at)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = flat[at[0] : at[-1]]
    return out


def _blocks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            made = []
            for first in range(0, batch.num_rows, size):
                m = np.floor(_matrix(batch.column("x"), first, min(first + size, batch.num_rows)) * 64)
                made.append({
                    "block": block, "size": len(m), "dims": m.shape[1], "ids": batch.column("vec_id").slice(first, len(m)).to_pylist(),
                    "forward": m.tobytes(), "high": m.max(axis=0).tobytes(), "low": m.min(axis=0).tobytes()})
                block += 1
            yield pa.RecordBatch.from_pylist(made, schema=pa.schema([
                ("block", pa.int64()), ("size", pa.int32()), ("dims", pa.int32()), ("ids", pa.list_(pa.int64())), ("forward", pa.binary()), ("high", pa.binary()), ("low", pa.binary())]))

    return run


def build_index(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """The staged index: a row per block with its ids, its forward index (the components of its rows) and, for each dimension,
    the highest and the lowest component.

    Rows are ordered by their strongest dimension and its sign, so that a block holds alike vectors, then by vec_id, so that
    any number of equal vectors spreads over tasks."""
    strength = F.transform("x", lambda v: F.abs(v))
    lead = F.array_position(strength, F.array_max(strength)).cast("int")
    keyed = usable(vectors).select("*", F.coalesce(lead * F.signum(F.get(F.col("x"), lead - 1)), F.lit(0.0)).alias("lead"))
    keyed = keyed.repartitionByRange(slices(vectors.sparkSession), "lead", "vec_id").sortWithinPartitions("lead", "vec_id").select("vec_id", "x")
    return stage(keyed.mapInArrow(_blocks(block), _INDEX), "vectors")


def _queries(every: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                m = np.frombuffer(row["forward"]).reshape(row["size"], row["dims"])
                made += [{"ref": row["block"] * size + i, "query_id": v, "x": m[i].tolist()} for i, v in enumerate(row["ids"]) if v is not None and v % every == 0]
            yield pa.RecordBatch.from_pylist(made, schema=pa.schema([("ref", pa.int64()), ("query_id", pa.int64()), ("x", pa.list_(pa.float64()))]))

    return run


def _scores(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Inner products as longs; beyond 64 bits the nearest long."""
    out = np.empty((len(q), len(m)), np.int64)
    plain = np.abs(q) @ np.abs(m).max(axis=0, initial=0) < SAFE
    out[plain] = (q[plain] @ m.T).astype(np.int64)
    if not plain.all():
        whole = [[int(v) for v in row] for row in m.tolist()]
        for i in np.flatnonzero(~plain):
            mine = [int(v) for v in q[i].tolist()]
            out[i] = [min(max(sum(a * b for a, b in zip(mine, row)), LEAST), MOST) for row in whole]
    return out


def best(q: np.ndarray, floor: np.ndarray, own: np.ndarray, blocks: list[dict], k: int) -> tuple[np.ndarray, ...]:
    """(query, score, block, slot) of all that may belong to the ``k`` best of each row of ``q``: scores below ``floor`` don't.

    Every query walks the blocks in falling order of the sum of its products with the block's extreme components, one, two,
    four ... blocks at a time, and ends where that bound is below its k-th score so far. ``own`` is the (block, slot) to skip.
    """
    width = q.shape[1]
    high, low = np.zeros((len(blocks), width)), np.zeros((len(blocks), width))
    for i, b in enumerate(blocks):
        high[i, : b["dims"]], low[i, : b["dims"]] = np.frombuffer(b["high"]), np.frombuffer(b["low"])
    with np.errstate(over="ignore", invalid="ignore"):
        bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
        bounds[~(np.abs(q) @ np.maximum(np.abs(high), np.abs(low)).T < SAFE)] = np.inf
    order = np.argsort(-bounds, axis=1, kind="stable")
    kth, live, taken, step = floor.copy(), np.arange(len(q)), 0, 1
    who, what, where, slot = (np.zeros(0, np.int64) for _ in range(4))
    ids = [b["order"] for b in blocks]  # of each slot, its place in the order of ids
    place = np.zeros(0, np.int64)
    while len(live) and taken < len(blocks):
        picks = order[live, taken : taken + step]
        row, nth = np.nonzero(np.take_along_axis(bounds[live], picks, 1) >= kth[live][:, None])
        asked, chosen = live[row], picks[row, nth]
        by = np.argsort(chosen, kind="stable")
        asked, chosen = asked[by], chosen[by]
        found = [(who, what, where, slot, place)]
        edges = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1], [True]))) if len(chosen) else []
        for a, z in zip(edges[:-1], edges[1:]):
            b, rows = int(chosen[a]), asked[a:z]
            m = np.frombuffer(blocks[b]["forward"]).reshape(blocks[b]["size"], blocks[b]["dims"])
            got = _scores(q[rows][:, : m.shape[1]], m)
            keep = got >= kth[rows][:, None]
            mine = np.flatnonzero(own[rows, 0] == blocks[b]["block"])
            keep[mine, own[rows[mine], 1]] = False
            i, j = np.nonzero(keep)
            found.append((rows[i], got[i, j], np.full(len(i), b), j, ids[b][j]))
        who, what, where, slot, place = (np.concatenate(x) for x in zip(*found))
        by = np.lexsort((place, ~what, who))  # ~x falls as x grows and doesn't overflow
        who, what, where, slot, place = (x[by] for x in (who, what, where, slot, place))
        rank = np.arange(len(who)) - np.searchsorted(who, who)
        last = rank == k - 1
        kth[who[last]] = np.maximum(kth[who[last]], what[last])
        who, what, where, slot, place = (x[rank < k] for x in (who, what, where, slot, place))
        taken, step = taken + step, step * 2
        if taken < len(blocks):
            live = live[bounds[live, order[live, taken]] >= kth[live]]
    return who, what, where, slot


def _search(k: int, size: int):
    def run(queries: pa.Table, index: pa.Table) -> pa.Table:
        if not queries.num_rows or not index.num_rows:
            return _HITS.empty_table()
        blocks = index.to_pylist()
        every = np.concatenate([np.array([MOST if v is None else v for v in b["ids"]], np.int64) for b in blocks])
        missing = np.concatenate([np.array([v is None for v in b["ids"]], bool) for b in blocks])
        place = np.empty(len(every), np.int64)
        place[np.lexsort((every, missing))] = np.arange(len(every))
        at = np.cumsum([0] + [b["size"] for b in blocks])
        for i, b in enumerate(blocks):
            b["order"] = place[at[i] : at[i + 1]]
        q = _matrix(queries["x"])
        q = np.pad(q, ((0, 0), (0, max(0, max(b["dims"] for b in blocks) - q.shape[1]))))
        ref = queries["ref"].to_numpy()
        floor = queries["floor"].to_numpy()
        who, what, where, slot = best(q, floor, np.stack([ref // size, ref % size], 1), blocks, k)
        ids = [blocks[b]["ids"][s] for b, s in zip(where.tolist(), slot.tolist())]
        return pa.table([ref[who], queries["query_id"].to_numpy()[who], pa.array(ids, pa.int64()), what], schema=_HITS)

    return run


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, block: int = BLOCK, unit_vectors: int = UNIT_VECTORS, unit_queries: int = UNIT_QUERIES) -> DataFrame:
    """The ``k`` highest integer inner products of each row whose vec_id is divisible by ``every``, against all other rows.

    Returns query_id, rank (int, from 1), vec_id, score. Components are floor(64 * x). Equal scores go by vec_id, a missing
    vec_id last. Vectors that are null or hold a null or a component that is not finite (also once multiplied by 64) take no
    part. A shorter vector is continued with zeros, an empty one scores 0. Scores beyond 64 bits count as the nearest long.
    Repeated vec_ids are rows of their own: each is a query, and a candidate of the other. An empty table gives no rows; other
    columns are ignored.

    Blocks and queries meet in units of bounded size, in waves of one, one, two, four ... groups of blocks; the k-th score
    of a wave is the floor of the next one, so that a query keeps about k rows of each wave.
    """
    spark = vectors.sparkSession
    index = build_index(vectors, block)
    queries = stage(index.mapInArrow(_queries(every, block), _QUERIES), "queries")
    rows = index.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    asked = queries.count()
    groups = max(1, -(-rows // unit_vectors))
    teams = max(1, -(-asked // unit_queries), min(slices(spark), asked // 64))
    index = index.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups)))
    queries = queries.withColumn("team", F.pmod(F.xxhash64("ref"), F.lit(teams)))
    # Each team meets each group of the wave: both sides carry copies of a bounded unit
    found, first = spark.createDataFrame([], "ref long, query_id long, vec_id long, score long"), 0
    by_score = Window.partitionBy("ref").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    while first < groups:
        last = max(1, min(groups, 2 * first))
        kth = found.groupBy("ref").agg(F.min("score").alias("floor"), F.count("*").alias("held")).filter(F.col("held") >= k).select("ref", "floor")
        ask = queries.join(kth, "ref", "left").select("ref", "query_id", "x", F.coalesce("floor", F.lit(LEAST)).alias("floor"), "team",
                                                      F.explode(F.sequence(F.lit(first).cast("long"), F.lit(last - 1).cast("long"))).alias("group"))
        held = index.filter(F.col("group").between(first, last - 1)).withColumn("team", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(teams - 1).cast("long"))))
        hits = ask.groupBy("group", "team").cogroup(held.groupBy("group", "team")).applyInArrow(_search(k, block), found.schema)
        ranked = found.unionByName(hits).withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
        found, first = stage(ranked.select("ref", "query_id", "vec_id", "score"), "hits"), last
    return found.withColumn("rank", F.row_number().over(by_score)).select("query_id", "rank", "vec_id", "score")
