"""Prefix trie of rebuilt conversations, from fingerprints that compose.

A run of turns has the fingerprint (hash, length): hash = sum of value(turn i) * base**i modulo 2**61 - 1, for two bases. Two
runs compose to (h + base**m * g, m + n), and a known head can be taken off again. So the fingerprint of every prefix of
"the head of one conversation, then the rest of another" follows from prefix fingerprints of the two; texts are never joined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ranked, slices, stage

HEADS, SPREAD = 6, 100  # head lengths are below HEADS; a base conversation for every SPREAD ids
PRIME = (1 << 61) - 1
BASES = ((0x1F3D5B79A2C4E687, 0x0B5297A4D3F1C86B), (0x13579BDF02468ACE, 0x0F1E2D3C4B5A6978), (0x1A2B3C4D5E6F7081, 0x123456789ABCDEF1))
CHUNK = 4_096  # ids, or turns of a path, that one group may hold

_LOW31, _LOW30 = np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_P, _30, _31 = np.uint64(PRIME), np.uint64(30), np.uint64(31)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> np.uint64(61))
    return np.where(x >= _P, x - _P, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME of values below it, from halves whose products stay below 2**63."""
    a1, a0, b1, b0 = a >> _31, a & _LOW31, b >> _31, b & _LOW31
    middle = a1 * b0 + a0 * b1
    return _reduced(_reduced(a1 * b1 * np.uint64(2) + (middle >> _30)) + _reduced(((middle & _LOW30) << _31) + a0 * b0))


def plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _reduced(a + b)


def minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _reduced(a + (_P - b))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n - 1)."""
    out, filled = np.ones(max(1, n), np.uint64), 1
    while filled < n:
        more = min(filled, n - filled)
        out[filled : filled + more] = times(out[:more], np.uint64(pow(base, filled, PRIME)))
        filled += more
    return out


def raised(base: int, exponents: np.ndarray) -> np.ndarray:
    """base to each of some exponents, negative ones included."""
    some, where = np.unique(exponents, return_inverse=True)
    return np.array([pow(base, int(e), PRIME) for e in some], np.uint64)[where]


def _sums(values: np.ndarray) -> np.ndarray:
    """0 and the running sums modulo PRIME."""
    high, low = (np.concatenate(([np.uint64(0)], np.cumsum(x, dtype=np.uint64))) for x in (values >> _31, values & _LOW31))
    return plus(times(_reduced(high), np.uint64(1 << 31)), _reduced(low))


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.int64))


_TURNS = "conv_id long, part long, ref long, at long, b0 long, b1 long, a0 long, a1 long, chars long, role string, text string"


def _local(bases: tuple[int, int]):
    """Of each row of a sorted partition: its place in the partition's run of the conversation, and the hashes before and after it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        conv, held, hashes = None, 0, [np.uint64(0)] * 2
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("conv_id").to_numpy()
            digests = np.frombuffer(b"".join(batch.column("digest").to_pylist()), ">u8").reshape(-1, 4).astype(np.uint64)
            n = len(ids)
            starts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
            first = np.repeat(starts, np.diff(np.append(starts, n)))  # of each row, the first row of its run here
            carried = held if ids[0] == conv else 0
            if not carried:
                hashes = [np.uint64(0)] * 2
            inside = first == 0  # rows that may go on from the last batch
            at = np.arange(n) - first + np.where(inside, carried, 0)
            out = []
            for which, base in enumerate(bases):
                terms = times(_reduced(digests[:, which]), powers(base, n)[np.arange(n) - first])
                sums = _sums(terms)
                factor = np.where(inside, np.uint64(pow(base, carried, PRIME)), np.uint64(1))
                origin = np.where(inside, hashes[which], np.uint64(0))
                before, after = (plus(origin, times(factor, minus(x, sums[first]))) for x in (sums[:-1], sums[1:]))
                out += [before, after]
                hashes[which] = after[-1]
            conv, held = ids[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(np.full(n, part)), pa.array((part << 32) + row + np.arange(n)), pa.array(at), _longs(out[0]), _longs(out[2]),
                 _longs(out[1]), _longs(out[3]), batch.column("chars"), batch.column("role"), batch.column("text")],
                ["conv_id", "part", "ref", "at", "b0", "b1", "a0", "a1", "chars", "role", "text"])
            row += n

    return run


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _mapped(df: DataFrame, schema: str, made) -> DataFrame:
    """Add to each row the columns that ``made`` gives for a batch."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *(_longs(x) for x in made(batch))], [*batch.schema.names, *names])

    kept = ", ".join(f"{name} {kind}" for name, kind in df.dtypes)
    return df.mapInArrow(run, f"{kept}, {schema}")


def _run_terms(bases: tuple[int, int]):
    def made(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for which, base in enumerate(bases):
            term = times(raised(base, _column(batch, "start")), _column(batch, f"a{which}").astype(np.uint64))
            yield from (term >> _31, term & _LOW31)

    return made


def _placed(bases: tuple[int, int]):
    """Hashes from the first turn of the conversation on."""
    def made(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for which, base in enumerate(bases):
            high, low = (_column(batch, f"{x}{which}").astype(np.uint64) for x in ("high", "low"))
            origin = plus(times(_reduced(high), np.uint64(1 << 31)), _reduced(low))
            factor = raised(base, _column(batch, "start"))
            for x in "ba":
                yield plus(origin, times(factor, _column(batch, f"{x}{which}").astype(np.uint64)))

    return made


def _rebuilt(bases: tuple[int, int]):
    """Hashes of the rebuilt prefixes that end before and with an own turn: head * (own prefix / own head)."""
    def made(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        shift = _column(batch, "head") - _column(batch, "skip")
        for which, base in enumerate(bases):
            head, own = (_column(batch, f"{x}{which}").astype(np.uint64) for x in ("head_", "own_"))
            factor = raised(base, shift)
            for x in ("pb", "pa"):
                yield plus(head, times(factor, minus(_column(batch, f"{x}{which}").astype(np.uint64), own)))

    return made


def read_turns(turns: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """The staged turns in order, each with a reference, its place in a run and the run's hashes."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    clean = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), digest.alias("digest"),
        F.length(text).cast("long").alias("chars"), role.alias("role"), text.alias("text"))
    order = ["conv_id", "turn", "digest"]  # nulls first
    ordered = clean.repartitionByRange(slices(turns.sparkSession), *order).sortWithinPartitions(*order)
    return stage(ordered.mapInArrow(_local(bases), _TURNS), "turns")


def rebuilt_paths(turns: DataFrame, bases: tuple[int, int], heads: int = HEADS, spread: int = SPREAD) -> DataFrame:
    """Staged rows (conv_id, depth, f0, f1, p0, p1, ref, chars, ended): every prefix of every rebuilt conversation, the empty one
    included, with its fingerprint, that of the prefix before it, and a reference to its last turn."""
    by_part = Window.partitionBy("conv_id").orderBy("part")
    earlier = by_part.rowsBetween(Window.unboundedPreceding, -1)
    runs = turns.groupBy("conv_id", "part").agg(F.max(F.struct("at", "a0", "a1")).alias("end"))
    runs = runs.select("conv_id", "part", (F.col("end.at") + 1).alias("n"), "end.a0", "end.a1")
    runs = runs.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    runs = _mapped(runs, "t_high0 long, t_low0 long, t_high1 long, t_low1 long", _run_terms(bases))
    runs = stage(runs.select("conv_id", "part", "n", "start", *(
        F.coalesce(F.sum(f"t_{x}{i}").over(earlier), F.lit(0)).alias(f"{x}{i}") for i in (0, 1) for x in ("high", "low"))), "runs")

    narrow = turns.select("conv_id", "part", "ref", "at", "b0", "b1", "a0", "a1", "chars")
    placed = narrow.join(runs.drop("n"), ["conv_id", "part"])
    placed = _mapped(placed, "pb0 long, pa0 long, pb1 long, pa1 long", _placed(bases))
    placed = stage(placed.select("conv_id", "part", "ref", "chars", (F.col("start") + F.col("at")).alias("at"), "pb0", "pb1", "pa0", "pa1"), "placed")

    convs = runs.groupBy("conv_id").agg(F.sum("n").alias("n"))
    skip = F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % heads
    convs = convs.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % spread).alias("base"), skip.alias("skip"))
    tops = placed.filter(F.col("at") < heads - 1)  # at most heads - 1 turns a conversation
    tops = tops.filter(F.col("conv_id") % spread == 0).select(
        F.col("conv_id").alias("base"), "at", *(f"{x}{i}" for x in ("pa", "pb") for i in (0, 1)), F.col("ref"), F.col("chars"))
    asked = convs.join(tops, "base").filter(F.col("at") < F.col("skip"))
    joint = asked.groupBy("conv_id").agg(F.max(F.struct((F.col("at") + 1).alias("head"), "pa0", "pa1")).alias("top"))
    own = placed.withColumn("skip", skip).filter(F.col("at") == F.col("skip") - 1).select("conv_id", F.col("pa0").alias("own_0"), F.col("pa1").alias("own_1"))
    zero = lambda column, name: F.coalesce(F.col(column), F.lit(0)).cast("long").alias(name)
    convs = stage(convs.join(joint, "conv_id", "left").join(own, "conv_id", "left").select(
        "conv_id", "n", "base", "skip", zero("top.head", "head"), zero("top.pa0", "head_0"), zero("top.pa1", "head_1"), zero("own_0", "own_0"), zero("own_1", "own_1")), "convs")

    rest = F.greatest(F.col("n") - F.col("skip"), F.lit(0))
    length = F.col("head") + rest
    depth = lambda x: x.cast("long").alias("depth")
    root = convs.select("conv_id", depth(F.lit(0)), *(F.lit(0).cast("long").alias(x) for x in ("f0", "f1", "p0", "p1")),
                        F.lit(-1).cast("long").alias("ref"), F.lit(0).cast("long").alias("chars"), (length == 0).alias("ended"))
    borrowed = convs.drop("head_0", "head_1", "own_0", "own_1").join(tops, "base").filter(F.col("at") < F.col("skip")).select(
        "conv_id", depth(F.col("at") + 1), F.col("pa0").alias("f0"), F.col("pa1").alias("f1"), F.col("pb0").alias("p0"), F.col("pb1").alias("p1"),
        "ref", "chars", (F.col("at") + 1 == length).alias("ended"))
    # A key is a conversation's run in one partition, so a conversation of any length has keys of bounded size
    known = convs.drop("base").join(runs.select("conv_id", "part"), "conv_id")
    later = placed.join(known, ["conv_id", "part"]).filter(F.col("at") >= F.col("skip"))
    later = _mapped(later, "p0 long, f0 long, p1 long, f1 long", _rebuilt(bases)).select(
        "conv_id", depth(F.col("head") + F.col("at") + 1 - F.col("skip")), "f0", "f1", "p0", "p1", "ref", "chars", (F.col("at") + 1 == F.col("n")).alias("ended"))
    return stage(root.unionByName(borrowed).unionByName(later), "paths")


_KEY = ["depth", "f0", "f1"]


def trie_nodes(paths: DataFrame) -> DataFrame:
    """Staged groups of equal (depth, fingerprint): smallest member, members, and the spread of what members must share."""
    return stage(paths.groupBy(*_KEY).agg(
        F.min("conv_id").alias("owner"), F.count("*").alias("n"), F.max("chars").alias("chars"),
        F.min("p0").alias("p0"), F.min("p1").alias("p1"), F.max("p0").alias("q0"), F.max("p1").alias("q1"), F.min("ref").alias("r0"), F.max("ref").alias("r1")), "nodes")


def clashing(paths: DataFrame, nodes: DataFrame, turns: DataFrame) -> bool:
    """Whether a group holds different sequences. Groups whose members have one group before them and equal last turns, at
    every depth, hold equal ones; last turns are compared through their references, where a group has several."""
    if not nodes.filter("p0 <> q0 or p1 <> q1").isEmpty():
        return True
    several = nodes.filter("r0 <> r1").select(*_KEY)
    last = paths.join(several, _KEY).select(*_KEY, "ref").distinct().join(turns.select("ref", "role", "text"), "ref")
    spread = last.groupBy(*_KEY).agg(*(f(x).alias(f"{f.__name__}_{x}") for x in ("role", "text") for f in (F.min, F.max)))
    return not spread.filter("min_role <> max_role or min_text <> max_text").isEmpty()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined chunks of each node, which lie in order in one partition; only one chunk is held at a time."""
    node, state = None, None
    for batch in batches:
        done = []
        for key, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if key == node:
                state.update(b",")
            else:
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = key, hashlib.sha256()
            state.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], pa.string()) for i in (0, 1)], ["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], ["node", "ends_sha256"])


def _node() -> Column:
    return F.concat_ws("/", *_KEY).alias("node")


def ended_here(paths: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(node, ends_sha256) of the nodes at which some conversation ends."""
    placed = ranked(paths.filter("ended").select(_node(), "conv_id"), "node", [F.col("conv_id")], "place")
    chunks = placed.groupBy("node", F.floor(F.col("place") / chunk).alias("chunk")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    chunks = chunks.select("node", "chunk", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    return chunks.repartition("node").sortWithinPartitions("node", "chunk").mapInArrow(_digests, "node string, ends_sha256 string")


def prefix_trie(conversations: DataFrame, heads: int = HEADS, spread: int = SPREAD, bases: tuple[tuple[int, int], ...] = BASES, chunk: int = CHUNK) -> DataFrame:
    """The nodes of the trie of rebuilt conversations.

    Conversation c is rebuilt as the first ``crc32(c) % heads`` turns of conversation ``c - c % spread`` (remainder with the
    sign of c), then its own turns after as many. Returns conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256 per distinct sequence of first turns.

    Rows without a conv_id belong to no conversation; a null role or text is empty, a null turn comes first, and turns that
    tie are ordered by the SHA-256 digest of role and text (repeated rows are turns of their own). An empty table gives no
    rows; other columns are ignored. Fingerprints are checked against the stored turns; if two sequences share one, the next
    pair of ``bases`` is taken, and with none left it is an error.
    """
    for pair in bases:
        turns = read_turns(conversations, pair)
        paths = rebuilt_paths(turns, pair, heads, spread)
        nodes = trie_nodes(paths)
        if not clashing(paths, nodes, turns):
            return _described(paths, nodes, chunk)
    raise ValueError("different sequences share a fingerprint under every pair of bases")


def _described(paths: DataFrame, nodes: DataFrame, chunk: int) -> DataFrame:
    """Counts and sums over subtrees without walking the tree: a node belongs to its smallest member, so what lies below a node
    is what belongs to its members, less what its own member has above it."""
    weight = (F.col("n") - 1) * F.col("chars")
    parents = nodes.filter("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p0").alias("f0"), F.col("p1").alias("f1"))
    nodes = stage(nodes.select(*_KEY, "p0", "p1", "owner", "n", weight.alias("weight")).join(
        parents.groupBy(*_KEY).agg(F.count("*").alias("n_children")), _KEY, "left").fillna(0, ["n_children"]), "described")

    totals = nodes.filter("n_children = 0 or weight > 0").groupBy("owner").agg(
        F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"), F.sum("weight").alias("total"))
    below = paths.join(totals, paths["conv_id"] == totals["owner"]).groupBy(*_KEY).agg(F.sum("leaves").alias("n_leaves"), F.sum("total").alias("totals"))

    # Weights at and below each shared node on its owner's path, in two steps over stretches of bounded length
    shared = nodes.filter("n > 1").withColumn("stretch", F.floor(F.col("depth") / CHUNK))
    in_stretch = Window.partitionBy("owner", "stretch").orderBy(F.desc("depth"))
    after = Window.partitionBy("owner").orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    stretches = shared.groupBy("owner", "stretch").agg(F.sum("weight").alias("sum")).select(
        "owner", "stretch", F.coalesce(F.sum("sum").over(after), F.lit(0)).alias("later"), (F.sum("sum").over(Window.partitionBy("owner"))).alias("whole"))
    mine = shared.withColumn("here", F.sum("weight").over(in_stretch)).join(stretches, ["owner", "stretch"]).select(
        *_KEY, (F.col("here") + F.col("later") - F.col("whole")).alias("corrected"))

    up = nodes.select(F.col("depth").alias("_d"), F.col("f0").alias("_f0"), F.col("f1").alias("_f1"), F.col("owner").alias("parent_conv_id"))
    out = nodes.join(up, (F.col("depth") - 1 == F.col("_d")) & (F.col("p0") == F.col("_f0")) & (F.col("p1") == F.col("_f1")), "left").drop("_d", "_f0", "_f1")
    out = stage(out, "parents")  # a parent of many children is a skewed join, which Spark splits where nothing is stacked on it
    ends = ended_here(paths, chunk)
    out = out.join(below, _KEY, "left").join(mine, _KEY, "left").withColumn("node", _node()).join(ends, "node", "left")
    # an unshared node's member has no shared node below it: its totals are all above
    saved = F.when(F.col("n") > 1, F.col("totals") + F.col("corrected")).otherwise(0)
    return out.select(
        F.col("owner").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children",
        F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"), F.coalesce(saved, F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
