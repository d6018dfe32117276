"""Near duplicates from bottom-k sketches of word shingles, confirmed on full sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import shingle_sets, stage
from .components import components

RETAINED = 32  # values of a sketch
FEW = 16  # a list up to this length is compared pair by pair in SQL; longer ones in blocks
BLOCK = 1 << 18  # shingles of a long list's members that one task compares with as many others
LIGHTEST = 128  # shingles that a member counts for at least, so that a block has about BLOCK / LIGHTEST members at most
LEAST = 0.375  # estimated likeness below which a pair is dropped: at a likeness of 0.8 about once in 10**8 pairs


def sketches(docs: DataFrame, words: int, retained: int = RETAINED) -> DataFrame:
    """doc_id, n_shingles, set_id (null for no shingle) and the ``retained`` smallest hashes of each whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, names, lists = [], [], []
            for _, values in shingle_sets(batch.column(1), words):
                counts.append(len(values))
                names.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None)
                lists.append(values[:retained].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(names, pa.binary()), pa.array(lists, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "set_id", "sketch"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(run, "doc_id long, n_shingles long, set_id binary, sketch array<long>")


def inverted_lists(classes: DataFrame) -> DataFrame:
    """(key, size, node, n): classes that share a retained value, in lists of at least two.

    A value with more than FEW classes is taken together with the value retained after it, and if need be with the second
    after it: a passage that many texts share then meets different neighbours, while near copies still agree in most places.
    """
    at = F.col("at")
    posts = classes.select(F.col("set_id").alias("node"), "n", "sketch", F.posexplode("sketch").alias("at", "v1"))
    posts = posts.select("node", "n", "v1", F.get(F.col("sketch"), at + 1).alias("v2"), F.get(F.col("sketch"), at + 2).alias("v3"))
    shared = posts.groupBy("v1").agg(F.count("*").alias("size")).filter("size > 1")
    first = stage(posts.join(shared, "v1"), "posts")
    lists = [first.filter(F.col("size") <= FEW).select(F.col("v1").alias("key"), "size", "node", "n")]
    left = first.filter(F.col("size") > FEW).drop("size")
    for depth in (2, 3):
        keyed = left.withColumn("key", F.xxhash64(*[F.col(f"v{i}") for i in range(1, depth + 1)]))
        sizes = keyed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
        keyed = keyed.join(sizes, "key")
        done = keyed if depth == 3 else keyed.filter(F.col("size") <= FEW)
        lists.append(done.select("key", "size", "node", "n"))
        left = keyed.filter(F.col("size") > FEW).drop("key", "size")
    return stage(lists[0].unionByName(lists[1]).unionByName(lists[2]), "lists")


def _near_size(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def estimated(pairs: DataFrame, classes: DataFrame, least: float = LEAST) -> DataFrame:
    """Pairs (a, b) whose likeness, estimated from the smallest values of the union of both sketches, is not below ``least``."""
    side = classes.select(F.col("set_id").alias("_id"), "sketch")
    both = pairs.join(side.withColumnsRenamed({"_id": "a", "sketch": "_sa"}), "a").join(side.withColumnsRenamed({"_id": "b", "sketch": "_sb"}), "b")
    union = F.slice(F.array_sort(F.array_union("_sa", "_sb")), 1, F.greatest(F.size("_sa"), F.size("_sb")))
    both = both.withColumn("_u", union).withColumn("_i", F.size(F.array_intersect(F.array_intersect("_u", "_sa"), "_sb")))
    return both.filter(F.col("_i") >= F.lit(least) * F.size("_u")).select("a", "b")


def full_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(set_id, shingles): whole sorted sets of the classes in ``wanted``, from the text of one document each."""
    picked = classes.join(wanted, "set_id").select("rep", F.col("set_id").alias("_set"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("_set").to_pylist()
            for row, values in shingle_sets(batch.column("text"), words):
                raw = values.tobytes()
                if hashlib.blake2b(raw, digest_size=16).digest() == names[row]:
                    yield pa.RecordBatch.from_arrays([pa.array([names[row]], pa.binary()), pa.array([raw], pa.binary())], ["set_id", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    found = texts.join(picked, texts["rep"].eqNullSafe(picked["rep"])).select("_set", "text").mapInArrow(run, "set_id binary, shingles binary")
    return stage(found.dropDuplicates(["set_id"]), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union on their full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("_x"), batch.column("_y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("_x")), "a")
    both = both.join(sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("_y")), "b")
    return both.select("a", "b", "_x", "_y").mapInArrow(run, "a binary, b binary")


def star_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Each list's members against its smallest member."""
    heads = lists.groupBy("key", "size").agg(F.min(F.struct("node", "n")).alias("head"))
    joined = lists.join(heads, ["key", "size"]).filter(F.col("node") != F.col("head.node"))
    return joined.filter(_near_size(F.col("n"), F.col("head.n"), percent)).select(F.col("head.node").alias("a"), F.col("node").alias("b")).distinct()


def mixed_lists(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, size, weight, node, n, root): the lists whose members are still in different components."""
    rooted = lists.join(roots.select("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = rooted.groupBy("key", "size").agg(F.min("root").alias("_low"), F.max("root").alias("_high"), F.sum(F.greatest("n", F.lit(LIGHTEST))).alias("weight"))
    return stage(rooted.join(mixed.filter("_low <> _high").select("key", "size", "weight"), ["key", "size"]), "mixed")


def short_pairs(mixed: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components inside each short list."""
    few = mixed.filter(F.col("size") <= FEW)
    a, b = (few.select("key", "size", *[F.col(c).alias(c + s) for c in ("node", "n", "root")]) for s in ("_a", "_b"))
    pairs = a.join(b, ["key", "size"]).filter((F.col("node_a") < F.col("node_b")) & (F.col("root_a") != F.col("root_b")))
    return pairs.filter(_near_size(F.col("n_a"), F.col("n_b"), percent)).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def overlaps(left: list[np.ndarray], right: list[np.ndarray], width: int = 2048) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, from products of 0/1 matrices, ``width`` values at a time."""
    values, place = np.unique(np.concatenate(left + right), return_inverse=True)
    often = np.flatnonzero(np.bincount(place) > 1)  # a value of one set alone is in no intersection
    column = np.full(len(values), -1)
    column[often] = np.arange(len(often))
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in left + right])
    use = column[place] >= 0
    owner, column = owner[use], column[place[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, len(often), width):
        a, b = np.searchsorted(column, [low, low + width])
        grid = np.zeros((len(left) + len(right), min(width, len(often) - low)), np.float32)
        grid[owner[a:b], column[a:b] - low] = 1
        out += grid[: len(left)] @ grid[len(left) :].T
    return out.astype(np.int32)


def block_links(mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links between components inside long lists.

    A list is cut by hash into blocks of bounded weight; each pair of blocks is one task, which counts all intersections of
    its full sets and returns a spanning forest of the links: never more edges than members, however many pairs are linked.
    """
    many = mixed.filter(F.col("size") > FEW).join(sets.select(F.col("set_id").alias("node"), "shingles"), "node")
    blocks = F.ceil(F.col("weight") / F.lit(BLOCK)).cast("int")
    many = many.withColumn("_own", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    many = many.select("key", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), (F.col("_own") <= F.col("_other")).alias("left"),
                       (F.col("_own") >= F.col("_other")).alias("right"), "node", "root", "shingles")

    def run(group: pa.Table) -> pa.Table:
        names = group.column("node").to_pylist()
        _, root = np.unique(np.array(group.column("root").to_pylist(), object), return_inverse=True)
        values = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
        x, y = (np.flatnonzero(group.column(c).to_numpy()) for c in ("left", "right"))
        if not len(x) or not len(y) or root.max() == 0:
            return pa.table({"a": pa.array([], pa.binary()), "b": pa.array([], pa.binary())})
        common = overlaps([values[k] for k in x], [values[k] for k in y])
        n = np.array([len(v) for v in values])
        label, edges = np.arange(int(root.max()) + 1), []  # the component of each root so far
        for p, member in enumerate(x):
            shared = common[p].astype(np.int64)
            own, theirs = label[root[member]], label[root[y]]
            linked = np.flatnonzero((100 * shared >= percent * (n[member] + n[y] - shared)) & (theirs != own))
            if len(linked):
                others, one = np.unique(theirs[linked], return_index=True)
                edges += [sorted((names[member], names[y[q]])) for q in linked[one]]
                label[np.isin(label, others)] = own
        return pa.table({"a": pa.array([e[0] for e in edges], pa.binary()), "b": pa.array([e[1] for e in edges], pa.binary())})

    return many.groupBy("key", "i", "j").applyInArrow(run, "a binary, b binary")


def near_duplicates(docs: DataFrame, words: int = 4, percent: int = 80, retained: int = RETAINED) -> DataFrame:
    """doc_id, n_shingles, component_id, kept and set_id of every row, by links of at least ``percent`` Jaccard likeness.

    Texts of equal shingle sets are one class from the start. Classes that share retained values are compared, first each
    list's members with its smallest one, then, where a list still spans several components, all others in it: in short
    lists pair by pair, in long ones block by block. Candidate pairs pass the union-sketch estimate and are confirmed on
    full sets; blocks count on full sets at once. Two sets of likeness 0.8 share none of 32
    retained values about once in 10**20.

    A null or blank text has no shingle and is linked with nothing: its component is its own doc_id. A null doc_id takes part,
    but is no component's smallest id unless all ids are null. Rows that repeat an id belong to the class of their own text.
    An empty table gives no rows; other columns are ignored.
    """
    rows = stage(sketches(docs, words, retained), "sketches")
    classes = rows.filter("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    classes = stage(classes, "classes")
    lists = inverted_lists(classes)
    star = stage(estimated(star_pairs(lists, percent), classes), "star")
    wanted = star.select(F.col("a").alias("set_id")).unionByName(star.select(F.col("b").alias("set_id"))).distinct()
    links = stage(confirmed(star, full_sets(docs, classes, wanted, words), percent), "links")
    roots = stage(components(links), "roots")
    mixed = mixed_lists(lists, roots)
    short = stage(estimated(short_pairs(mixed, percent), classes).join(star, ["a", "b"], "left_anti"), "short")
    wanted = [short.select(F.col(c).alias("set_id")) for c in "ab"] + [mixed.filter(F.col("size") > FEW).select(F.col("node").alias("set_id"))]
    wanted = stage(wanted[0].unionByName(wanted[1]).unionByName(wanted[2]).distinct(), "wanted")
    if not wanted.isEmpty():
        sets = full_sets(docs, classes, wanted, words)
        more = stage(confirmed(short, sets, percent).unionByName(block_links(mixed, sets, percent)), "links")
        tree = roots.filter("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b"))
        roots = stage(components(tree.unionByName(more)), "roots")
    placed = classes.select("set_id", "rep").join(roots.select(F.col("node").alias("set_id"), "root"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    smallest = placed.groupBy("root").agg(F.min("rep").alias("component_id"))
    placed = placed.join(smallest, "root").select("set_id", "component_id")
    out = rows.select("doc_id", "n_shingles", "set_id").join(placed, "set_id", "left")
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"), "set_id")


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of near duplicates, and every row without a word.

    Of rows that repeat the kept id with the same shingles one stays. Columns stay as they are.
    """
    kept = near_duplicates(docs, words, percent).filter("kept and set_id is not null").select(F.col("doc_id").alias("_id"), F.col("set_id").alias("_set")).distinct()
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.withColumnsRenamed(names)
    text, doc_id = names["text"], names["doc_id"]
    text_at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [hashlib.blake2b(v.tobytes(), digest_size=16).digest() if len(v) else None for _, v in shingle_sets(batch.column(text_at), words)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.binary())], schema=batch.schema.append(pa.field("_own", pa.binary())))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in renamed.schema)
    marked = renamed.mapInArrow(run, f"{schema}, _own binary")
    joined = marked.join(kept, (F.col("_own") == F.col("_set")) & F.col(doc_id).cast("long").eqNullSafe(F.col("_id")), "left")
    nth = F.row_number().over(Window.partitionBy("_own", doc_id).orderBy(text))
    with_words = joined.filter("_own is not null and _set is not null").withColumn("_nth", nth).filter("_nth = 1")
    blank = marked.filter("_own is null")
    return with_words.select(*names.values()).unionByName(blank.select(*names.values())).withColumnsRenamed({v: k for k, v in names.items()})
