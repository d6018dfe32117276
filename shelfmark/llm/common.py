"""Helpers of this subpackage: staged tables, exact ranks, and vectorised work on UTF-8 bytes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

BLOCK_BYTES = 1 << 20  # text that numpy handles at once; a longer single text is one block
SMALL_BLOCK = 1 << 18  # where a byte costs some hundred bytes on the way


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. A local session without one gets a temporary folder; a cluster must name one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='shelfmark-llm-')}"
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def stage(df: DataFrame, name: str, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: later steps neither repeat its work nor depend on executors.
    ``by`` names columns whose values become folders, so that a filter on them reads those alone."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by or []).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ranked(df: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """Add ``name``: the place from 0 of each row inside its group, without gathering a group in one task.

    Rows are range-partitioned by (group, order), sorted and staged; a row's place is its row number in its
    file, less the first row of the group there, plus the group's rows in earlier files.
    """
    keys = [F.col(group), *order]
    placed = stage(df.repartitionByRange(slices(df.sparkSession), *keys).sortWithinPartitions(*keys), "ranked")
    placed = placed.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    spans = placed.groupBy("_file", group).agg(F.min("_row").alias("_first"), F.count("*").alias("_rows"))
    before = Window.partitionBy(group).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        F.col("_file").alias("_f"), F.col(group).alias("_g"), "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    joined = placed.join(spans, (F.col("_file") == F.col("_f")) & F.col(group).eqNullSafe(F.col("_g")))
    return joined.select(*df.columns, (F.col("_row") - F.col("_first") + F.col("_before")).cast("long").alias(name))


def texts_of(column: pa.Array) -> list[str]:
    """Python strings; null is empty."""
    return ["" if t is None else t for t in column.to_pylist()]


def utf8_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows (first, last, bytes, offsets) of about ``limit`` bytes; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        last = min(last, len(column))
        yield first, last, raw[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd multipliers of the two rolling hashes


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # of each base, as many as the longest block of this process needed


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse modulo 2**64, at least ``n`` of them."""
    made = _POWERS.get(which)
    if made is None or len(made[0]) < n:
        size = 1 << max(20, int(n).bit_length())
        steps = [np.full(size, step, np.uint64) for step in (_BASES[which], pow(_BASES[which], -1, 1 << 64))]
        for step in steps:
            step[0] = 1
        made = _POWERS[which] = tuple(np.cumprod(step, dtype=np.uint64) for step in steps)
    return made


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Rolling:
    """Hashes of any byte span of one block, from prefix sums of a polynomial modulo 2**64."""

    def __init__(self, data: np.ndarray, which: int = 0):
        up, self.down = powers(which, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word ``[^\\x20\\x09-\\x0D]+`` of a block, and the first word of each row (with a last entry)."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | np.concatenate(([True], ~inside[:-1]))[: len(data)]))
    ends = np.flatnonzero(inside & (edge[1:] | np.concatenate((~inside[1:], [True]))[: len(data)])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, A-Z lowered, and the first word of each row."""
    data = _LOWER[data]
    starts, ends, first = word_spans(data, offsets)
    return Rolling(data).spans(starts, ends), first


def shingle_sets(column: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text; fewer words than ``words`` make one shingle, no word none."""
    salt = [np.uint64(x | 1) for x in (0x8CB92BA72F3D8DD7, 0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xE7037ED1A0B428DB, 0x589965CC75374CC3)]
    for first, last, data, offsets in utf8_blocks(column, SMALL_BLOCK):
        hashes, at = word_hashes(data, offsets)
        n = len(hashes)
        with np.errstate(over="ignore"):
            grams = np.zeros(max(0, n - words + 1), np.uint64)
            for j in range(words if n >= words else 0):
                grams += mix(hashes[j : n - words + 1 + j] * salt[j])
            grams = mix(grams)
        for row in range(first, last):
            a, b = at[row - first], at[row - first + 1]
            if b - a >= words:
                yield row, np.unique(grams[a : b - words + 1])
            elif b > a:
                with np.errstate(over="ignore"):
                    short = np.uint64(b - a)
                    for j in range(b - a):
                        short = mix(short * np.uint64(31) + mix(hashes[a + j : a + j + 1] * salt[j])[0])
                yield row, np.array([short], np.uint64)
            else:
                yield row, np.zeros(0, np.uint64)
