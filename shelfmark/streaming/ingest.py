"""Newly landed record files update the catalog: records, provenance edges, categories and bridge, in step.

Each micro-batch writes its rows of all four tables to its own folders of a change log, then one
entry of a ledger. Readers take the batches that the ledger names, so a batch is seen whole or not
at all, and its cost depends on the batch alone. A batch that was written but not entered is
written again; one that was entered is left alone when it is replayed. Compaction folds the batches
entered so far into a new base, which names them; batches that land meanwhile stay in the log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import records
from ..operators.keyed import category_bridge, category_rows, source_edges, top_per_key
from ..plans.collect import assigned_categories, classified
from ..schemas import REPOSITORY
from ..taxonomy import Taxonomy

LEDGER = "batch bigint, stream string, landed bigint"
TABLES = {  # keys of each table; of rows with equal keys the newest record counts, and of all else the row of the first batch
    "records": ["id"], "sources": ["repository_id", "source_repository", "source_section"], "categories": ["name"], "bridge": ["repository_id", "category"],
}


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, name: str) -> bool:
    path, store = _path(spark, name)
    return store.exists(path)


def _picked(table: str, rows: DataFrame) -> DataFrame:
    newest = [F.col("collected_at").desc_nulls_last(), F.col("batch").desc()]
    return top_per_key(rows, TABLES[table], newest if table == "records" else [F.col("batch").asc()])


def ledger(spark: SparkSession, log: str) -> DataFrame:
    """``(batch, stream, landed)`` of the batches that are in the log as a whole."""
    if not _exists(spark, f"{log}/ledger"):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).option("recursiveFileLookup", True).json(f"{log}/ledger")


def folded(spark: SparkSession, base: str | None) -> DataFrame:
    """The batches that a base holds and that were still in the log when it was made."""
    return spark.read.schema(LEDGER).json(f"{base}/ledger") if base else spark.createDataFrame([], LEDGER)


def land(batch: DataFrame, batch_id: int, log: str, stream: str, taxonomy: Taxonomy) -> bool:
    """Write one micro-batch and enter it; False if it had been entered before."""
    spark = batch.sparkSession
    entry = ledger(spark, log).filter(F.col("batch") == batch_id).first()
    if entry is not None:
        if entry["stream"] != stream:
            raise ValueError(f"batch {batch_id} of this log came from {entry['stream']}; one log takes one stream")
        return False
    number = F.lit(batch_id).cast("bigint")
    clean = classified(records.normalize(records.complete(batch)), taxonomy).withColumns({"batch": number, "seq": number}).persist()
    try:
        assigned = assigned_categories(clean, taxonomy)
        made = {
            "records": _picked("records", clean.select(*REPOSITORY.fieldNames(), "batch")),
            "sources": source_edges(clean), "categories": category_rows(assigned), "bridge": category_bridge(assigned),
        }
        for name, rows in made.items():
            rows.withColumn("batch", number).write.mode("overwrite").parquet(f"{log}/{name}/batch_no={batch_id}")
        entered = clean.agg(number.alias("batch"), F.lit(stream).alias("stream"), F.count("*").alias("landed"))
        entered.write.mode("overwrite").json(f"{log}/ledger/{batch_id}")
    finally:
        clean.unpersist()
    return True


def start(spark: SparkSession, landing: str, log: str, checkpoint: str, taxonomy: Taxonomy) -> StreamingQuery:
    """Process what has landed, then stop; run again for later files. A log belongs to one checkpoint."""
    source = spark.readStream.schema(REPOSITORY).json(landing)
    write = lambda batch, batch_id: land(batch, batch_id, log, checkpoint, taxonomy)
    return (
        source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def open_batches(spark: SparkSession, log: str, base: str | None = None) -> list[int]:
    """Entered batches that the base does not hold: as many as came since the last compaction."""
    waiting = ledger(spark, log).join(folded(spark, base), "batch", "left_anti")
    return sorted(r["batch"] for r in waiting.select("batch").collect())


def _rows(spark: SparkSession, log: str, base: str | None, table: str, batches: list[int]) -> DataFrame | None:
    parts = [spark.read.parquet(f"{base}/{table}")] if base else []
    if batches:
        parts.append(spark.read.parquet(*[f"{log}/{table}/batch_no={n}" for n in batches]))
    return parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0] if parts else None


def current(spark: SparkSession, log: str, base: str | None = None, table: str = "records") -> DataFrame:
    """One table over the base and the entered batches."""
    rows = _rows(spark, log, base, table, open_batches(spark, log, base))
    if rows is None:
        raise ValueError("nothing has landed yet")
    return _picked(table, rows).drop("batch")


def compact(spark: SparkSession, log: str, base: str | None, new_base: str) -> list[int]:
    """Write a new base of all tables and name the batches it holds; returns those it folded now.

    Only batches entered when it begins are folded. Switch readers to the new base, then call ``drop_folded``.
    """
    entries = ledger(spark, log).collect()  # one row a batch since the last compaction
    batches = open_batches(spark, log, base)
    if not batches:
        return []
    for table in TABLES:
        _picked(table, _rows(spark, log, base, table, batches)).write.mode("errorifexists").parquet(f"{new_base}/{table}")
    held = {r["batch"] for r in folded(spark, base).collect()} | set(batches)
    named = [tuple(r) for r in entries if r["batch"] in held]
    spark.createDataFrame(named, LEDGER).coalesce(1).write.mode("errorifexists").json(f"{new_base}/ledger")
    return batches


def drop_folded(spark: SparkSession, log: str, base: str) -> list[int]:
    """Remove from the log exactly the batches that the base names; a batch leaves the ledger last.

    Ledger entries of removed batches go with them: a stream that replays one later than that would land it again, which
    changes nothing, since the newest record and the first edge stay the same.
    """
    gone = sorted(r["batch"] for r in folded(spark, base).collect())
    for n in gone:
        for name in (*(f"{log}/{table}/batch_no={n}" for table in TABLES), f"{log}/ledger/{n}"):
            path, store = _path(spark, name)
            store.delete(path, True)
    return gone
