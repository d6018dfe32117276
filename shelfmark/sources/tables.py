"""Storage of records, snapshots, lists, content and reports as partitioned files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from ..operators.keyed import FINDING_KEY, latest_per_key, merge_findings, reduced_findings, upsert_daily_metrics
from ..operators.ranking import best_first, numbered, position_in_group, slices_of
from ..operators.records import complete
from ..operators.reports import layout_entries
from ..schemas import FINDING, REPOSITORY
from ..session import DENSE, drop_checkpoints, ensure_checkpoint_dir, staged

CONTENT_BUCKETS, FINDING_BUCKETS = 256, 64  # defaults; a store keeps the number it was written with


def read_records(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Repository JSON documents; unreadable ones are dropped, unknown fields ignored, absent ones take their defaults."""
    reader = spark.read.schema(REPOSITORY).option("mode", "DROPMALFORMED").option("multiLine", multi_line)
    return complete(reader.json(path).filter("id is not null"))


def read_rejects(spark: SparkSession, path: str, schema: StructType, multi_line: bool = False) -> DataFrame:
    """Documents of a JSON source that do not parse, for error tables.

    The first schema column comes along: a query on the raw text alone is not allowed.
    """
    wide = StructType(schema.fields).add("_corrupt_record", StringType())
    rows = spark.read.schema(wide).option("multiLine", multi_line).json(path)
    return rows.filter(F.col("_corrupt_record").isNotNull()).select("_corrupt_record", schema.fieldNames()[0])


def write_records(df: DataFrame, path: str, order: str | None = "seq") -> None:
    """One JSON line per id; with ``order`` the latest row of an id wins."""
    rows = latest_per_key(df, ["id"], order).drop(order) if order else df
    rows.write.mode("overwrite").json(path)


def write_partitions(df: DataFrame, path: str, column: str, order: tuple[str, ...] = ()) -> None:
    """Replace exactly the partitions present in ``df``.

    Rows are dealt by range of the column, then of ``order``, so that a task writes few partitions and a large one spreads.
    """
    hashed = [c for c, kind in df.dtypes if "map<" not in kind]
    dealt = df.repartitionByRange(column, *order) if order else df.repartition(F.col(column), F.pmod(F.xxhash64(*hashed), F.lit(8)))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def write_snapshot(df: DataFrame, path: str, date: str) -> None:
    dated = df.withColumn("date", F.lit(date)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", DENSE)
    dated.partitionBy("date").parquet(path)


def _snapshots(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).withColumn("date", F.col("date").cast("string"))


def read_snapshot(spark: SparkSession, path: str, date: str) -> DataFrame:
    """Rows of one date; other partitions are not read."""
    return _snapshots(spark, path).filter(F.col("date") == date)


def snapshot_dates(spark: SparkSession, path: str) -> DataFrame:
    return _snapshots(spark, path).select("date").distinct().orderBy("date")


def write_lists(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_list(spark: SparkSession, path: str, rid: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("id") == rid)


def _bucket(buckets: int, *columns) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def _buckets_of(spark: SparkSession, path: str) -> int:
    return spark.read.schema("buckets int").json(f"{path}.layout").first()["buckets"]


def _write_buckets_of(spark: SparkSession, path: str, buckets: int) -> None:
    spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.mode("overwrite").json(f"{path}.layout")


def write_content(docs: DataFrame, path: str, buckets: int = CONTENT_BUCKETS) -> None:
    """Documents in buckets of the repository id, each id's rows together, with a Bloom filter on the id.

    Rows are dealt by range of bucket, id and (where there is one) path: a bucket is one file or two, and a repository of any size spreads over
    many. The number of buckets is stored beside the data, so it may follow the size of the store.
    """
    order = ["bucket", "repository_id", *(["path"] if "path" in docs.columns else [])]
    dealt = docs.withColumn("bucket", _bucket(buckets, "repository_id")).repartitionByRange(buckets, *order).sortWithinPartitions(*order)
    dealt.write.mode("overwrite").option("parquet.bloom.filter.enabled#repository_id", "true").option(
        "parquet.block.size", 8 << 20).partitionBy("bucket").parquet(path)
    _write_buckets_of(docs.sparkSession, path, buckets)


def read_content(spark: SparkSession, path: str, rid: str) -> DataFrame:
    """Documents of one repository: one bucket, and of its row groups those that may hold the id."""
    bucket = spark.range(1).select(_bucket(_buckets_of(spark, path), F.lit(rid)).alias("b")).first()["b"]
    return spark.read.parquet(path).filter((F.col("bucket") == bucket) & (F.col("repository_id") == rid)).drop("bucket")


def upsert_finding_buckets(spark: SparkSession, path: str, incoming: DataFrame, buckets: int = FINDING_BUCKETS) -> list[int]:
    """Merge findings into a store in buckets of their key; returns the buckets that were read and rewritten.

    The new rows are reduced and checkpointed first; only the buckets they fall into are read, joined and replaced, so cost
    follows the new rows. The merged rows are checkpointed before the write, so no bucket is read while replaced.
    """
    ensure_checkpoint_dir(spark)
    name = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.layout")
    stored = name.getFileSystem(spark._jsc.hadoopConfiguration()).exists(name)
    buckets = _buckets_of(spark, path) if stored else buckets
    delta = reduced_findings(incoming).withColumn("bucket", _bucket(buckets, *FINDING_KEY)).checkpoint()
    touched = sorted(r["bucket"] for r in delta.select("bucket").distinct().collect())  # at most ``buckets``
    if not touched:
        return []
    old = spark.read.parquet(path).filter(F.col("bucket").isin(touched)) if stored else delta.limit(0)
    merged = merge_findings(old, delta)
    if stored:
        merged = merged.checkpoint()
    write_partitions(merged.withColumn("bucket", _bucket(buckets, *FINDING_KEY)), path, "bucket", tuple(FINDING_KEY))
    if not stored:
        _write_buckets_of(spark, path, buckets)
    return touched


def write_daily_metrics(spark: SparkSession, path: str, incoming: DataFrame, existing: DataFrame | None = None) -> None:
    """Upsert by (repository, date), rewriting only the dates that occur in ``incoming``.

    The merged rows are checkpointed before the write, so no partition is read while replaced.
    """
    if existing is None:
        merged = latest_per_key(incoming, ["repository_id", "date"]).drop("seq")
    else:
        touched = existing.join(incoming.select("date").distinct(), "date", "left_semi")
        merged = upsert_daily_metrics(touched, incoming)
    ensure_checkpoint_dir(spark)
    write_partitions(merged.checkpoint(), path, "date", ("repository_id",))


def index_members(entries: DataFrame) -> DataFrame:
    """``(parent, leaf, id)`` rows of the index. An id repeats when it has several leaves under a parent."""
    return entries.select("parent", F.col("category").alias("leaf"), "id")


def _index_rows(entries: DataFrame) -> DataFrame:
    """What the id lists need of the entries, written once."""
    return staged(entries.select("parent", F.col("category").alias("leaf"), "id", "score", "stars"), "index")


def index_lists(entries: DataFrame) -> DataFrame:
    """``(parent, leaf, position, id)``: the ids of each leaf, best score first, numbered from 1."""
    return _staged_lists(_index_rows(entries))


def _staged_lists(rows: DataFrame) -> DataFrame:
    ranked = position_in_group(rows, ["parent", "leaf"], best_first(), "position", few=True, slices=slices_of(rows))
    return ranked.select("parent", "leaf", "position", "id")


def index_parents(entries: DataFrame) -> DataFrame:
    """``(parent, position, id)``: the distinct ids under each parent, best score first."""
    return _staged_parents(_index_rows(entries))


def _staged_parents(rows: DataFrame) -> DataFrame:
    """The ids are made distinct in as many partitions as they are sorted in, so that no task holds more as the table grows."""
    slices = slices_of(rows)
    once = rows.select("parent", "id", "score", "stars").repartition(slices, "parent", "id").dropDuplicates(["parent", "id"])
    return position_in_group(once, ["parent"], best_first(), "position", few=True, slices=slices).select("parent", "position", "id")


def read_index(spark: SparkSession, path: str, parent: str, leaf: str | None = None) -> DataFrame:
    """``(position, id)`` of one parent, or of one of its leaves; other parents are not read."""
    if leaf is None:
        return spark.read.parquet(f"{path}/parents").filter(F.col("parent") == parent).select("position", "id")
    rows = spark.read.parquet(f"{path}/members").filter((F.col("parent") == parent) & (F.col("leaf") == leaf))
    return rows.select("position", "id")


def slim_records(flat: DataFrame) -> DataFrame:
    return flat.select(
        "id", F.concat(F.col("owner"), F.lit("/"), F.col("name")).alias("name"), "url", "stars",
        F.col("score_overall").alias("score"), F.col("health_status").alias("health"))


def layout_positions(layout: DataFrame) -> DataFrame:
    """``(parent, leaf, position, id)`` from the rows of an ordered layout, in its partitions."""
    return numbered(layout_entries(layout), ["parent", "leaf"], "position", few=True, row="row", part="slice").select("parent", "leaf", "position", "id")


def write_index(entries: DataFrame, flat: DataFrame, path: str) -> None:
    """All of the index. Id lists are written in the partitions they were sorted in, by range down to the single row, so a parent
    of any size is written by many tasks and nothing is dealt again."""
    rows = _index_rows(entries)
    _write_lists(_staged_lists(rows), f"{path}/members")
    write_parents(rows, path)
    write_slim(flat, path)


def write_members(layout: DataFrame, path: str) -> None:
    """The id lists of the leaves, off an ordered layout."""
    layout_positions(layout).write.mode("overwrite").option("compression", DENSE).partitionBy("parent").parquet(f"{path}/members")


def write_parents(entries: DataFrame, path: str) -> None:
    """The id lists of the parents; ``entries`` are read several times, so they should be stored ones."""
    _write_lists(_staged_parents(entries.select("parent", "id", "score", "stars")), f"{path}/parents")


def _write_lists(lists: DataFrame, path: str) -> None:
    """The sorted rows behind the lists are of no use after that and go."""
    lists.write.mode("overwrite").option("compression", DENSE).partitionBy("parent").parquet(path)
    drop_checkpoints(lists)


def write_slim(flat: DataFrame, path: str) -> None:
    """The records of the index and their number."""
    slim_records(flat).write.mode("overwrite").option("compression", DENSE).parquet(f"{path}/repositories")
    flat.agg(F.count("*").alias("total")).write.mode("overwrite").json(f"{path}/totals")


def export(flat: DataFrame, path: str, findings: DataFrame | None = None) -> None:
    """Every row as JSON lines, in two named outputs."""
    flat.write.mode("overwrite").json(f"{path}/repositories")
    if findings is not None:
        findings.write.mode("overwrite").json(f"{path}/security_findings")


def read_findings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FINDING).json(path)
