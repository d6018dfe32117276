"""Advisory feeds and search hits from JSON files, with fixed schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas as S

ERROR = "provider string, message string"
SHOWN = 200  # characters of a broken document in its message
_REJECT = "__reject"
# Schema of each provider, and whether a file is one document (else each line is one).
PROVIDERS = {"osv": (S.OSV_RESPONSE, False), "kev": (S.KEV_FEED, True), "cve": (S.CVE_ENTRY, False)}


def split(spark: SparkSession, path: str, schema: StructType, provider: str, whole: bool = False,
          staging: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of well-formed documents, and ``(provider, message)`` of the others; blank documents are neither.

    A document is broken if it is no JSON object or a field has another type than the schema; nothing of it is kept.
    Both results come from one scan: it is written to ``staging`` where that is given, else repeated by each reader.
    """
    documents = spark.read.text(path, wholetext=whole).filter(~F.col("value").rlike(r"^\s*$"))
    kinds = StructType([*schema.fields, StructField(_REJECT, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _REJECT}
    read = documents.select("value", F.from_json("value", kinds, options).alias("r"))
    is_object = F.coalesce(F.ltrim("value").startswith("{"), F.lit(False))
    broken = ~is_object | F.col("r").isNull() | F.col(f"r.{_REJECT}").isNotNull()
    message = F.when(broken, F.concat(F.lit(f"{provider}: unreadable document: "), F.substring(F.trim("value"), 1, SHOWN)))
    parted = read.select(message.alias("__message"), "r.*").drop(_REJECT)
    if staging is not None:
        parted.write.mode("overwrite").parquet(f"{staging}/{provider}")
        parted = spark.read.schema(parted.schema).parquet(f"{staging}/{provider}")
    errors = parted.filter("__message is not null").select(F.lit(provider).alias("provider"), F.col("__message").alias("message"))
    return parted.filter("__message is null").drop("__message"), errors


def load(spark: SparkSession, paths: dict[str, str], staging: str | None = None) -> tuple[dict[str, DataFrame | None], DataFrame]:
    """The frames of the given providers and all their errors. A feed that can't be opened is None and one error; the
    others are read all the same."""
    frames: dict[str, DataFrame | None] = dict.fromkeys(PROVIDERS)
    errors = spark.createDataFrame([], ERROR)
    for provider, path in paths.items():
        schema, whole = PROVIDERS[provider]
        try:
            frames[provider], bad = split(spark, path, schema, provider, whole, staging)
        except AnalysisException as problem:
            bad = spark.createDataFrame([(provider, f"{provider}: cannot open feed: {problem.getCondition()}")], ERROR)
        errors = errors.unionByName(bad)
    return frames, errors


def read_hits(spark: SparkSession, path: str) -> DataFrame:
    return split(spark, path, S.SEARCH_HIT, "hits")[0]


def read_kev(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A feed file is one JSON document; pass False for one document per line."""
    return spark.read.schema(S.KEV_FEED).option("multiLine", multi_line).json(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    return split(spark, path, S.REPOSITORY_FILE, "files")[0]
