"""Content extraction from a table of repository files, under count and byte budgets."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .. import constants as K
from ..functions.urls import WEB_PREFIX
from ..functions.files import capped_text, decode_base64, file_kind
from ..schemas import DOCUMENT
from ..session import staged
from .catalog import min_score
from .keyed import with_rank


def select_records(records: DataFrame, least_score: float = 0.0, n: int = K.MAX_REPOSITORIES) -> DataFrame:
    """Records at or above a score, best first, capped."""
    return min_score(records, least_score).orderBy(
        F.coalesce("score_overall", F.lit(0.0)).desc(), F.asc("id")).limit(n)


def listing_number(column: str = "listing"):
    """Position of a listing in the fixed reading order; the readme comes first."""
    order = {name: i for i, name in enumerate((K.README_LISTING, *K.LISTINGS))}
    table = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    return F.try_element_at(table, F.col(column)).cast("int")


def stored_candidates(files: DataFrame, max_bytes: int = K.MAX_BYTES_PER_FILE, **include: bool) -> DataFrame:
    """Files of a stored kind with decoded, capped, non-empty text.

    A readme goes by its name, and links to the page of its repository where it has no url of its own.
    """
    readme = F.col("listing") == K.README_LISTING
    page = F.concat(F.lit(WEB_PREFIX), F.substr("repository_id", F.lit(len(K.PLATFORM) + 2)))
    kinds = files.withColumn("kind", file_kind("listing", "type", "name", **include)).filter("kind is not null")
    texts = kinds.withColumn("t", capped_text(decode_base64("content_base64"), max_bytes)).filter("t.bytes > 0")
    return texts.select(
        "repository_id", listing_number().alias("listing_no"), "file_order", "kind",
        F.when(readme, F.coalesce("name", F.lit("README"))).otherwise(F.coalesce("path", "name")).alias("path"),
        F.coalesce("html_url", F.when(readme, page), F.lit("")).alias("url"), "t.*")


def within_budget(
    sizes: DataFrame, budget: int = K.MAX_BYTES_PER_REPOSITORY, per_listing: int = K.MAX_FILES_PER_LISTING
) -> DataFrame:
    """Files kept by the greedy rule: in reading order, each file that still fits is taken.

    Input ``(repository_id, listing_no, file_order, bytes)``, output the kept keys. A file can be
    taken only if every earlier file of its listing and size was taken: had one been refused for
    lack of room, this one would be too. So of each size only the first ``per_listing`` files, and
    the first ``budget / size``, matter; the first limit is applied on the map side. What is left
    of a repository, which the parameters bound however many files it has, is sorted (and spills
    where it must) and streams past one running state: bytes used, listing, files taken of it.
    """
    fits = sizes.filter(F.col("bytes") <= budget)
    ranked = with_rank(fits, ["repository_id", "listing_no", "bytes"], [F.asc("file_order")], per_listing)
    useful = ranked.filter(F.col("rank") * F.col("bytes") <= budget)
    keys = useful.select("repository_id", F.col("listing_no").cast("int"), F.col("file_order").cast("bigint"), F.col("bytes").cast("bigint"))
    ordered = keys.repartition("repository_id").sortWithinPartitions("repository_id", "listing_no", "file_order", "bytes")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner, listing, used, files = None, None, 0, 0
        for batch in batches:
            kept = []
            for repository, number, size in zip(*(batch.column(c).to_pylist() for c in (0, 1, 3)), strict=True):
                if repository != owner:
                    owner, listing, used = repository, None, 0
                if number != listing or listing is None:
                    listing, files = number, 0
                taken = files < per_listing and used + size <= budget
                if taken:
                    used, files = used + size, files + 1
                kept.append(taken)
            yield batch.filter(pa.array(kept, pa.bool_())).select([0, 1, 2])

    return ordered.mapInArrow(take, "repository_id string, listing_no int, file_order bigint")


def usable_id(column: str = "id"):
    return F.coalesce(F.col(column).rlike(f"^{K.PLATFORM}:[^/]*/"), F.lit(False))


def documents(
    selected: DataFrame, files: DataFrame, max_bytes: int = K.MAX_BYTES_PER_FILE, budget: int = K.MAX_BYTES_PER_REPOSITORY,
    per_listing: int = K.MAX_FILES_PER_LISTING, **include: bool,
) -> DataFrame:
    """Documents of the selected records.

    The candidates of the selected records are decoded and staged once. Only their sizes are grouped; the texts kept are
    fetched from the stage by key. Spark broadcasts the keys where they are small by its own check of their size.
    """
    wanted = selected.filter(usable_id()).select(F.col("id").alias("repository_id"))
    mine = files.join(wanted, "repository_id", "left_semi")
    ready = staged(stored_candidates(mine, max_bytes, **include), "candidates")
    kept = within_budget(ready.select("repository_id", "listing_no", "file_order", "bytes"), budget, per_listing)
    return ready.join(kept, ["repository_id", "listing_no", "file_order"], "left_semi").select(
        *DOCUMENT.fieldNames(), "listing_no", "file_order")


def statuses(selected: DataFrame, docs: DataFrame) -> DataFrame:
    """``(id, status, documents)``: failed for a bad id, skipped without documents."""
    counts = docs.groupBy(F.col("repository_id").alias("id")).agg(F.count("*").alias("documents"))
    joined = selected.select("id").join(counts, "id", "left").fillna(0, ["documents"])
    status = F.when(~usable_id(), "failed").when(F.col("documents") == 0, "skipped").otherwise("succeeded")
    reason = F.when(status == "failed", F.concat(F.lit("unsupported repository id: "), F.coalesce("id", F.lit(""))))
    return joined.select("id", status.alias("status"), "documents", reason.alias("error"))


def report(status_rows: DataFrame) -> DataFrame:
    is_ = lambda s: F.count_if(F.col("status") == s)
    return status_rows.agg(
        F.count("*").alias("selected"), is_("succeeded").alias("succeeded"), is_("skipped").alias("skipped"),
        is_("failed").alias("failed"), F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"))
