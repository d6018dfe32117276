"""Category tree, reports, index and snapshot of the stored catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import catalog, diff, reports
from ..operators.ranking import trending
from ..session import drop_checkpoints, shuffles_dropped, staged
from ..sources import tables
from .. import constants as K


def generate(flat: DataFrame, bridge: DataFrame, categories: DataFrame, generated_at: str | None = None) -> dict[str, DataFrame]:
    entries = staged(reports.tree_entries(catalog.placed(flat, bridge, categories)), "entries")
    statistics = catalog.stats(flat)
    return {
        "entries": entries,
        "summary": catalog.category_summary(entries),
        "sitemap": reports.sitemap_lines(entries, generated_at),
        "index_text": reports.index_text_lines(entries, generated_at),
        "agent_guide": reports.agent_guide_lines(entries, statistics),
        "category_index": reports.category_index_lines(entries),
    }


def publish(flat: DataFrame, bridge: DataFrame, categories: DataFrame, path: str, date: str,
            generated_at: str | None = None, text_codec: str | None = None) -> bool:
    """Write all datasets; without records existing output is left alone.

    The placed entries are made once, into the snapshot of the date; everything else takes the columns it needs from there.
    They are sorted once; the texts and the id lists of the leaves are read off that order. Shuffles and sorted rows go as soon as their
    step is stored, and what needs most room beside its output comes first. The texts of a large catalog outweigh all else;
    ``text_codec``, such as ``gzip``, compresses them.
    """
    if flat.isEmpty():
        return False
    spark = flat.sparkSession
    with shuffles_dropped(spark):
        tables.write_snapshot(reports.tree_entries(catalog.placed(flat, bridge, categories)), f"{path}/daily_entries", date)
        entries = tables.read_snapshot(spark, f"{path}/daily_entries", date).drop("date")
        tables.write_parents(entries, f"{path}/index")
        layout = reports.ordered_layout(entries, generated_at)
        tables.write_members(layout, f"{path}/index")
        for name in ("sitemap", "index_text", "category_index"):
            lines = reports.layout_lines(layout, name).write.mode("overwrite")
            (lines.option("compression", text_codec) if text_codec else lines).text(f"{path}/{name}")
        drop_checkpoints(layout)
        reports.write_lines(reports.agent_guide_lines(entries, catalog.stats(flat)), f"{path}/agent_guide")
        tables.write_slim(flat, f"{path}/index")
        tables.write_snapshot(diff.with_digest(flat), f"{path}/daily", date)
    return True


def daily_report(flat: DataFrame, bridge: DataFrame, categories: DataFrame, date: str) -> DataFrame:
    entries = reports.tree_entries(catalog.placed(flat, bridge, categories))
    return reports.daily_report_lines(entries, catalog.category_summary(entries), date)


def stored_report(spark: SparkSession, path: str, date: str) -> DataFrame:
    """The daily report of an earlier date, from the placement stored with its snapshot."""
    entries = tables.read_snapshot(spark, f"{path}/daily_entries", date).drop("date")
    return reports.daily_report_lines(entries, catalog.category_summary(entries), date)


def diff_report(snapshots: DataFrame, date1: str, date2: str, as_of) -> dict[str, DataFrame]:
    """Flagged rows of two dates, unique by id, their counts and the report lines."""
    changed = diff.flagged_between(snapshots, date1, date2, as_of)
    return {"changes": changed, "summary": diff.summary(changed), "lines": reports.change_report_lines(changed)}


def top_trending(flat: DataFrame, n: int = 20) -> DataFrame:
    return trending(flat, K.TRENDING_SCORE, n)
