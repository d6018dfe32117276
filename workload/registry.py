"""Registration of queries, and views that both engines build from the same driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfmark.session import tune

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VIEWS: dict[str, tuple[tuple[str, ...], Callable]] = {}


class SparkDialect:
    @staticmethod
    def ts(seconds):
        return f"timestamp_seconds({seconds})"

    @staticmethod
    def csv(text):
        return f"filter(split({text}, ','), x -> x <> '')"

    @staticmethod
    def arr(*items):
        return f"array({', '.join(items)})"

    @staticmethod
    def joined(line, *order):
        packed = f"struct({', '.join(order)}, {line} as line)"
        return f"array_join(transform(array_sort(collect_list({packed})), x -> x.line), chr(10))"

    @staticmethod
    def b64(text):
        return f"base64(cast({text} as binary))"


class DuckDialect:
    @staticmethod
    def ts(seconds):
        return f"make_timestamp(({seconds}) * 1000000)"

    @staticmethod
    def csv(text):
        return f"list_filter(split({text}, ','), lambda x: x <> '')"

    @staticmethod
    def arr(*items):
        return f"[{', '.join(items)}]"

    @staticmethod
    def joined(line, *order):
        return f"string_agg({line}, chr(10) order by {', '.join(order)})"

    @staticmethod
    def b64(text):
        return f"to_base64(encode({text}))"


def view(name: str, *needs: str):
    """Register a view; ``needs`` names the views it reads."""
    def register(fn):
        VIEWS[name] = (needs, fn)
        return fn
    return register


def _order(names) -> list[str]:
    out: list[str] = []

    def visit(name):
        if name in out:
            return
        for need in VIEWS[name][0]:
            visit(need)
        out.append(name)

    for name in names:
        visit(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or a view over driver tables."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    for view_name in _order([name]):
        sql = VIEWS[view_name][1](SparkDialect)
        for t in TABLES:
            if f" {t}" in sql:
                spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
        spark.sql(sql).createOrReplaceTempView(view_name)
    return spark.table(name)


def oracle(sql: str, *views: str) -> str:
    """SQL for the second engine with the needed views in front."""
    ctes = [f"{name} as ({VIEWS[name][1](DuckDialect)})" for name in _order(views)]
    body = sql.strip()
    if not ctes:
        return body
    if body.lower().startswith("with recursive "):
        return "with recursive " + ", ".join(ctes) + ", " + body[len("with recursive "):]
    if body.lower().startswith("with "):
        return "with " + ", ".join(ctes) + ", " + body[len("with "):]
    return "with " + ", ".join(ctes) + " " + body


def query(key: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a query ``fn(t)`` where ``t(name)`` gives a table or view."""
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return fn(lambda name: table(spark, sf_dir, name))
        run.__name__ = key
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = oracle(sql, *views)
        return fn
    return register
