"""A query is a function of (spark, folder); its SQL, if SQL can express it, stands beside it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of a folder, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Query]:
    def add(fn: Callable[[Tables], DataFrame]) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(spark, folder))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        if sql:
            SQL[fn.__name__] = sql
        return run

    return add


#: ASCII folding in SQL, as look-ups do it.
def fold(expression: str) -> str:
    return f"translate({expression}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def trimmed_lines(expression: str) -> str:
    return f"list_filter(list_transform(string_split({expression}, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '')"
