"""Governed updates: a candidate is published only if nothing changed that wasn't declared before."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.functions.text import line_count, present
from lexigrid.sources.sinks import Store

ROWS = "__rows__"


def snapshot(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(name, n): the rows, and how many have something in each of the columns that df has. One pass, unpivoted afterwards."""
    columns = [c for c in (columns or df.columns) if c in df.columns]
    counts = df.agg(F.count("*").alias(ROWS), *[F.count(F.when(present(F.col(c)), 1)).alias(c) for c in columns])
    names = [ROWS, *columns]
    return counts.select(F.stack(F.lit(len(names)), *[x for n in names for x in (F.lit(n), F.col(f"`{n}`"))]).alias("name", "n"))


def snapshot_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """(name, before, after, delta) where they differ, over the names of both; a name that one lacks counts 0 there."""
    b, a = before.select("name", F.col("n").alias("before")), after.select("name", F.col("n").alias("after"))
    both = b.join(a, "name", "full_outer").select("name", F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))
    return both.withColumn("delta", F.col("after") - F.col("before")).where("delta <> 0")


def alignment(df: DataFrame, lists: list[str], meta: str, key: str = "id") -> DataFrame:
    """(key, problem) of rows whose line lists differ in length from their JSON notes, or whose notes are no JSON list."""
    notes = F.from_json(F.col(meta), "array<string>")
    bad_json = present(F.col(meta)) & notes.isNull()
    problems = [F.when(bad_json, F.lit("bad json"))]
    problems += [F.when(~bad_json & present(F.col(c)) & present(F.col(meta)) & (line_count(F.col(c)) != F.size(notes)), F.lit(f"{c}: lines")) for c in lists]
    return df.select(key, F.explode(F.array_compact(F.array(*problems))).alias("problem"))


class Rejected(Exception):
    """The differences that weren't declared."""

    def __init__(self, undeclared: dict[str, tuple[int, int]]):
        super().__init__(f"undeclared changes {{name: (declared, found)}}: {undeclared}")
        self.undeclared = undeclared


@dataclass
class Session:
    """expect: name of a column (or ROWS) to its declared change in number; None allows any change there."""

    store: Store
    expect: dict[str, int | None] = field(default_factory=dict)
    tracked: list[str] | None = None

    def apply(self, change: object) -> str:
        """change: from the current table to the new one. The new version's name, published; Rejected, with nothing published, otherwise.

        An empty store has no current table: change gets None, and all counts begin at 0. A rejected version's files are removed.
        """
        current = self.store.current()
        version = self.store.stage(change(current))
        candidate = self.store.spark.read.parquet(f"{self.store.root}/{version}")
        columns = self.tracked or sorted({*(current.columns if current is not None else ()), *candidate.columns})
        after = snapshot(candidate, columns)
        before = snapshot(current, columns) if current is not None else after.limit(0)
        found = {r["name"]: r["delta"] for r in snapshot_diff(before, after).collect()}  # a row for each column
        undeclared = {n: (self.expect.get(n) or 0, found.get(n, 0)) for n in {*found, *self.expect} if not (n in self.expect and self.expect[n] is None) and found.get(n, 0) != (self.expect.get(n) or 0)}
        if undeclared:
            self.store.discard(version)
            raise Rejected(undeclared)
        self.store.publish(version)
        return version


def partition_check(df: DataFrame, parts: dict[str, Column]) -> DataFrame:
    """(total, each part, covered, overlapping): whether the conditions make a partition. A null condition counts as false."""
    flags = {n: F.coalesce(c, F.lit(False)).cast("int") for n, c in parts.items()}
    hits = sum(flags.values(), F.lit(0))
    return df.agg(F.count("*").alias("total"), *[F.sum(c).alias(n) for n, c in flags.items()], F.count(F.when(hits > 0, 1)).alias("covered"), F.count(F.when(hits > 1, 1)).alias("overlapping"))
