"""A corpus pipeline: quality rules, line dedup, SimHash near-dedup, secret scans and best-fit packing, in this order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexigrid.llm import line_dedup, packing, quality_rules, secret_scan, simhash_dedup
from lexigrid.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no quality rule rejects."""
    return quality_rules.quality_filter(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the chunks of lines that earlier documents have."""
    return line_dedup.line_dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash_dedup.drop_near_duplicates(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their secrets masked; none is dropped."""
    return secret_scan.redact_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(bin_id, doc_id, piece, start, length): the documents' pieces in bins of 2,048 words."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [("quality rules", quality), ("line dedup", lines), ("SimHash near-dedup", near_duplicates), ("secret scans", secrets), ("best-fit packing", packed)]

#: SQL can't express the rolling hash, SimHash or the packing; the tests hold run() against a version in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents; what each returns is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
