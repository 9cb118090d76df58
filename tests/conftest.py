"""One Spark session for all tests, and the comparison with DuckDB."""

from __future__ import annotations

import decimal
import math
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, os.environ.get("PYTHONPATH", "")) if x)
DATA = os.environ.get("LEXIGRID_TESTDATA", "/root/testdata")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def plain(value: object) -> object:
    """A value as a key that is the same for Spark's and DuckDB's kinds of it."""
    if value is None:
        return None
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int) or isinstance(value, decimal.Decimal) and value == value.to_integral_value():
        return f"{int(value)}"
    if isinstance(value, (float, decimal.Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else f"{int(number)}" if number.is_integer() else f"{number:.9g}"
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    return str(value)


def rows_of(columns: list[str], rows: list) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def check_against_sql(spark, query, sql: str, sf: str = "sf0.001") -> None:
    import duckdb

    folder = f"{DATA}/{sf}"
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    found = query(spark, folder)
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    assert sorted(found.columns) == sorted(names)
    assert rows_of(found.columns, found.collect()) == rows_of(names, want.fetchall())
