"""Cases that reviews found: queries against their SQL on tables made for them."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq

from lexigrid import catalog
from lexigrid.plans import build
from tests.conftest import rows_of


def same_as_sql(spark, name: str, folder, **tables: pa.Table) -> None:
    import duckdb

    con = duckdb.connect()
    for t, rows in tables.items():
        pq.write_table(rows, f"{folder}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    found = catalog.queries()[name](spark, str(folder))
    want = con.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert rows_of(found.columns, found.collect()) == rows_of(names, want.fetchall())


def test_rows_without_a_line_come_last(spark, tmp_path):
    texts = [None, "", " \n  \n"] * 20 + [f"line {i}" for i in range(45)]
    documents = pa.table({"doc_id": range(len(texts)), "text": texts, "source": ["SRC1"] * len(texts)})
    same_as_sql(spark, "prefix_or_key", tmp_path, documents=documents)


def test_unknown_sizes_come_last(spark, tmp_path):
    part = pa.table({"p_partkey": range(8), "p_name": [f"red {i}" for i in range(8)], "p_size": pa.array([None, 3, None, 2, 1, None, 5, 4], pa.int32())})
    same_as_sql(spark, "prefix_search_many", tmp_path, part=part)


def part_table(n: int = 600) -> pa.Table:
    """Few words of many entries each; the last ones of words that are new to the table of `edition_intake`."""
    kinds = ["SMALL", "LARGE", "PROMO", "ECONOMY", "MEDIUM"]
    names = ["red ring" if i < n - 30 else "new bolt" for i in range(n)]
    sizes = [(i * 13 % 50) + 1 if i < n - 30 else 25 + i % 20 for i in range(n)]
    return pa.table({"p_partkey": range(n), "p_name": names, "p_brand": [f"Brand#{i % 11}" for i in range(n)], "p_type": [kinds[i // 3 % 5] for i in range(n)], "p_size": pa.array(sizes, pa.int32())})


def plans_of(spark, monkeypatch, name: str, folder) -> str:
    """The optimized plans that read the entries: the query's own, and of what it numbers on the way, which is written."""
    pq.write_table(part_table(), f"{folder}/part.parquet")
    text = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    plans, number = [], build.dense_ids
    monkeypatch.setattr(build, "dense_ids", lambda df, *args: plans.append(text(df)) or number(df, *args))
    out = text(catalog.queries()[name](spark, str(folder)))
    return "\n".join(plans[:1] or [out])


def parses(plan: str) -> int:
    return sum("from_json(" in line for line in plan.split("\n"))


def check_folded(spark, monkeypatch, name: str, folder) -> None:
    """Entries are parsed for the records and for the senses, over spread rows; what is collected for a word is distinct before."""
    plan = plans_of(spark, monkeypatch, name, folder)
    assert parses(plan) == plan.count("RepartitionByExpression") == 2
    assert "array_position(" not in plan
    same_as_sql(spark, name, folder, part=part_table())


def test_dictionary_table_parses_no_entry_for_a_condition(spark, monkeypatch, tmp_path):
    check_folded(spark, monkeypatch, "dictionary_table", tmp_path)


def test_sounds_are_read_once_for_all_columns(spark, monkeypatch, tmp_path):
    plan = plans_of(spark, monkeypatch, "source_sounds", tmp_path)
    assert parses(plan) == plan.count("RepartitionByExpression") == 1
    assert plan.count("arrays_overlap(") <= 2  # one for the variants, one for the region
    same_as_sql(spark, "source_sounds", tmp_path, part=part_table())


def test_edition_intake_parses_no_entry_for_a_condition(spark, monkeypatch, tmp_path):
    check_folded(spark, monkeypatch, "edition_intake", tmp_path)


def test_folded_entries_parses_no_entry_for_a_condition(spark, monkeypatch, tmp_path):
    check_folded(spark, monkeypatch, "folded_entries", tmp_path)


def test_dual_genders_reads_entries_once(spark, monkeypatch, tmp_path):
    plan = plans_of(spark, monkeypatch, "dual_genders", tmp_path)
    assert parses(plan) == plan.count("RepartitionByExpression") == 1
    same_as_sql(spark, "dual_genders", tmp_path, part=part_table())
