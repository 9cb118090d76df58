"""The pipeline against a chain of plain versions of its stages."""

from __future__ import annotations

from collections import Counter

import duckdb

import corpus_pipeline
from lexigrid.llm import packing, simhash_dedup
from lexigrid.llm.queries import QUALITY_SQL
from tests.conftest import DATA
from tests.llm import brute


def test_run(spark):
    folder = f"{DATA}/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    good = {r[0] for r in con.execute(QUALITY_SQL).fetchall()}
    docs = [(i, t) for i, t in con.execute("SELECT doc_id, text FROM documents").fetchall() if i in good]
    cut = brute.line_dedup(spark, docs)
    docs = sorted((i, cut[i, t]) for i, t in docs)
    roots = brute.near_groups([t for _, t in docs], simhash_dedup.TAU)
    docs = [(i, brute.redacted(t)) for k, (i, t) in enumerate(docs) if roots[k] == k]
    words = {i: len([w for w in t.split() if w]) for i, t in docs}
    found = corpus_pipeline.run(spark, folder).collect()
    assert Counter({i: n for i, n in words.items() if n}) == sum((Counter({r["doc_id"]: r["length"]}) for r in found), Counter())
    bins: Counter = Counter()
    for r in found:
        bins[r["bin_id"]] += r["length"]
    assert max(bins.values()) <= packing.CAPACITY
    assert len(bins) <= -(-sum(words.values()) // packing.CAPACITY) * 1.05 + 3
