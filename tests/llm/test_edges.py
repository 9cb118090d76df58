"""Nulls, empty and long texts, ties, repeated rows, empty tables, extra columns: each operator and stage has a defined result."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexigrid.llm import bpe, embedding_dedup, line_dedup, packing, quality_rules, secret_scan, simhash_dedup, substring_dedup, toxicity, url_filter
from lexigrid.llm.queries import VOCABULARY

LONG = "Lorem ipsum dolor sit amet consectetur. " * 20000
KEY = "AKIA" + "ABCDEFGH12345678"
ROWS = [
    (1, "the same line here\nand a second line\nand a third one\nand more", "en", "s", 60),
    (1, "the same line here\nand a second line\nand a third one\nand more", "en", "s", 60),
    (2, "the same line here\nand a second line\nand a third one\nand more", None, None, None),
    (None, f"a null id with a key {KEY} inside", "en", "s", 3),
    (3, None, "en", None, 0),
    (4, "", "en", "s", 0),
    (5, LONG, "en", "s", len(LONG)),
    (6, "###$$$ %%% &&&", "en", "s", 14),
    (7, "   \n \n", "en", "s", 6),
    (8, "Ünïcödé 中文 \U0001f600", "de", "s", 12),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.createDataFrame(ROWS, SCHEMA)
    # names that helpers might use, one with a dot, one that differs in case from a helper's
    return d.withColumns({"k": F.lit(1), "_lx_k": F.lit(2), "_LX_GONE": F.lit(3), "a.b": F.lit(4), "hash": F.lit(5), "chunk": F.lit(6), "node": F.lit(7), "size": F.lit(8), "n": F.lit(9), "seq": F.lit(10), "rank": F.lit(11), "ids": F.lit(12), "root": F.lit(13)})


@pytest.fixture(scope="module")
def none(spark, docs):
    return docs.limit(0)


def texts(df) -> list:
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def test_quality(docs, none):
    kept = quality_rules.quality_filter(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 1, 2, 5, 8, None]
    assert quality_rules.quality_filter(none).count() == 0
    report = quality_rules.rejections(docs.withColumn("rejected", F.lit(0)))
    assert {r["doc_id"]: r["rejected_by"] for r in report.collect()}[3] == ["null_text"]


def test_lines(docs, none):
    out = line_dedup.line_dedup(docs)
    assert out.columns == docs.columns and out.count() == len(ROWS)
    by = {}
    for r in out.collect():
        by.setdefault(r["doc_id"], []).append(r)
    assert [r["text"] for r in by[1]] == [ROWS[0][1]] * 2
    assert len(by[2][0]["text"]) < len(ROWS[2][1]) and by[2][0]["n_chars"] in (None, len(by[2][0]["text"]))
    assert by[3][0]["text"] is None and by[4][0]["text"] == "" and by[5][0]["text"] == LONG
    assert line_dedup.line_dedup(none).collect() == []
    assert line_dedup.line_dedup(none).columns == docs.columns


def test_near(docs, none):
    out = simhash_dedup.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    kept = [r["doc_id"] for r in out.collect()]
    assert sorted(kept, key=str) == [1, 3, 4, 5, 6, 7, 8, None]
    assert sorted(tuple(r) for r in simhash_dedup.removed_pairs(docs).collect()) == [(1, 1), (2, 1)]
    assert simhash_dedup.drop_near_duplicates(none).count() == 0 and simhash_dedup.removed_pairs(none).count() == 0


def test_secrets(docs, none):
    out = secret_scan.redact_secrets(docs)
    assert out.columns == docs.columns and out.count() == len(ROWS)
    by = {r["doc_id"]: r for r in out.collect()}
    assert by[None]["text"] == "a null id with a key [SECRET] inside" and by[None]["n_chars"] == len(by[None]["text"])
    assert by[3]["text"] is None and by[4]["text"] == "" and by[5]["text"] == LONG
    found = secret_scan.find_secrets(docs).collect()
    assert [(r["doc_id"], r["rule"], r["match_no"], r["n_chars"]) for r in found] == [(None, "aws_access_key", 1, 20)]
    assert secret_scan.find_secrets(none).count() == 0 and secret_scan.redact_secrets(none).count() == 0


def test_substrings(docs, none):
    found = sorted((tuple(r) for r in substring_dedup.repeated_intervals(docs, window=4).collect()), key=str)
    assert [r for r in found if r[0] == 1] == [(1, 0, 14, False), (1, 0, 14, True)] and (2, 0, 14, False) in found
    assert [r for r in found if r[0] == 5] == [(5, 0, 9, True), (5, 9, 120000, False)]
    assert substring_dedup.repeated_intervals(none).count() == 0


def test_packing(docs, none):
    rows = packing.pack(docs, 100).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 5) == 120000
    assert {r["doc_id"] for r in rows} == {1, 2, None, 5, 6, 8}
    bins = {}
    for r in rows:
        bins[r["bin_id"]] = bins.get(r["bin_id"], 0) + r["length"]
    assert max(bins.values()) <= 100 and sum(r["doc_id"] == 1 for r in rows) == 2
    assert packing.pack(none).count() == 0


def test_embeddings(spark):
    nan = float("nan")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [0.0, 1.0]), (None, [1.0, 0.0]), (3, None), (4, []), (5, [nan, 1.0]), (6, [0.0, 0.0]), (7, [1.0, 0.0, 0.0]), (8, [None, 1.0]), (9, [0.5, 1e-9]), (10, [float("inf"), 1.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"id": F.lit(1), "v": F.lit(2), "i": F.lit(3)})
    assert sorted((r["a"], r["b"]) for r in embedding_dedup.near_pairs(d).collect()) == [(1, 2), (1, 9), (2, 9)]
    assert embedding_dedup.near_pairs(d.limit(0)).count() == 0
    assert sorted(map(tuple, embedding_dedup.near_classes(d).collect())) == [(1, 1, 2), (2, 1, 2), (2, 2, 0), (7, 7, 0), (9, 1, 2)]
    assert embedding_dedup.near_classes(d.limit(0)).count() == 0
    copies = spark.createDataFrame([(k, [0.1, 0.2]) for k in range(3000)], "vec_id long, embedding array<float>")
    assert embedding_dedup.near_classes(copies).groupBy("class_id", "n_links").count().collect() == [(0, 2999, 3000)]


def test_urls(spark):
    rows = [(1, "http://m.a.com/x?ref=1"), (1, "http://m.a.com/x?ref=1"), (None, "https://www.a.com/" + "x" * 50000 + "#top"), (2, None), (3, ""), (4, "HTTPS://A.COM/Feed/")]
    d = spark.createDataFrame(rows, "page_id long, url string").withColumns({"rule": F.lit(1), "_lx_rules": F.lit(2)})
    found = sorted(((r["page_id"], r["rule"]) for r in url_filter.url_matches(d).collect()), key=str)
    assert found == [(1, "mobile_host")] * 2 + [(1, "plain_http")] * 2 + [(1, "tracking_ref")] * 2 + [(4, "feed"), (None, "fragment_top"), (None, "www_host")]
    kept = url_filter.drop_matching(d)
    assert kept.columns == d.columns and sorted(r["page_id"] for r in kept.collect()) == [2, 3]
    assert url_filter.url_matches(d.limit(0)).count() == 0 and url_filter.url_matches(d, ()).count() == 0


def test_toxicity(spark, docs, none):
    bad = [(100 + k, f"word{k} you idiot and scum so bad word{k % 7}") for k in range(60)]
    good = [(300 + k, f"word{k} a fine day with some tea word{k % 7}") for k in range(240)]
    d = docs.select("doc_id", "text").unionByName(spark.createDataFrame([*bad, *good, bad[0]], "doc_id long, text string")).withColumn("score", F.lit(1))
    labels = spark.createDataFrame([*[(i, 1) for i, _ in bad[:30]], *[(i, 0) for i, _ in good[:120]], (100, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    found = sorted(r["doc_id"] for r in toxicity.toxic_documents(d, labels, max_share=0.5).collect())
    assert found == sorted([100, *[i for i, _ in bad]])
    assert toxicity.toxic_documents(d, labels.limit(0)).count() == 0
    assert toxicity.toxic_documents(none, labels).count() == 0


def test_bpe(docs, none):
    rows = {r["doc_id"]: r for r in bpe.encode_documents(docs, VOCABULARY).collect()}
    assert rows[3]["ids"] is None and rows[3]["n_tokens"] is None and rows[3]["round_trip"] is None
    assert rows[4]["ids"] == [] and rows[4]["n_tokens"] == 0 and rows[4]["round_trip"]
    assert rows[5]["round_trip"] and rows[8]["round_trip"] and rows[None]["round_trip"]
    assert bpe.encode_documents(none, VOCABULARY).count() == 0
    encoded = bpe.encode_documents(docs, VOCABULARY).withColumn("text", F.lit("other"))
    back = bpe.decode_documents(encoded, VOCABULARY)
    assert texts(back.select("doc_id", "text")) == texts(docs.select("doc_id", "text"))


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, docs, none, stage):
    name, fn = stage
    assert fn(spark, none, "").count() == 0
    out = fn(spark, docs, "")
    assert out.count() > 0
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == docs.columns
