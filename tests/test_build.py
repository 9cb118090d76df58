"""Readers, folds of entries, closure of bases, dictionary tables and the look-up service."""

from __future__ import annotations

import gzip
import io
import json
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from lexigrid.functions import ipa, morph
from lexigrid.plans import build
from lexigrid.service import Registry, Service
from lexigrid.sources import readers, sinks

ENTRIES = [
    {"word": "Gato", "lang_code": "es", "pos": "name", "sounds": [{"ipa": "[ˈɡa.to]"}], "senses": [{"glosses": ["a surname"]}]},
    {"word": "gato", "lang_code": "es", "pos": "noun", "sounds": [{"ipa": "[ˈɡa.to]"}, {"ipa": "/ˈɡato/"}], "head_templates": [{"name": "es-noun", "expansion": "gato m (plural gatos, feminine gata, feminine plural gatas)"}], "senses": [{"glosses": ["cat"], "tags": ["masculine"]}, {"glosses": ["jack"], "tags": ["masculine", "Spain", "colloquial", "strange"]}, {"glosses": ["cat"]}]},
    {"word": "gatos", "lang_code": "es", "pos": "noun", "senses": [{"glosses": ["plural of gato"], "tags": ["form-of", "plural"], "form_of": [{"word": "gato"}]}]},
    {"word": "fertiles", "lang_code": "es", "pos": "adj", "senses": [{"glosses": ["plural of fertil"], "tags": ["plural"], "form_of": [{"word": "fertil"}]}]},
    {"word": "fértil", "lang_code": "es", "pos": "adj", "senses": [{"glosses": ["fertile"]}]},
    {"word": "cimbla", "lang_code": "es", "pos": "verb", "senses": [{"glosses": ["inflection of cimblar"], "tags": ["third-person", "singular", "present", "indicative"], "form_of": [{"word": "cimblar"}]}]},
    {"word": "mera", "lang_code": "es", "pos": "verb", "senses": [{"glosses": ["form of merer"], "form_of": [{"word": "merer"}]}]},
    {"word": "piensa", "lang_code": "es", "pos": "verb", "senses": [{"glosses": ["x of pensar"], "form_of": [{"word": "pensar"}]}]},
    {"word": "pensar", "lang_code": "es", "pos": "verb", "forms": [{"form": "piensa", "tags": ["third-person", "singular", "indicative", "present"]}, {"form": "pensado", "tags": ["participle", "past"]}], "senses": [{"glosses": ["to think"], "tags": ["transitive"]}, {"glosses": ["to think hard"], "tags": ["intransitive"]}]},
    {"word": "FBI", "lang_code": "es", "pos": "name", "senses": [{"glosses": ["initialism of Federal Bureau"], "tags": ["initialism"], "alt_of": [{"word": "Federal Bureau"}]}]},
    {"word": "cat", "lang_code": "en", "pos": "noun", "senses": [{"glosses": ["animal"]}]},
]


@pytest.fixture(scope="module")
def dump(tmp_path_factory):
    p = tmp_path_factory.mktemp("dump") / "es.jsonl"
    lines = [json.dumps(e, ensure_ascii=False) for e in ENTRIES]
    p.write_text("\n".join([*lines[:3], "{broken", "", '{"pos": "noun"}', *lines[3:]]) + "\n")
    return str(p)


@pytest.fixture(scope="module")
def entries(spark, dump):
    return readers.good_entries(readers.read_entries(spark, dump, "es")).cache()


def test_bad_lines_are_counted(spark, dump):
    e = readers.read_entries(spark, dump, "es")
    assert e.where("bad").count() == 2
    assert readers.good_entries(e).count() == 10
    assert readers.read_entries(spark, dump, "es", prefilter='"gato"').where("NOT bad").count() == 2


def test_order_survives_splitting(spark, dump, tmp_path):
    packed = tmp_path / "e.jsonl.gz"
    packed.write_bytes(gzip.compress(open(dump, "rb").read()))
    for path, size in ((dump, "300b"), (str(packed), "128m")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            words = [r["word"] for r in readers.good_entries(readers.read_entries(spark, path, "es")).orderBy("seq").select("word").collect()]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert words == [e["word"] for e in ENTRIES if e["lang_code"] == "es"]


def test_only_words(spark, entries):
    assert readers.only_words(entries, spark.createDataFrame([("GATO",)], "word string")).count() == 2


def test_other_readers(spark, tmp_path):
    (tmp_path / "chunk_1.json").write_text(json.dumps({"7": {"zh": ["猫"]}, "x": {"zh": []}}))
    assert [(r["rid"], r["o"]["zh"]) for r in readers.read_response_chunks(spark, str(tmp_path), "struct<zh:array<string>>").collect()] == [(7, ["猫"])]
    log = tmp_path / "log.jsonl"
    log.write_text("\n".join(json.dumps({"id": i, "v": v}) for i, v in ((1, "a"), (2, "b"), (1, "c"))))
    assert {r["id"]: r["v"] for r in readers.read_log(spark, str(log), "id long, v string", "id").collect()} == {1: "c", 2: "b"}
    tsv = tmp_path / "ledger.tsv"
    tsv.write_text("id\tword\tbefore\n1\tx\ty\n2\tz\n\n")
    assert [tuple(r) for r in readers.read_ledger(spark, str(tsv), ["id", "word", "before"]).orderBy("id").collect()] == [("1", "x", "y"), ("2", "z", None)]
    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as t:
        info = tarfile.TarInfo("d/m.jsonl")
        body = b"one\ntwo\n"
        info.size = len(body)
        t.addfile(info, io.BytesIO(body))
    assert [(r["member"], r["line_no"], r["value"]) for r in readers.read_archive(spark, str(tmp_path / "a.tar.gz")).collect()] == [("d/m.jsonl", 1, "one"), ("d/m.jsonl", 2, "two")]
    assert readers.inventory(spark, str(tmp_path)).agg(F.sum("files")).first()[0] == 4
    page = spark.createDataFrame([('<a href="Spanish/index.html">Spanish (900 senses)</a> <a href="J%20x/index.html">Old J (1000 senses)</a> <a href="all/index.html">All languages combined (9 senses)</a>',)], "h string")
    row = page.select(readers.index_page(F.col("h")).alias("r"), readers.slice_url("https://x.org", F.lit("pl"), F.lit("J%20x"), "d-").alias("u")).first()
    assert [(r["name"], r["senses"]) for r in row["r"]] == [("Old J", 1000), ("Spanish", 900)]
    assert row["u"] == "https://x.org/plwiktionary/J%20x/d-Jx.jsonl.gz"


def test_fold(entries):
    words = {r["key"]: r for r in build.folded(entries, build.LANGUAGES["es"]).collect()}
    gato = words["gato"]
    assert gato["word"] == "gato" and gato["pos"] == "n/name" and gato["phonetic"] == "[ˈɡa.to]"
    assert gato["glosses"] == ["a surname", "cat", "jack"]
    assert [n["pos"] for n in gato["notes"]] == ["name", "n", "n"] and gato["notes"][2]["reg"] == ["Spain"] and gato["notes"][2]["lex"] == ["colloquial"]
    assert (gato["gender"], gato["plural"], gato["feminine"]) == ("m", None, "gata")
    assert words["gatos"]["infl"] == ["gato 的 复数"]
    assert words["cimbla"]["infl"] == ["cimblar 的 陈述式·现在时·第三人称·单数"]
    assert (words["pensar"]["stem_change"], words["pensar"]["pp"], words["pensar"]["transitivity"], words["pensar"]["conjugation"]) == ("e→ie", None, "ti", "1")
    assert words["fbi"]["glosses"] == ["initialism of Federal Bureau"]


def test_fold_does_not_depend_on_partitions(entries):
    lang = build.LANGUAGES["es"]
    one = sorted(map(str, build.folded(entries.coalesce(1), lang).collect()))
    many = sorted(map(str, build.folded(entries.orderBy(F.rand(3)).repartition(7), lang).collect()))
    assert one == many


def test_closure(spark, entries):
    words = build.folded(entries, build.LANGUAGES["es"])
    out, report = build.closed(words, junk=["merer"])
    rows = {r["key"]: r for r in out.collect()}
    assert rows["fertiles"]["bases"] == ["fértil"]
    assert rows["cimbla"]["bases"] == ["cimblar"] and rows["cimblar"]["glosses"] == []
    assert rows["mera"]["bases"] == [] and rows["mera"]["infl"]
    assert {r["action"]: r["n"] for r in report.collect()} == {"keep": 2, "accent": 1, "stub": 1, "drop": 1}
    assert not [b for r in rows.values() for b in r["bases"] if b.lower() not in rows]


def test_closure_decisions(spark):
    none = []
    words = spark.createDataFrame([("a", 1, "a", ["b c"], none, none), ("d", 2, "d", ["e f"], none, none), ("g", 3, "g", ["h i"], none, none), ("j", 4, "j", ["k l"], none, none)], "key string, seq long, word string, bases array<string>, glosses array<string>, infl array<string>")
    decided = spark.createDataFrame([("b c", "repoint", "b"), ("e f", "stub", None), ("h i", "drop", None)], "base string, action string, target string")
    rows = {r["key"]: r["bases"] for r in build.closed(words.withColumn("spellings", F.array("word")), decided)[0].collect()}
    assert rows == {"a": ["b"], "b": [], "d": ["e f"], "e f": [], "j": ["k l"]}


def test_table(entries):
    rows = {r["word"]: r for r in build.build(entries, "es", junk=["merer"]).collect()}
    assert sorted(r["id"] for r in rows.values()) == list(range(1, len(rows) + 1))
    assert rows["gato"]["is_lemma"] == 1 and rows["gato"]["definition"] == "a surname\ncat\njack" and rows["gato"]["translation"] is None
    assert len(json.loads(rows["gato"]["meta"])) == 3
    assert rows["gatos"]["is_lemma"] == 0 and rows["gatos"]["translation"] == rows["gatos"]["infl"] and rows["gatos"]["exchange"] == "0:gato"
    assert rows["fértil"]["word_norm"] == "fertil" and rows["cimblar"]["is_lemma"] == 1


def test_intake(spark, entries):
    table = build.build(entries, "es", junk=["merer"])
    more = spark.createDataFrame([(w, "es", "noun") for w in ("gató", "Perú", "dos palabras", "gato", "nuevo")], "word string, lang_code string, pos string")
    fit = spark.createDataFrame([], readers.ENTRY)
    more = fit.unionByName(more, allowMissingColumns=True).withColumn("senses", F.from_json(F.lit('[{"glosses": ["g"]}]'), fit.schema["senses"].dataType)).withColumn("seq", F.struct(F.col("word").alias("file"), F.lit(0).alias("block"), F.lit(0).alias("at")))
    rows, kinds = build.intake(table, more, "es", "other")
    assert {r["kind"]: r["count"] for r in kinds.collect()} == {"accent": 1, "proper": 1, "multiword": 1, "other": 1}
    assert min(r["id"] for r in rows.collect()) == table.count() + 1 and {r["source"] for r in rows.collect()} == {"other"}


def _one(spark, record: dict, code: str) -> dict:
    d = spark.read.schema(readers.ENTRY).json(spark.sparkContext.parallelize([json.dumps(record)]))
    return d.select(*[c.alias(n) for n, c in morph.ESSENCE[code]().items()]).first().asDict()


def test_italian(spark):
    x = _one(spark, {"word": "braccio", "pos": "noun", "head_templates": [{"name": "it-noun", "args": {"1": "m", "2": "braccia<g:f>,bracci<g:m>"}}], "senses": [{"tags": ["masculine"]}]}, "it")
    assert (x["gender"], x["plural"], x["plural_gender"]) == ("m", "braccia", "f")
    x = _one(spark, {"word": "finire", "pos": "verb", "head_templates": [{"name": "it-verb", "expansion": "finìre (auxiliary avére or èssere)", "args": {"1": "a/isc"}}], "senses": [{"tags": ["transitive"]}, {"tags": ["intransitive"]}]}, "it")
    assert (x["aux"], x["conj"], x["transitivity"]) == ("both", "3isc", "ti")


def test_french(spark):
    x = _one(spark, {"word": "finir", "pos": "verb", "forms": [{"form": "avoir + past participle", "tags": ["multiword-construction"]}, {"form": "finissant", "tags": ["participle", "present"]}, {"form": "fini", "tags": ["participle", "past"]}], "senses": []}, "fr")
    assert (x["aux"], x["vgroup"], x["pp"]) == ("avoir", "2", "fini")
    x = _one(spark, {"word": "cheval", "pos": "noun", "head_templates": [{"name": "fr-noun", "args": {"1": "m"}}], "forms": [{"form": "chevaux", "tags": ["plural"]}], "senses": [{"glosses": ["horse"]}]}, "fr")
    assert (x["gender"], x["plural"]) == ("m", "chevaux")


def test_portuguese(spark):
    x = _one(spark, {"word": "ganhar", "pos": "verb", "head_templates": [{"expansion": "ganhar (past participle ganhado)"}], "forms": [{"form": "ganho", "tags": ["short-form", "participle", "past"]}], "senses": []}, "pt")
    assert (x["vconj"], x["pp"], x["pp_short"]) == ("1", "ganhado", "ganho")


def test_german(spark):
    x = _one(spark, {"word": "Haus", "pos": "noun", "head_templates": [{"name": "de-noun", "expansion": "Haus n (strong, genitive Hauses, plural Häuser)"}], "senses": []}, "de")
    assert (x["gender"], x["genitive"], x["plural"]) == ("n", "Hauses", "Häuser")
    x = _one(spark, {"word": "ankommen", "pos": "verb", "head_templates": [{"name": "de-verb", "expansion": "ankommen (class 4 strong, past tense kam, past participle angekommen, auxiliary sein)"}], "forms": [{"form": "kommt an", "tags": ["present", "indicative", "third-person"]}], "senses": []}, "de")
    assert (x["aux"], x["praeteritum"], x["partizip2"], x["vclass"], x["sep_prefix"]) == ("sein", "kam", "angekommen", "strong-4", "an")
    assert _one(spark, {"word": "gut", "pos": "adj", "senses": []}, "de")["superlative"] == "am besten"


def test_sounds(spark):
    record = {"sounds": [{"ipa": "[ˈɡɾasjas]", "raw_tags": ["seseante, yeísta"]}, {"ipa": "[ˈɡɾaθjas]", "raw_tags": ["no seseante"]}, {"ipa": "[ˈɡɾaθjas]"}, {"tags": ["X-SAMPA"], "ipa": "/x/"}, {"ipa": "plain"}, {"audio": "a.ogg", "ogg_url": "u.ogg", "mp3_url": "u.mp3"}]}
    d = spark.read.schema(readers.ENTRY).json(spark.sparkContext.parallelize([json.dumps(record), "{}"]))
    r = d.select(ipa.sounds_variants(F.col("sounds")).alias("v"), ipa.best_variant(ipa.sounds_variants(F.col("sounds")), ["no seseante"], ["seseante"]).alias("b"), ipa.audio_urls(F.col("sounds")).alias("a"), ipa.pick_ipa(F.col("sounds")).alias("p")).collect()
    assert [v["ipa"] for v in r[0]["v"]] == ["ˈɡɾasjas", "ˈɡɾaθjas"] and r[0]["v"][0]["tags"] == ["seseante", "yeísta"]
    assert r[0]["b"] == "ˈɡɾaθjas" and [a["url"] for a in r[0]["a"]] == ["u.mp3"] and r[0]["p"] == "/x/"
    assert r[1]["p"] is None


def test_stored_form_is_stable(spark):
    """Applied twice, the normal form is the same."""
    from tests.test_language import _STORED

    d = spark.createDataFrame([r[:2] for r in _STORED], "w string, i string").withColumn("one", ipa.spanish_stored(F.col("w"), F.col("i")))
    assert d.withColumn("two", ipa.spanish_stored(F.col("w"), F.col("one"))).where("one <> two").count() == 0


def test_service(spark, entries, tmp_path, monkeypatch):
    table = build.build(entries, "es", junk=["merer"])
    path = str(tmp_path / "es")
    sinks.clustered(table, F.col("word"), path)
    s = Service(spark, "es", path)
    assert s.get_stats().first()["total"] == table.count()
    assert [r["word"] for r in s.search("GAT", "x").collect()] == ["gato", "gatos"]
    assert [r["word"] for r in s.search("fert").collect()] == ["fértil", "fertiles"]
    assert s.search("  ").count() == 0 and s.get_entry("").count() == 0 and s.get_entry("nada").count() == 0
    e = s.get_entry("GATOS").first()
    assert e["word"] == "gatos" and [b["word"] for b in e["bases"]] == ["gato"] and e["base_forms"] == ["gato"]
    assert s.get_entry("gato").first()["phonetic"] == ""  # only a narrow form is known, which is not shown
    assert s.get_entries(spark.createDataFrame([("PENSAR",)], "q string"), "q").count() == 1
    r = Registry(spark, str(tmp_path))
    assert r.available() == ["es"] and r.service("xx").code == "es" and r.service("es") is r.service("es")
    monkeypatch.setenv("DATABASE_PATH_IT", path)
    assert r.available() == ["es", "it"]


def test_english_service(spark, tmp_path):
    path = str(tmp_path / "en")
    rows = [(1, "run", None, "rʌn", "ɹʌn", "", "v. move\\nn. race", "v", 5, "p:ran/d:run"), (2, "Runner", None, None, "ˈɹʌnɚ", "x", None, "n", None, None), (3, "runt", None, "", None, "small", "", "n", 1, None)]
    spark.createDataFrame(rows, "id long, word string, phonetic string, phonetic_uk string, phonetic_us string, definition string, translation string, pos string, frq int, exchange string").write.parquet(path)
    s = Service(spark, "en", path)
    assert [(r["word"], r["brief"]) for r in s.search("run").collect()] == [("run", "v. move"), ("runt", "small"), ("Runner", "x")]
    e = s.get_entry("RUNNER").first()
    assert e["phoneticDisplay"] == "ˈrʌnər" and s.get_stats().first()["phoneticUk"] == 1


def test_random_order_of_dense_ids(spark):
    values = list(range(500))
    random.Random(4).shuffle(values)
    d = sinks.dense_ids(spark.createDataFrame([(v,) for v in values], "v long").repartition(5), ["v"])
    assert {r["v"]: r["id"] for r in d.collect()} == {v: v + 1 for v in range(500)}


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_dense_ids_over_many_ranges(spark, adaptive):
    """Two million rows in 32 ranges: each number once, in the order of the values."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "32")
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        n = 2_000_000
        d = sinks.dense_ids(spark.range(0, n, 1, 16).select(F.xxhash64("id").alias("v")), ["v"])
        w = d.agg(F.count("*"), F.countDistinct("id"), F.min("id"), F.max("id")).first()
        assert tuple(w) == (n, n, 1, n)
        best = d.withColumn("bucket", F.col("id").cast("long").bitwiseAND(F.lit(-1)) / 1000).groupBy(F.floor("bucket").alias("b")).agg(F.min("v").alias("low"), F.max("v").alias("high")).orderBy("b").collect()
        assert all(a["high"] < b["low"] for a, b in zip(best, best[1:]))
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
