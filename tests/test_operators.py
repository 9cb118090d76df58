"""Governance, merges, reconciliation, classification, rewriting, topics and the limiter, over small inputs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lexigrid.functions import labels, repair, text
from lexigrid.operators import classify, govern, lookup, merge, reconcile, sampling, stats, topics
from lexigrid.plans import rewrite
from lexigrid.sources.sinks import Store
from lexigrid.streaming import limiter, resume


def col(spark, values: list, fn, kind: str = "string") -> list:
    d = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["r"] for r in d.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()]


def test_sessions_publish_only_what_was_declared(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"))
    store.publish(store.stage(spark.createDataFrame([(1, "a", None), (2, "b", None)], "id long, word string, ipa string")))
    first = store.versions()[-1]

    def fill(d):
        return d.withColumn("ipa", F.lit("x"))

    with pytest.raises(govern.Rejected) as bad:
        govern.Session(store, {"ipa": 1}).apply(fill)
    assert bad.value.undeclared == {"ipa": (1, 2)} and store.versions() == [first]
    with pytest.raises(govern.Rejected):
        govern.Session(store, {"ipa": 2}).apply(lambda d: fill(d).where("id = 1").withColumn("ipa", F.lit("x")))
    govern.Session(store, {"ipa": 2}).apply(fill)
    assert store.current().where("ipa = 'x'").count() == 2
    govern.Session(store, {govern.ROWS: None, "id": None, "word": None, "ipa": None}).apply(lambda d: d.where("id = 1"))
    assert store.current().count() == 1
    store.restore(first)
    assert store.current().where("ipa IS NULL").count() == 2


def test_like(spark):
    words = ["a_b", "axb", "50% off", "500", "a\\b", "ÉA", "éa", None]
    found = lambda p: [w for w, r in zip(words, col(spark, words, lambda c: text.like_prefix(c, p)), strict=True) if r]
    assert found("A_B") == ["a_b", "axb", "a\\b"] and found("50%") == ["50% off", "500"] and found("a\\") == ["a\\b"] and found("é") == ["éa"]


def test_limits():
    assert [lookup.clamp(x) for x in (None, "abc", "0", 7, 99, float("nan"), float("inf"))] == [20, 20, 1, 7, 50, 20, 20]


def test_json_repair(spark):
    assert col(spark, ['```json\n{"a": [1, 2,],}\n```', 'x {"a": "}{"} y', "none", '{"open": 1', None], text.repair_json) == ['{"a": [1, 2]}', '{"a": "}{"}', None, None, None]


def test_edit_neighbours(spark):
    pairs = [("abcd", "abdc"), ("abcd", "abc"), ("abcd", "abxd"), ("abcd", "badc"), ("a", "a")]
    d = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    assert [r["r"] for r in d.select("i", text.edit_neighbours(F.col("a"), F.col("b")).alias("r")).orderBy("i").collect()] == [True, True, True, False, True]


def test_small_text_functions(spark):
    assert col(spark, ["bigger", "nicest", "happier", "her"], text.degree_stems, "string")[2] == ["happi", "happie", "happi", "happy"] or "happy" in col(spark, ["happier"], text.degree_stems)[0]
    assert col(spark, [10, 2048, 3 << 20], text.human_size, "long") == ["10 B", "2.0 KB", "3.0 MB"]
    assert col(spark, ["0:a\n 0:b \n0:a\nc", None, "1:"], text.base_forms) == [["a", "b", "c"], [], []]
    assert col(spark, ["  a\\nb\n\nc ", None], lambda c: text.lines(c, True)) == [["a", "b", "c"], []]
    assert col(spark, ["[1] a,  b；", "x"], text.clean_gloss) == ["a, b", "x"]
    assert col(spark, ["Straße ÄÖ", "Été"], lambda c: text.search_key(c, "de")) == ["strasse aeoe", "ete"]
    assert col(spark, ["third-person singular present indicative of x"], labels.tags_of_prose)[0] == ["third-person", "singular", "indicative", "present"]
    assert [r and (r["base"], r["label"]) for r in col(spark, ["plural of cat", "past tense of run.", "a cat"], labels.english_form)] == [("cat", "复数"), ("run", "过去式"), None]


def test_gender_resolution(spark):
    cases = [([], "f", "f"), (["m"], "m", "m"), (["m"], "mf", "mf"), (["mf"], "f", "mf"), (["m"], "f", "f"), (["m", "f"], "f", None), (["m"], "x", None), (["m"], None, None)]
    d = spark.createDataFrame([(i, k, o) for i, (k, o, _) in enumerate(cases)], "i int, k array<string>, o string")
    assert [r["r"] for r in d.select("i", merge.resolved_gender(F.col("k"), F.col("o")).alias("r")).orderBy("i").collect()] == [c[2] for c in cases]


def test_reverted(spark):
    d = spark.createDataFrame([(1, "new"), (2, "later"), (3, "new")], "id long, v string")
    ledger = spark.createDataFrame([(1, "old", "new"), (2, "old", "new"), (3, "old", "new")], "id long, before string, after string")
    blocked = spark.createDataFrame([(3,)], "id long")
    assert sorted(tuple(r) for r in merge.reverted(d, ledger, "v", blocked=blocked).collect()) == [(1, "old"), (2, "later"), (3, "new")]


def test_preserved(spark):
    d = merge.preserved_then(spark.createDataFrame([("g",)], "ipa string"), "ipa", F.lit("ɡ"))
    assert merge.preserved_then(d, "ipa", F.lit("x")).first().asDict() == {"ipa": "x", "ipa_raw": "g"}


def test_gates(spark):
    d = spark.createDataFrame([(0, "abcdef", " "), (1, "abcdef", "猫"), (2, "abcdef", "a#"), (3, "abcdef", "abc"), (4, "abcdef", "abcdx")], "i int, o string, n string")
    assert [r["r"] for r in d.select("i", merge.gate_reasons(F.col("o"), F.col("n"), "a-z").alias("r")).orderBy("i").collect()] == ["empty", "han", "letters", "shorter", None]


def test_shells(spark):
    bodies = ["n. cat的复数形式", "enduring的变形", "n. 复数", "underspeak的现在分词、动名词形式", "n. 是girmitiya的复数形式", "猫；cat的复数形式"]
    assert col(spark, bodies, classify.shell) == [True, True, False, True, True, False]


def test_grade_and_guards(spark):
    d = spark.createDataFrame([("C5", True, None, None), ("C5", None, True, True), ("A1", None, None, True), ("C1", None, None, None), ("B2", False, False, False)], "b string, c boolean, j boolean, f boolean")
    assert sorted(r["g"] for r in d.select(classify.grade(*map(F.col, "bcjf")).alias("g")).collect()) == ["core", "fixed", "good", "judged", "low"]
    g = spark.createDataFrame([("USA", "n. 美国", "n", "usas", "过去式")], "b string, t string, p string, w string, l string")
    assert g.select(classify.guard_flags(*map(F.col, "btpwl")).alias("g")).first()["g"] == ["C", "F", "I"]


def test_set_and_sense_comparisons(spark):
    d = spark.createDataFrame([(0, ["a"], ["a"]), (1, ["a"], ["b"]), (2, ["a", "b"], ["a"]), (3, [], ["a"]), (4, ["a"], None), (5, ["a", "c"], ["a", "b"])], "i int, a array<string>, b array<string>")
    assert [r["v"] for r in d.select("i", reconcile.set_verdict(F.col("a"), F.col("b")).alias("v")).orderBy("i").collect()] == ["faithful", "conflict", "superset", "missing", "unverifiable", "overlap"]
    z = spark.createDataFrame([(["猫；狗"], ["狗", "鸟"])], "o array<string>, t array<string>")
    assert z.select(reconcile.uncovered_senses(F.col("o"), F.col("t")).alias("u")).first()["u"] == ["鸟"]
    a = spark.createDataFrame([("小猫", "猫"), ("天空", "天上"), ("猫", "狗")], "o string, t string")
    assert [r[0] for r in a.select(reconcile.agreement_level(F.col("o"), F.col("t"))).collect()] == ["L1", "L2", "none"]


def test_templates_are_all_or_nothing(spark):
    d = spark.createDataFrame([(1, "diminutive of gato\ndiminutive of perro"), (2, "diminutive of gato\nother"), (3, "diminutive of ave")], "id long, definition string")
    known = spark.createDataFrame([("gato", "猫"), ("perro", "狗")], "word string, translation string")
    assert [tuple(r) for r in reconcile.template_translations(d, known, [("^diminutive of (.+)$", "（小）")]).collect()] == [(1, "猫（小）\n狗（小）")]


def test_roots_and_evidence(spark):
    d = spark.createDataFrame([("desgato",), ("gatito",)], "word string")
    words = spark.createDataFrame([("gato",), ("gat",)], "word string")
    found = {r["word"]: r["roots"] for r in reconcile.candidate_roots(d, words, ["des"], [("ito", "o"), ("ito", "")], lambda c: F.lower(c)).collect()}
    assert found == {"desgato": ["gato"], "gatito": ["gato", "gat"]}
    e = reconcile.evidence({"fr": spark.createDataFrame([("gatito", "chaton")], "word string, gloss string"), "de": spark.createDataFrame([("gatito", " "), ("x", "y")], "word string, gloss string")}, d)
    assert [(r["word"], [x["source"] for x in r["evidence"]]) for r in e.collect()] == [("gatito", ["fr"])]


def test_rewriting(spark):
    rows = spark.createDataFrame([(1, "cat", "B2", "x"), (2, "cats", "B2", "y"), (3, "dog", "C1", "z"), (4, "ox", "B2", "w")], "id long, word string, bucket string, translation string")
    anchors = spark.createDataFrame([("cat", ["a small animal", "a person"]), ("cats", ["plural of cat"])], "word string, senses array<string>")
    ready, outcomes = rewrite.collect(rows, anchors, ["B2"])
    assert [(r["id"], r["anchor"]) for r in ready.collect()] == [(1, "1. a small animal 2. a person")]
    assert {r["outcome"]: r["count"] for r in outcomes.collect()} == {"ok": 1, "pointer": 1, "bucket": 1, "no anchor": 1}
    assert {r["id"]: r["anchor"] for r in rewrite.through_base(rows, anchors).collect()} == {1: "a small animal", 2: "a small animal", 3: None, 4: None}
    replies = spark.createDataFrame([(1, "cat", ["一", "二"]), (2, "cat", ["一"]), (3, "dog", ["一"]), (4, "ox", [" "])], "id long, word string, lines array<string>")
    table = spark.createDataFrame([(1, "cat", "a\nb", None), (2, "cats", "a", None), (3, "dog", "a\nb", "旧"), (4, "ox", "a", None)], "id long, word string, definition string, translation string")
    updated, why, filled = rewrite.apply_translations(table, replies)
    assert {r["id"]: r["translation"] for r in updated.collect()} == {1: "一\n二", 2: None, 3: "旧", 4: None} and filled == 1
    assert {r["outcome"]: r["count"] for r in why.collect()} == {"ok": 1, "word": 1, "count": 1, "blank": 1}
    suspects = rewrite.suspects(spark.createDataFrame([(1, "gato", "过去式"), (2, "ser", "过去式"), (3, "UN", "复数")], "id long, base string, label string"), spark.createDataFrame([("gato", "n"), ("ser", "v/n")], "word string, pos string"))
    assert {r["id"]: r["reason"] for r in suspects.collect()} == {1: "no verb", 3: "abbreviation"}
    pay = rewrite.payload(spark.createDataFrame([(1, "w", "see cat\n[1] x"), (2, "v", "a\n;")], "id long, word string, definition string"), spark.createDataFrame([("Cat", "猫")], "word string, translation string"))
    assert [r["id"] for r in pay.collect()] == [1] and '"cat":"猫"' in pay.first()["payload"]


def test_appended_sense(spark):
    rows = spark.createDataFrame([(1, "a", "一", '[{"pos":"n"}]'), (2, "a\nb", "一", "[{}]"), (3, "a", "一", "[{}]")], "id long, definition string, translation string, meta string")
    extra = spark.createDataFrame([(1, "b", "二", '{"pos":"v"}'), (2, "c", "三", "{}"), (3, "c", "一", "{}")], "id long, gloss string, zh string, note string")
    updated, rejected = rewrite.appended_sense(rows, extra)
    assert tuple(updated.where("id = 1").first())[1:] == ("a\nb", "一\n二", '[{"pos":"n"},{"pos":"v"}]')
    assert {r["id"]: r["reason"] for r in rejected.collect()} == {2: "misaligned", 3: "known"}


def test_topics_always_together_keep_each_other(spark):
    d = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "b"]), (3, ["top", "a", "b"]), (4, []), (5, None)], "id int, topics array<string>")
    assert {r["id"]: r["top"] for r in topics.pruned(d, "topics").collect()} == {1: ["a", "b"], 2: ["a", "b"], 3: ["top"], 4: [], 5: []}


def test_samples_do_not_depend_on_partitions(spark):
    d = spark.range(2000).withColumnRenamed("id", "k")
    one = {r["k"] for r in sampling.sample(d.coalesce(1), 50, "k", 5).collect()}
    assert one == {r["k"] for r in sampling.sample(d.repartition(9), 50, "k", 5).collect()} and len(one) == 50
    controls = sampling.with_controls(d.select("k", F.lit("abcd").alias("w")), "w", "k", 0.1)
    assert {(r["control"], r["w"]) for r in controls.collect()} == {(True, "cdab"), (False, "abcd")}
    assert 120 < controls.where("control").count() < 280


def test_agreement_rates(spark):
    d = spark.createDataFrame([("ˈa.b", "ˈa.b"), ("ab", "a.b"), ("ˈab", "aˈb"), ("ɛ", "e"), ("x", "y"), (None, "z"), ("q", None)], "f string, t string")
    r = sampling.agreement_rates(d, "f", "t").first().asDict()
    assert r == {"n": 6, **dict.fromkeys(("exact", "notation", "stress", "openness", "different", "none"), pytest.approx(1 / 6))}


def test_audit(spark):
    d = spark.createDataFrame([("a", "a", 1, "x", "[1]", "p", None, None), ("b", "", 0, None, "{", None, "0:b", "f")], "word string, word_norm string, is_lemma int, translation string, meta string, ipa string, exchange string, flag string")
    r = stats.structural_audit(d, ["translation"], "meta", "ipa").first().asDict()
    assert r == {"total": 2, "no_word": 0, "no_key": 1, "lemma_no_translation": 0, "form_no_base": 0, "misaligned": 0, "bad_meta": 1, "no_ipa": 1, "flagged": 1, "self_base": 1}


def simulated(requests, window, most, most_global):
    """One request after the other, as a server sees them."""
    general, own, out = [0, -1], {}, {}
    for ms, order, client in sorted(requests):
        if general[1] <= ms:
            general = [0, ms + window]
        general[0] += 1
        if general[0] > most_global:
            out[order] = 503
            continue
        bucket = own.get(client, [0, -1])
        if bucket[1] <= ms:
            bucket = [0, ms + window]
        bucket[0] += 1
        own[client] = bucket
        out[order] = 429 if bucket[0] > most else 200
    return out


def test_limiter_is_the_sequential_one(spark):
    r = random.Random(8)
    requests = [(r.randint(0, 400_000), k, f"c{r.randint(0, 5)}") for k in range(1500)]
    d = spark.createDataFrame(requests, "ms long, id long, client string").withColumn("ts", F.timestamp_millis("ms"))
    for most, most_global in ((20, 150), (3, 10_000), (1000, 40)):
        found = {x["order"]: x["status"] for x in limiter.admitted(d, "client", "ts", "id", 60_000, most, most_global).collect()}
        assert found == simulated(requests, 60_000, most, most_global)
    assert limiter.admitted(d.limit(0), "client", "ts", "id").count() == 0


def test_streamed_limiter(spark, tmp_path):
    r = random.Random(9)
    requests = sorted((r.randint(0, 300_000), f"c{k % 3}") for k in range(300))
    requests = [(ms, k, c) for k, (ms, c) in enumerate(requests)]
    for part in range(3):
        spark.createDataFrame(requests[part * 100 : part * 100 + 100], "ms long, id long, client string").withColumn("ts", F.timestamp_millis("ms")).coalesce(1).write.parquet(str(tmp_path / "in" / f"p{part}"))
    source = spark.readStream.schema("ms long, id long, client string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    q = limiter.stream(source, "client", "ts", "id", 60_000, 5, "10 minutes").writeStream.format("memory").queryName("limited").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert q.exception() is None
    found = {x["order"]: 429 if x["limited"] else 200 for x in spark.table("limited").collect()}
    assert found == simulated(requests, 60_000, 5, 10**9)


def test_work_is_taken_up_again(spark, tmp_path):
    source = str(tmp_path / "src")
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    spark.range(10).write.parquet(source)
    stream = lambda: spark.readStream.schema("id long").parquet(source)
    work = lambda d: d.withColumn("v", F.col("id") * 2)
    resume.run_stream(stream(), work, out, cp).awaitTermination(120)
    spark.range(5, 15).write.mode("append").parquet(source)
    resume.run_stream(stream(), work, out, cp).awaitTermination(120)
    assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == [(k, 2 * k) for k in range(15)]
    assert resume.remaining(spark.range(20), spark.read.parquet(out)).count() == 5


def test_repairs(spark):
    d = spark.createDataFrame([("taxi", "ˈtaɡsi"), ("blogs", "bloɡs"), ("xilo", "ɡsilo"), ("unboxings", "umˈboksinɡs"), ("taxi", "ˈtaksi")], "w string, i string")
    assert [r[0] for r in d.select(repair.x_as_ks(F.col("w"), F.col("i"))).collect()] == ["ˈtaksi", None, "silo", None, None]
    d = spark.createDataFrame([("mismo", "ˈmizmo"), ("bulldozer", "bulˈdozeɾ"), ("jazz", "ˈdʒas"), ("poya", "ˈpoya"), ("gay", "ˈɡey"), ("x", "ˈa")], "w string, i string")
    assert [r[0] for r in d.select(repair.foreign_consonants(F.col("w"), F.col("i"))).collect()] == ["ˈmismo", "bulˈdoθeɾ", "ˈʝas", "ˈpoʝa", "ˈɡei", None]
    d = spark.createDataFrame([("pelli", "/ˈpelli/", "pello", "/ˈbɛllo/"), ("belli", "/ˈbelli/", "bello", "/ˈbɛllo/"), ("belli", "/ˈbɛlli/", "bello", "/ˈbello/")], "f string, fi string, b string, bi string")
    assert [r[0] for r in d.select(repair.inherited_opening(*map(F.col, ("f", "fi", "b", "bi")))).collect()] == [None, "/ˈbɛlli/", None]
    assert [repair.accented(*x) for x in (("perdere", "ˈpɛrdere"), ("citta", "tʃitˈta"), ("scienza", "ˈʃɛntsa"), ("x", None))] == ["pèrdere", "città", None, None]
    assert repair.pointed_bases("Participio activo del verbo requerir.") == ["requerir"]
    assert repair.pointed_bases("Forma del femenino de amado, participio de amar.") == ["amado", "amar"]
    d = spark.createDataFrame([("más", "mas", "/ˈmas/", None), ("más", "mas", "/ˈmas/", "mas"), ("mas", "mas", "/ˈmas/", None)], "w string, i string, r string, a string")
    assert [r[0] for r in d.select(repair.stress_only(*map(F.col, "wira"))).collect()] == ["ˈmas", None, None]


def test_look_ups_reach_the_scan(spark, tmp_path):
    """The ranges of the sorted key are pushed to Parquet."""
    from lexigrid.service import Service
    from lexigrid.sources.sinks import clustered

    rows = [(i, w, w, 1, "t", "d", None, None, None, None, None) for i, w in enumerate(["Gato", "gata", "perro", "éa", "100%"])]
    d = spark.createDataFrame(rows, "id long, word string, word_norm string, is_lemma int, translation string, definition string, ipa string, exchange string, meta string, collocation string, infl string").withColumn("pos", F.lit("n"))
    d = d.withColumn("word_norm", F.lower("word"))
    clustered(d, F.col("word"), str(tmp_path / "d"), 2)
    s = Service(spark, "it", str(tmp_path / "d"))
    assert [r["word"] for r in s.search("GAT").collect()] == ["Gato", "gata"] and s.get_entry("GATO").first()["word"] == "Gato"
    assert [r["word"] for r in s.search("1__%").collect()] == ["100%"]
    for plan in (s.search("gat"), s.get_entry("gato")):
        text_ = plan._jdf.queryExecution().explainString(plan.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        pushed = [x for x in text_.splitlines() if "PushedFilters" in x and "word_key" in x]
        assert pushed and ("GreaterThanOrEqual(word_key,gat)" in pushed[0] or "EqualTo(word_key,gato)" in pushed[0])
