"""What is decided about rows: classes, outcomes, reconciliation of sources, rewriting from evidence, and who is served."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.operators import classify, lookup, merge, reconcile, sampling, topics
from lexigrid.plans import build, editions, rewrite
from lexigrid.queries.registry import Tables, query
from lexigrid.service import Service
from lexigrid.sources import sinks
from lexigrid.streaming import resume


@query(
    """SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'core' WHEN p_size % 3 = 0 THEN 'judged' WHEN p_size % 2 = 0 THEN 'fixed' ELSE 'good' END AS grade, CASE WHEN p_size % 2 = 0 THEN 'accent' ELSE 'multiword' END AS intake,
array_to_string(list_filter([CASE WHEN p_size % 2 = 0 THEN 'translation' END, CASE WHEN p_size % 3 = 0 THEN 'gender' END, CASE WHEN p_size % 5 = 0 THEN 'level' END], lambda x: x IS NOT NULL), ',') AS needs,
CASE WHEN p_size % 5 = 0 THEN 'gone' WHEN p_size % 4 = 0 THEN 'abstain' WHEN p_size % 3 = 0 THEN 'low' WHEN p_size % 2 = 0 THEN 'script' ELSE 'ok' END AS outcome,
CASE WHEN p_size % 7 = 0 THEN 'bucket' WHEN p_size % 5 = 0 THEN 'no anchor' WHEN p_size % 3 = 0 THEN 'pointer' ELSE 'ok' END AS anchor FROM part"""
)
def row_outcomes(t: Tables) -> DataFrame:
    """Grades, kinds of new words, what is still to be asked, what becomes of offered texts, who has an anchor."""
    s, null = F.col("p_size"), F.lit(None).cast("string")
    noun = F.when(s % 3 == 0, "n").otherwise("v")
    return t.part.select(
        "p_partkey", classify.grade(F.lit("C1"), s % 5 == 0, s % 3 == 0, s % 2 == 0).alias("grade"), classify.intake_kind(F.col("p_name"), F.when(s % 2 == 0, F.col("p_name"))).alias("intake"),
        F.array_join(classify.needs(F.when(s % 2 > 0, "x"), F.lit(""), F.when(s % 5 > 0, "A1"), noun), ",").alias("needs"),
        classify.fill_outcome(F.when(s % 5 == 0, "there"), s % 4 == 0, F.when(s % 3 == 0, "low").otherwise("high"), F.when(s % 2 == 0, "latin").otherwise("环")).alias("outcome"),
        classify.anchor_outcome(F.when(s % 7 == 0, "B1").otherwise("A1"), ["A1"], F.when(s % 5 == 0, null).when(s % 3 == 0, "plural of x").otherwise("a ring")).alias("anchor"),
    )


@query(
    """SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 3 = 0 THEN 'override' WHEN p_size % 2 = 0 THEN 'template' ELSE 'llm' END AS translated, CASE WHEN p_size % 2 = 0 THEN 'head' WHEN p_size % 3 = 0 THEN 'senses' ELSE 'llm' END AS gender,
CASE WHEN p_size % 2 = 0 THEN 'notation' WHEN p_size % 3 = 0 THEN 'residual' ELSE 'lexical' END AS triage, CASE WHEN p_size > 30 THEN 'both' WHEN p_size > 10 THEN 'one' ELSE 'none' END AS missing, CASE WHEN p_size % 2 = 0 THEN '' ELSE '锤' END AS uncovered FROM part"""
)
def value_sources(t: Tables) -> DataFrame:
    """Where translations and genders come from, what conflicts are, which senses are missing."""
    s = F.col("p_size")
    body = F.when(s % 5 == 0, "").when(s % 2 == 0, "x的复数\ny的复数").otherwise("环")
    return t.part.select(
        "p_partkey", reconcile.translation_source(body, s % 3 == 0, "的复数$").alias("translated"), reconcile.gender_source(F.lit("m"), F.when(s % 2 == 0, "m").otherwise("f"), F.when(s % 3 == 0, "m").otherwise("f")).alias("gender"),
        reconcile.triage(F.when(s % 2 == 0, "a.b").otherwise("ab"), F.when(s % 2 == 0, "ab").when(s % 3 == 0, "(a)c").otherwise("ac"), lambda c: F.translate(c, ".", "")).alias("triage"), reconcile.sense_evidence(F.lit(10), s, s - 20).alias("missing"),
        F.array_join(reconcile.uncovered_senses(F.array(F.lit("环;圈")), F.array(F.when(s % 2 == 0, "圈").otherwise("锤"))), ",").alias("uncovered"),
    )


@query("SELECT c_custkey AS id, n_name || '的缩小形' AS translation FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 3 > 0")
def template_translations(t: Tables) -> DataFrame:
    """`Diminutive of x` with x's translation known: made from it; one line that fits nothing leaves the row out."""
    own = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    d = own.select(F.col("c_custkey").alias("id"), F.concat(F.lit("Diminutive of "), F.lower("n_name"), F.when(F.col("c_custkey") % 3 == 0, F.lit("\nother")).otherwise("")).alias("definition"))
    known = t.nation.select(F.lower("n_name").alias("word"), F.col("n_name").alias("translation"))
    return reconcile.template_translations(d, known, [(r"^Diminutive of (\S+)$", "的缩小形")])


@query("SELECT 're' || w AS word, w AS roots FROM (SELECT DISTINCT split_part(p_name, ' ', 1) AS w FROM part) UNION ALL SELECT w || 'ing', w FROM (SELECT DISTINCT split_part(p_name, ' ', 1) AS w FROM part)")
def candidate_roots(t: Tables) -> DataFrame:
    """Known words that a word may derive from, by a prefix or an ending."""
    w = t.part.select(F.substring_index("p_name", " ", 1).alias("word")).distinct()
    made = w.select(F.concat(F.lit("re"), "word").alias("word")).unionByName(w.select(F.concat("word", F.lit("ing")).alias("word")))
    found = reconcile.candidate_roots(made, w, ["re"], [("ing", "")], F.lower)
    return found.select("word", F.array_join("roots", ",").alias("roots"))


@query("SELECT n_name AS word, 'one:' || n_name || '|two:' || r_name AS evidence FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 2 = 0")
def evidence(t: Tables) -> DataFrame:
    """What each source says of words without a gloss."""
    both = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    one, two = both.select(F.col("n_name").alias("word"), F.col("n_name").alias("gloss")), both.select(F.col("n_name").alias("word"), F.col("r_name").alias("gloss"))
    found = reconcile.evidence({"two": two, "one": one}, t.nation.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("word")))
    return found.select("word", F.array_join(F.transform("evidence", lambda e: F.concat(e["source"], F.lit(":"), e["gloss"])), "|").alias("evidence"))


@query("SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN '/' || split_part(p_name, ' ', 1) || '/' END AS inherited FROM part")
def inherited_sounds(t: Tables) -> DataFrame:
    """The base's pronunciation where stem and onset of form and base agree."""
    first = F.substring_index("p_name", " ", 1)
    forms = t.part.select(F.col("p_partkey").alias("id"), F.concat(first, F.lit("a")).alias("word"), F.when(F.col("p_size") % 2 == 0, first).otherwise("none").alias("base"), F.lit(None).cast("string").alias("ipa"))
    known = t.part.select(first.alias("word")).distinct().select(F.lit(-1).cast("long").alias("id"), "word", F.lit(None).cast("string").alias("base"), F.concat(F.lit("/"), "word", F.lit("/")).alias("ipa"))
    out = reconcile.inherited(forms.unionByName(known), "base", "ipa", lambda c: F.regexp_replace(c, "a$", ""), lambda c: F.substring(c, 1, 1))
    return out.where("id >= 0").select("id", "inherited")


@query("SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN p_size % 4 = 0 THEN 'uncovered' WHEN p_size % 4 = 1 THEN 'exact' WHEN p_size % 4 = 2 THEN 'stress' ELSE 'differs' END AS outcome FROM part) GROUP BY 1")
def hold_out(t: Tables) -> DataFrame:
    """Composed pronunciations against those that are known."""
    s = F.col("p_size")
    d = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("word"), F.lit("ˈa b").alias("ipa"))
    made = t.part.where("p_size % 4 > 0").select(F.col("p_partkey").alias("id"), F.when(s % 4 == 1, "ˈa b").when(s % 4 == 2, "a ˈb").otherwise("x").alias("composed"))
    return editions.hold_out(d, made)


@query("SELECT CASE p_size % 3 WHEN 0 THEN 'A_misalign' WHEN 1 THEN 'B_semflag' ELSE 'C_noflag' END AS group, count(*) AS total, count(*) FILTER (p_type = 'SMALL') AS ok, count(*) FILTER (p_type = 'LARGE') AS warn, count(*) FILTER (p_type NOT IN ('SMALL', 'LARGE')) AS bad, count(*) FILTER (p_type NOT IN ('SMALL', 'LARGE')) / count(*) AS bad_share FROM part GROUP BY 1")
def group_quality(t: Tables) -> DataFrame:
    """Quality of three groups of flags, compared."""
    flag = F.when(F.col("p_size") % 3 == 0, "__misalign__ 2/3").when(F.col("p_size") % 3 == 1, "semantic").otherwise("")
    verdict = F.when(F.col("p_type") == "SMALL", "ok").when(F.col("p_type") == "LARGE", "warn").otherwise("bad")
    return editions.group_quality(t.part.select(flag.alias("flag"), verdict.alias("verdict")), editions.flag_group(F.col("flag")))


@query("SELECT 'marked' AS kind, count(*) FILTER (p_size % 3 = 0) AS n FROM part UNION ALL SELECT 'other', count(*) FILTER (p_size % 3 = 1) FROM part")
def flag_selections(t: Tables) -> DataFrame:
    flag = F.when(F.col("p_size") % 3 == 0, "__misalign__ 2/3").when(F.col("p_size") % 3 == 1, "xxmisalignxx").otherwise("")
    marked, other = editions.flagged(t.part.select(flag.alias("flag")))
    return marked.agg(F.count("*").alias("n")).select(F.lit("marked").alias("kind"), "n").unionByName(other.agg(F.count("*").alias("n")).select(F.lit("other").alias("kind"), "n"))


@query("SELECT o_orderstatus AS before, CASE WHEN o_orderkey % 3 = 0 THEN 'novote' WHEN o_orderkey % 3 = 1 THEN 'F' ELSE 'O' END AS after, count(*) AS n FROM orders GROUP BY 1, 2")
def verdict_migration(t: Tables) -> DataFrame:
    """How verdicts moved between two judgements."""
    before = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("v"))
    after = before.where("id % 3 > 0").withColumn("v", F.when(F.col("id") % 3 == 1, "F").otherwise("O"))
    return editions.migration(before, after, "v")


@query("SELECT count(*) FILTER (o_orderstatus IN ('F', 'P') AND o_orderkey % 2 = 0) AS improved, count(*) FILTER (o_orderstatus = 'O' AND o_orderkey % 2 = 1) AS degraded FROM orders")
def verdicts_moved(t: Tables) -> DataFrame:
    before = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("v"))
    return editions.moved(editions.migration(before, before.withColumn("v", F.when(F.col("id") % 2 == 0, "O").otherwise("F")), "v"), "O", ("F", "P"))


@query(
    "SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN n_name END AS plural, CASE WHEN c_custkey % 3 = 0 THEN 'own' WHEN c_custkey % 2 = 0 THEN r_name END AS gender FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
)
def essence_backfill(t: Tables) -> DataFrame:
    """Blank essentials filled from another table, only for words of the right parts of speech."""
    own = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    d = own.select(F.col("c_custkey").alias("id"), F.upper("n_name").alias("word"), F.when(F.col("c_custkey") % 2 == 0, "n/adj").otherwise("v").alias("pos"), F.lit(None).cast("string").alias("plural"), F.when(F.col("c_custkey") % 3 == 0, "own").otherwise(" ").alias("gender"))
    essence = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.lower("n_name").alias("word"), F.col("n_name").alias("plural"), F.col("r_name").alias("gender"))
    return editions.backfilled(d, essence, {"plural": ("n",), "gender": ("n", "name")}).select("id", "plural", F.nullif(F.trim("gender"), F.lit("")).alias("gender"))


@query("SELECT p_partkey AS id, 'n|' || CASE WHEN p_size % 2 = 0 THEN 'v' ELSE '-' END AS line_pos FROM part")
def parts_of_senses(t: Tables) -> DataFrame:
    """A part of speech for each gloss: that of word and gloss, else the word's only one."""
    d = t.part.select(F.col("p_partkey").alias("id"), F.initcap("p_name").alias("word"), F.concat(F.lit("known\nother"), F.col("p_partkey")).alias("definition"), F.when(F.col("p_size") % 2 == 0, "v").otherwise("n/v").alias("pos"))
    senses = t.part.select(F.lower("p_name").alias("key"), F.col("p_partkey").alias("seq"), F.lit("known").alias("gloss"), F.lit("n").alias("pos"))
    out = editions.parts_patched(d, editions.sense_parts(senses))
    return out.select("id", F.array_join(F.transform("line_pos", lambda p: F.coalesce(p, F.lit("-"))), "|").alias("line_pos"))


@query("SELECT p_partkey AS id FROM part WHERE p_size % 2 = 1 AND split_part(p_name, ' ', 1) IN (SELECT split_part(p_name, ' ', 1) FROM part WHERE p_size = 10)")
def reflexive_bases(t: Tables) -> DataFrame:
    """Rows whose base has a row of the other kind."""
    d = t.part.select(F.col("p_partkey").alias("id"), F.concat(F.lit("compound of "), F.substring_index("p_name", " ", 1), F.when(F.col("p_size") == 10, F.lit(" with si")).when(F.col("p_size") % 2 == 1, F.lit(" with ci")).otherwise("")).alias("g"))
    return editions.reflexive_bases(d, F.nullif(F.regexp_extract("g", r"of (\w+) with", 1), F.lit("")), F.col("g").rlike("with si$"), F.col("g").rlike("with ci$")).select("id")


@query("SELECT n_name AS word, CASE WHEN n_nationkey % 2 = 0 THEN 'C' ELSE 'A' END AS bucket, split_part(r_name, ' ', 1) AS base, CASE WHEN n_nationkey % 2 = 0 THEN '女人' ELSE '演员|女人' END AS novel FROM nation JOIN region ON n_regionkey = r_regionkey")
def feminine_recovery(t: Tables) -> DataFrame:
    """Feminine equivalents that were dropped as forms: their bucket, and offered senses that say something new."""
    both = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    sense = F.struct(F.array(F.concat(F.lit("female equivalent of "), "r_name")).alias("glosses"), F.array(F.lit("form-of")).alias("tags"))
    entries = both.select(F.col("n_nationkey").cast("long").alias("seq"), F.col("n_name").alias("word"), F.array(sense).alias("senses"))
    table = both.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("word"), F.lit(1).alias("is_lemma"), F.when(F.col("n_nationkey") % 2 == 0, "阴性单数\n演员").otherwise("阴性单数").alias("translation"))
    offers = both.select(F.col("n_name").alias("word"), F.array(F.lit("演员"), F.lit("女人"), F.lit("女人")).alias("senses"))
    found = editions.feminine_recovered(table, entries, offers, "^(阴性|阳性)(单数|复数)$")
    return found.select("word", "bucket", "base", F.array_join("novel", "|").alias("novel"))


_POINTING = """SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN 'cat的复数' WHEN 1 THEN 'genus felis的复数' WHEN 2 THEN 'nothing的复数' WHEN 3 THEN '[网络]' ELSE 'dog的复数' END AS t FROM customer"""


@query(f"SELECT CASE id % 5 WHEN 0 THEN 'ok' WHEN 1 THEN 'taxon' WHEN 2 THEN 'unknown base' ELSE 'web' END AS reason, count(*) AS n FROM ({_POINTING}) WHERE id % 5 <> 3 AND id % 7 > 0 GROUP BY 1 UNION ALL SELECT 'blocked', count(*) FROM ({_POINTING}) WHERE id % 5 <> 3 AND id % 7 = 0")
def pointer_targets(t: Tables) -> DataFrame:
    """Whose text a pointing row may take, and why others have none."""
    return editions.pointer_targets(_pointing(t), t.customer.where("c_custkey % 7 = 0").select(F.col("c_custkey").alias("id")))[1].select("reason", F.col("count").alias("n"))


def _pointing(t: Tables) -> DataFrame:
    k = F.col("c_custkey") % 5
    text = F.when(k == 0, "cat的复数").when(k == 1, "genus felis的复数").when(k == 2, "nothing的复数").when(k == 3, "[网络]").otherwise("dog的复数")
    rows = t.customer.select(F.col("c_custkey").alias("id"), F.when(k == 0, "cats").when(k == 4, "dogs").otherwise("xs").alias("word"), text.alias("translation"))
    bases = t.spark.createDataFrame([(-1, "cat", "n. 猫"), (-2, "dog", "[网络] 狗")], "id long, word string, translation string")
    return rows.unionByName(bases)


@query(f"SELECT id, CASE id % 5 WHEN 0 THEN 'cat' WHEN 1 THEN 'genus felis' WHEN 2 THEN 'nothing' ELSE 'dog' END AS base, CASE id % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'F' WHEN 2 THEN 'D' ELSE 'B' END AS layer FROM ({_POINTING}) WHERE id % 5 <> 3")
def anchor_layers(t: Tables) -> DataFrame:
    """What may anchor the rewriting of pointing rows."""
    glosses = t.spark.createDataFrame([("cat",)], "word string")
    return editions.anchor_layers(_pointing(t), glosses, glosses.limit(0))


@query("SELECT n_name AS word, 'n' AS pos, 1 AS is_lemma, 'g' AS definition, NULL::VARCHAR AS translation, '0:' || r_name AS exchange FROM nation JOIN region ON n_regionkey = r_regionkey")
def staged_edition(t: Tables) -> DataFrame:
    """Staged rows: bases that nobody has aren't pointed to; applied under just the declared changes."""
    both = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    records = both.select(F.col("n_name").alias("word"), F.lit("n").alias("pos"), F.array(F.lit("g")).alias("glosses"), F.array().cast("array<string>").alias("infl"), F.array("r_name", F.lit("nobody")).alias("bases"), F.lit(True).alias("is_lemma"))
    rows, _ = editions.staged_rows(records, t.region.select(F.col("r_name").alias("word")))
    store = sinks.Store(t.spark, sinks.shared_path(t.spark, "edition"))
    store.publish(store.stage(rows.limit(0)))
    declared = editions.stage_and_apply(store, rows)
    assert declared["exchange"] == declared["__rows__"]
    editions.stage_and_apply(store, rows, dry=False)
    return store.current()


@query("SELECT s_suppkey AS id, CASE WHEN s_suppkey % 2 = 0 THEN 'f' ELSE 'm' END AS gender FROM supplier")
def genders_repaired(t: Tables) -> DataFrame:
    d = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("word"), F.concat(F.lit("x\n"), "s_name").alias("definition"), F.lit("m").alias("gender"))
    dual = t.supplier.select(F.col("s_name").alias("key"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).otherwise("other").alias("gloss"), F.lit("f").alias("gender"))
    return editions.gender_repaired(d, dual).select("id", "gender")


@query("SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN p_size % 5 = 0 THEN 'bucket' WHEN p_size % 3 = 0 THEN 'no anchor' ELSE 'ok' END AS outcome FROM part) GROUP BY 1")
def anchors_collected(t: Tables) -> DataFrame:
    """Rows of the wanted buckets with their anchor; the others counted by reason."""
    s = F.col("p_size")
    rows = t.part.select(F.col("p_partkey").alias("id"), F.concat(F.when(s % 3 == 0, F.lit("un")).otherwise(""), "p_name").alias("word"), F.when(s % 5 == 0, "C1").otherwise("A1").alias("bucket"))
    anchors = t.part.select("p_name").distinct().select(F.col("p_name").alias("word"), F.array(F.lit("a thing"), F.lit("another")).alias("senses"))
    return rewrite.collect(rows, anchors, ["A1"])[1].select("outcome", F.col("count").alias("n"))


@query("SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN 'own sense' WHEN p_size % 3 = 0 THEN 'base sense' ELSE 'base text' END AS anchor FROM part")
def anchors_through_base(t: Tables) -> DataFrame:
    """An anchor that points on: the base's anchor, else the base's own text."""
    s = F.col("p_size")
    rows = t.part.select(F.col("p_partkey").alias("id"), F.concat(F.lit("w"), "p_partkey").alias("word"), F.lit("t").alias("translation"))
    rows = rows.unionByName(t.spark.createDataFrame([(-1, "beta", "base text")], "id long, word string, translation string"))
    anchors = t.part.select(F.concat(F.lit("w"), "p_partkey").alias("word"), F.array(F.when(s % 2 == 0, "own sense").when(s % 3 == 0, "plural of alpha").otherwise("plural of beta")).alias("senses"))
    anchors = anchors.unionByName(t.spark.createDataFrame([("alpha", ["base sense"])], "word string, senses array<string>"))
    return rewrite.through_base(rows, anchors).where("id >= 0").select("id", "anchor")


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'no verb' ELSE 'abbreviation' END AS reason FROM orders WHERE o_orderkey % 3 > 0 AND o_orderkey % 5 > 0")
def ledger_suspects(t: Tables) -> DataFrame:
    """A ledger's rows that were filled from the wrong base, less what is done."""
    k = F.col("o_orderkey")
    base = F.when(k % 3 == 0, "run").when(k % 2 == 0, "cat").otherwise("FBI")
    ledger = t.orders.select(k.alias("id"), base.alias("base"), F.when((k % 3 == 0) | (k % 2 == 0), "过去式").otherwise("复数").alias("label"))
    words = t.spark.createDataFrame([("run", "v/n"), ("cat", "n"), ("fbi", None)], "word string, pos string")
    return rewrite.suspects(ledger, words, t.orders.where("o_orderkey % 5 = 0").select(k.alias("id"))).select("id", "reason")


@query("SELECT p_partkey AS id, '{\"id\":' || p_partkey || ',\"word\":\"' || p_name || '\",\"glosses\":[\"see ' || p_type || '\",\"b\"],\"references\":{\"' || lower(p_type) || '\":\"' || p_type || '!\"}}' AS payload FROM part WHERE p_size % 2 = 0")
def payloads(t: Tables) -> DataFrame:
    """What is asked: cleaned lines with what they refer to; a row of which a line becomes blank is left out."""
    rows = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("word"), F.concat(F.lit("see "), "p_type", F.when(F.col("p_size") % 2 == 0, F.lit("\nb ;")).otherwise("\n;")).alias("definition"))
    cross = t.part.select(F.lower("p_type").alias("word"), F.concat("p_type", F.lit("!")).alias("translation"))
    return rewrite.payload(rows, cross)


@query("SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN p_size % 5 = 0 THEN 'word' WHEN p_size % 3 = 0 THEN 'count' WHEN p_size % 2 = 0 THEN 'blank' ELSE 'ok' END AS outcome FROM part WHERE p_partkey % 2 = 0) GROUP BY 1")
def translations_applied(t: Tables) -> DataFrame:
    s = F.col("p_size")
    rows = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("word"), F.lit("a\nb").alias("definition"), F.lit(None).cast("string").alias("translation"))
    lines = F.when(s % 3 == 0, F.array(F.lit("x"))).when(s % 2 == 0, F.array(F.lit("x"), F.lit(" "))).otherwise(F.array(F.lit("x"), F.lit("y")))
    replies = t.part.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("id"), F.when(s % 5 == 0, "other").otherwise(F.col("p_name")).alias("word"), lines.alias("lines"))
    return rewrite.apply_translations(rows, replies)[1].select("outcome", F.col("count").alias("n"))


@query("SELECT p_partkey AS id, CASE WHEN p_size % 3 = 0 THEN 'a' ELSE 'a' || chr(10) || 'new' END AS translation FROM part")
def senses_appended(t: Tables) -> DataFrame:
    """One more sense at the end of three aligned lists."""
    rows = t.part.select(F.col("p_partkey").alias("id"), F.when(F.col("p_size") % 3 == 0, "x\ny").otherwise("x").alias("definition"), F.lit("a").alias("translation"), F.lit('[{"g":"f"}]').alias("meta"))
    extra = t.part.select(F.col("p_partkey").alias("id"), F.lit("gloss").alias("gloss"), F.lit("new").alias("zh"), F.lit("{}").alias("note"))
    return rewrite.appended_sense(rows, extra)[0].select("id", "translation")


@query("SELECT p_partkey AS id, p_name AS v FROM part")
def replayed(t: Tables) -> DataFrame:
    """Answers applied as if for the first time, an earlier run's changes undone before."""
    rows = t.part.select(F.col("p_partkey").alias("id"), F.concat("p_name", F.lit("!")).alias("v"))
    ledger = t.part.where("p_size % 2 = 0").select(F.col("p_partkey").alias("id"), F.lit("old").alias("before"), F.concat("p_name", F.lit("!")).alias("after"))
    replies = t.part.select(F.col("p_partkey").alias("id"), F.lit("rewrite").alias("fix"), F.concat(F.lit(" "), "p_name").alias("text"))
    return rewrite.replay(rows, ledger, replies, "v")[0]


@query("SELECT p_partkey AS id, CASE WHEN p_size % 4 = 0 THEN 'empty' WHEN p_size % 3 = 0 THEN 'han' WHEN p_size % 2 = 0 THEN 'letters' ELSE 'shorter' END AS reason, CASE WHEN p_size % 2 = 0 THEN 'f' ELSE 'mf' END AS gender, CASE WHEN p_size % 2 = 0 THEN 'B2' END AS level FROM part")
def gates(t: Tables) -> DataFrame:
    """Why new values aren't taken; a resolved gender; valid levels."""
    s = F.col("p_size")
    new = F.when(s % 4 == 0, " ").when(s % 3 == 0, "环abcdefgh").when(s % 2 == 0, "abcdefgh7").otherwise("abc")
    gender = merge.resolved_gender(F.when(s % 2 == 0, F.array(F.lit("f"))).otherwise(F.array(F.lit("mf"))), F.lit("f"))
    return t.part.select(F.col("p_partkey").alias("id"), merge.gate_reasons(F.lit("abcdefghij"), new, "a-z ").alias("reason"), gender.alias("gender"), merge.level(F.when(s % 2 == 0, " b2").otherwise("X9")).alias("level"))


@query("SELECT p_partkey AS id, CASE WHEN substr(md5('2:' || p_partkey), 1, 8) < '33333333' THEN substr(p_name, length(p_name) // 2 + 1) || substr(p_name, 1, length(p_name) // 2) ELSE p_name END AS v, p_name AS v_raw FROM part")
def controls(t: Tables) -> DataFrame:
    """A share of rows with a wrong value on purpose; the value as it came is kept beside."""
    d = merge.preserved_then(t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("v")), "v", F.col("v"))
    return sampling.with_controls(d, "v", "id", 0.2).select("id", "v", "v_raw")


@query("SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN 't' || p_size END AS top FROM part")
def topics_in_notes(t: Tables) -> DataFrame:
    """Topics written into sense notes by position; left out where there aren't as many."""
    s = F.col("p_size")
    meta = F.array(F.struct(F.lit("n").alias("pos"), F.lit(None).cast("string").alias("top")))
    tops = F.when(s % 2 == 0, F.array(F.concat(F.lit("t"), s))).otherwise(F.array(F.lit("a"), F.lit("b")))
    return t.part.select(F.col("p_partkey").alias("id"), F.element_at(topics.into_meta(meta, tops), 1)["top"].alias("top"))


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def last_written(t: Tables) -> DataFrame:
    return build.last_written(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def work_left(t: Tables) -> DataFrame:
    """What is still to be done, given the results so far."""
    return resume.remaining(t.orders.select("o_orderkey"), t.lineitem.where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


def _served(t: Tables) -> Service:
    path = sinks.shared_path(t.spark, "served")
    text = lambda x: F.lit(x).cast("string")
    table = t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("word"), F.col("p_name").alias("word_norm"), F.lit("n").alias("pos"), (F.col("p_size") % 2).alias("is_lemma"), F.when(F.col("p_size") % 3 > 0, F.concat(F.lit("t"), "p_size")).alias("translation"),
        F.concat("p_type", F.lit("\nx")).alias("definition"), F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("/"), "p_name", F.lit("/"))).alias("ipa"), text(None).alias("exchange"), text(None).alias("meta"), text(None).alias("collocation"), text(None).alias("infl"),
    )
    sinks.clustered(table, F.col("word"), path, 3)
    return Service(t.spark, "it", path)


@query("SELECT count(*) AS total, count(*) FILTER (p_size % 2 = 1) AS lemmas, count(*) FILTER (p_size % 3 > 0) AS translated, count(*) FILTER (p_size % 5 = 0) AS phonetic FROM part")
def service_stats(t: Tables) -> DataFrame:
    return _served(t).get_stats()


@query("SELECT p_partkey AS id, p_name AS word, 'n' AS pos, CASE WHEN p_size % 3 > 0 THEN 't' || p_size ELSE p_type END AS brief FROM part WHERE starts_with(p_name, 'gre') ORDER BY p_size % 2 DESC, length(p_name), p_name, p_partkey LIMIT 15")
def service_search(t: Tables) -> DataFrame:
    """A ranked prefix search over a written dictionary, from the ranges of its key."""
    return _served(t).search("Gre", 15)


@query("SELECT p_partkey AS id, p_name AS word, CASE WHEN p_size % 5 = 0 THEN p_name END AS ipa FROM part WHERE p_name = 'green ring' ORDER BY p_size % 2 DESC, p_partkey LIMIT 1")
def service_entry(t: Tables) -> DataFrame:
    return _served(t).get_entry("GREEN ring").select("id", "word", "ipa")


@query("SELECT p_partkey, p_name FROM part WHERE starts_with(p_name, 'red') ORDER BY CASE WHEN p_name = 'red' THEN 0 ELSE 1 END, p_size % 2 DESC, length(p_name), p_name, p_partkey LIMIT 50")
def lemma_search(t: Tables) -> DataFrame:
    """Lemmas first; a limit beyond the most is cut to it."""
    d = t.part.withColumn("lemma", F.col("p_size") % 2)
    return lookup.search(d, "red", lookup.clamp("900"), "p_name", None, lookup.by_lemma("red", "p_name", "lemma"), "p_partkey").select("p_partkey", "p_name")
