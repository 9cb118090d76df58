"""Joins, merges, governance and reconciliation."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.functions.text import misaligned
from lexigrid.operators import fold, govern, merge, reconcile
from lexigrid.plans.build import lemma
from lexigrid.queries.registry import Tables, query
from lexigrid.sources import sinks


@query("SELECT 'documents' AS name_of, unnest(['__rows__', 'lang', 'source', 'text']) AS name, unnest([count(*), count(*) FILTER (trim(lang, ' ') <> ''), count(*) FILTER (lang <> 'en'), count(*) FILTER (trim(text, ' ') <> '')]) AS n FROM documents")
def snapshot_counts(t: Tables) -> DataFrame:
    d = t.documents.select("lang", "text", F.when(F.col("lang") != "en", F.col("source")).otherwise(F.lit("  ")).alias("source"))
    return govern.snapshot(d, ["lang", "source", "text", "not_there"]).select(F.lit("documents").alias("name_of"), "name", "n")


@query(
    """WITH b AS (SELECT count(*) AS r, count(c_name) AS a, count(c_mktsegment) AS s, 0 AS x FROM customer), a AS (SELECT count(*) AS r, count(c_name) AS a, count(*) FILTER (c_nationkey > 3) AS s, count(*) AS x FROM customer WHERE c_acctbal >= 0),
d AS (SELECT unnest(['__rows__', 'c_name', 'c_mktsegment', 'extra']) AS name, unnest([b.r, b.a, b.s, b.x]) AS before, unnest([a.r, a.a, a.s, a.x]) AS after FROM a, b) SELECT name, before, after, after - before AS delta FROM d WHERE after <> before"""
)
def snapshot_diff(t: Tables) -> DataFrame:
    """What an update changed in number, over the columns of both sides."""
    after = t.customer.where("c_acctbal >= 0").select("c_name", F.when(F.col("c_nationkey") > 3, F.col("c_mktsegment")).alias("c_mktsegment"), F.lit("x").alias("extra"))
    return govern.snapshot_diff(govern.snapshot(t.customer, ["c_name", "c_mktsegment"]), govern.snapshot(after))


@query("SELECT l_returnflag, CASE WHEN o_orderkey IS NULL THEN 'orphan' ELSE 'known' END AS class, count(*) AS n FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey GROUP BY ALL")
def orphan_bases(t: Tables) -> DataFrame:
    """Pointers to what isn't there, where some parents are taken away."""
    parents = t.orders.where("o_orderstatus <> 'P'").select("o_orderkey")
    j = t.lineitem.select("l_orderkey", "l_returnflag").join(parents, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return j.groupBy("l_returnflag", F.when(F.col("o_orderkey").isNull(), "orphan").otherwise("known").alias("class")).agg(F.count("*").alias("n"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def left_semi_known(t: Tables) -> DataFrame:
    """Rows whose key is among given ones, by the readers' semi join."""
    from lexigrid.sources.readers import only_words

    own = t.customer.withColumn("word", F.col("c_custkey").cast("string"))
    return only_words(own, t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").cast("string").alias("word"))).select("c_custkey", "c_name")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def left_anti_new(t: Tables) -> DataFrame:
    """Rows whose key isn't among those that are done."""
    from lexigrid.streaming.resume import remaining

    return remaining(t.documents.select("doc_id"), t.labels, "doc_id")


@query("SELECT d.doc_id, (coalesce(quality, 0) > 0 OR (quality IS NULL AND d.lang = 'en')) AS is_lemma FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def lemma_rule(t: Tables) -> DataFrame:
    """A gloss of one's own, or nothing known at all."""
    none = F.array().cast("array<string>")
    d = t.documents.join(t.labels, "doc_id", "left")
    glosses = F.when(F.col("quality") > 0, F.array("lang")).otherwise(none)
    infl = F.when(F.col("quality") == 0, F.array("lang")).otherwise(none)
    bases = F.when(F.col("quality").isNull() & (F.col("lang") != "en"), F.array("lang")).otherwise(none)
    return d.select("doc_id", lemma(glosses, infl, bases).alias("is_lemma"))


def _merged(t: Tables) -> tuple[DataFrame, DataFrame]:
    pos = F.when(F.col("c_nationkey") < 12, "n").otherwise("v/adj")
    d = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("word"), pos.alias("pos"), F.when(F.col("c_acctbal") >= 1000, F.col("c_mktsegment")).alias("segment"), F.lit("old").alias("flag"))
    offers = t.customer.where("c_acctbal < 6000").select(F.col("c_custkey").alias("id"), F.when(F.col("c_acctbal") < 4000, F.concat(F.lit(" "), "c_mktsegment")).otherwise(F.lit("MACHINERY")).alias("segment"), F.when(F.col("c_acctbal") < 0, "new").alias("flag"))
    fields = [merge.Field("segment", accept=lambda c: c.rlike("^[A-Z]{2,}$"), pos=("n", "name")), merge.Field("flag", overwrite=True)]
    return merge.fill_merge(d, offers, fields)


@query("SELECT c_custkey AS id, CASE WHEN c_acctbal >= 1000 THEN c_mktsegment WHEN c_nationkey < 12 THEN c_mktsegment END AS segment, CASE WHEN c_acctbal < 0 THEN 'new' WHEN c_acctbal < 6000 THEN NULL ELSE 'old' END AS flag FROM customer")
def fill_null_merge(t: Tables) -> DataFrame:
    """Gaps are filled where the word's kind allows; one field is taken as offered, even as nothing."""
    return _merged(t)[0].select("id", "segment", "flag")


@query("SELECT c_name AS word, 'segment' AS field, c_mktsegment AS kept, 'MACHINERY' AS offered FROM customer WHERE c_acctbal >= 4000 AND c_acctbal < 6000 AND c_nationkey < 12 AND c_mktsegment <> 'MACHINERY'")
def conflict_ledger(t: Tables) -> DataFrame:
    """Where both sources have a value and they differ."""
    return _merged(t)[1]


@query("SELECT o_orderkey, coalesce(CASE WHEN o_totalprice > 300000 THEN o_orderpriority END, CASE WHEN o_orderstatus = 'F' THEN 'done' END, CASE WHEN o_custkey > 100 THEN 'late' END) AS value, CASE WHEN o_totalprice > 300000 THEN 'authority' WHEN o_orderstatus = 'F' THEN 'rule' WHEN o_custkey > 100 THEN 'plain' END AS source FROM orders")
def fill_order(t: Tables) -> DataFrame:
    value, source = merge.fill_in_order(("authority", F.when(F.col("o_totalprice") > 300000, F.col("o_orderpriority"))), ("rule", F.when(F.col("o_orderstatus") == "F", "done").otherwise(" ")), ("plain", F.when(F.col("o_custkey") > 100, "late")))
    return t.orders.select("o_orderkey", value.alias("value"), source.alias("source"))


@query("SELECT doc_id AS id, CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'good' ELSE lang END AS grade FROM documents LEFT JOIN labels USING (doc_id)")
def quality_overlay(t: Tables) -> DataFrame:
    toxic = t.labels.where("toxic = 1").select(F.col("doc_id").alias("id"), F.lit("toxic").alias("v"))
    good = t.labels.where("quality = 1").select(F.col("doc_id").alias("id"), F.lit("good").alias("v"))
    return merge.overlay((toxic, "v"), (good, "v"), (t.documents.select(F.col("doc_id").alias("id"), "lang"), "lang"))


@query("SELECT verdict, count(*) AS n FROM (SELECT CASE WHEN fresh IS NULL THEN 'no_vote' WHEN fresh = quality THEN 'keep' WHEN fresh = toxic THEN 'override' ELSE 'three_way' END AS verdict FROM (SELECT quality, toxic, CASE lang WHEN 'de' THEN NULL WHEN 'en' THEN 1 WHEN 'fr' THEN 0 ELSE 2 END AS fresh FROM labels JOIN documents USING (doc_id))) GROUP BY verdict")
def vote_verdict(t: Tables) -> DataFrame:
    fresh = F.when(F.col("lang") == "en", "1").when(F.col("lang") == "fr", "0").when(F.col("lang") != "de", "2")
    j = t.labels.join(t.documents.select("doc_id", "lang"), "doc_id")
    return j.groupBy(reconcile.vote(F.col("quality").cast("string"), F.col("toxic").cast("string"), fresh).alias("verdict")).agg(F.count("*").alias("n"))


@query("SELECT class, count(*) AS n FROM (SELECT CASE WHEN value IS NULL THEN NULL WHEN value = authority THEN 'authority' WHEN value = rule THEN 'rule' WHEN authority IS NOT NULL THEN 'overwritten' ELSE 'unknown' END AS class FROM (SELECT o_orderstatus AS value, s AS authority, CASE WHEN o_totalprice > 250000 THEN 'P' ELSE 'O' END AS rule FROM orders LEFT JOIN (SELECT l_orderkey, min(l_linestatus) AS s FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey)) GROUP BY class")
def provenance_class(t: Tables) -> DataFrame:
    """Where a status comes from: what its lines say, a rule, neither."""
    said = t.lineitem.groupBy("l_orderkey").agg(F.min("l_linestatus").alias("s"))
    j = t.orders.join(said, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return j.groupBy(reconcile.provenance(F.col("o_orderstatus"), F.col("s"), F.when(F.col("o_totalprice") > 250000, "P").otherwise("O")).alias("class")).agg(F.count("*").alias("n"))


@query("SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN NULL WHEN p_brand = b THEN 'exact' WHEN substr(p_brand, 1, 7) = substr(b, 1, 7) THEN 'notation' END AS confirm FROM part JOIN (SELECT p_name, min(p_brand) AS b FROM part GROUP BY p_name) USING (p_name)")
def self_confirm_excluded(t: Tables) -> DataFrame:
    """A value isn't confirmed by the edition that it came from."""
    edition = t.part.groupBy(F.col("p_name").alias("word")).agg(F.min("p_brand").alias("value"))
    d = t.part.select("p_partkey", F.col("p_name").alias("word"), F.col("p_brand").alias("value"), F.col("p_type").alias("source"))
    return reconcile.confirmed(d, edition, "value", "source", "PROMO", [lambda c: F.substring(c, 1, 7)]).select("p_partkey", "confirm")


@query(
    """WITH x AS (SELECT l_orderkey, list_distinct(list(l_partkey) FILTER (l_returnflag <> 'R')) AS a, list_distinct(list(l_partkey) FILTER (l_linestatus = 'F')) AS b FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, CASE WHEN coalesce(len(b), 0) = 0 THEN 'unverifiable' WHEN coalesce(len(a), 0) = 0 THEN 'missing' WHEN list_has_all(a, b) AND list_has_all(b, a) THEN 'faithful' WHEN list_has_all(b, a) THEN 'subset' WHEN list_has_all(a, b) THEN 'superset' WHEN list_has_any(a, b) THEN 'overlap' ELSE 'conflict' END AS verdict FROM x"""
)
def set_compare(t: Tables) -> DataFrame:
    own = t.lineitem.groupBy("l_orderkey").agg(F.collect_set(F.when(F.col("l_returnflag") != "R", F.col("l_partkey"))).alias("a"), F.collect_set(F.when(F.col("l_linestatus") == "F", F.col("l_partkey"))).alias("b"))
    return own.select("l_orderkey", reconcile.set_verdict(F.col("a"), F.col("b")).alias("verdict"))


@query("SELECT p_partkey, CASE WHEN contains(lower(p_type), string_split(p_name, ' ')[1]) OR contains(lower(p_type), string_split(p_name, ' ')[2]) THEN 'L1' ELSE 'none' END AS level FROM part")
def agreement_l2(t: Tables) -> DataFrame:
    """Whether two glosses share a token or part of one: names against types."""
    return t.part.select("p_partkey", reconcile.agreement_level(F.col("p_name"), F.lower("p_type")).alias("level"))


@query("SELECT lang, count(*) FILTER (source = 'src0') AS src0, count(*) FILTER (source = 'src1') AS src1, count(*) FILTER (source = 'src2') AS src2, count(*) FILTER (source IN ('src0', 'src1', 'src2')) AS total FROM documents GROUP BY lang")
def crosstab_tier_source(t: Tables) -> DataFrame:
    return reconcile.crosstab(t.documents, "lang", "source", ["src0", "src1", "src2"])


@query("SELECT conv_id AS id, 'definition: lines' AS problem FROM conversations GROUP BY conv_id HAVING count(*) <> count(*) FILTER (role <> 'system') AND count(*) FILTER (role <> 'system') > 0")
def alignment_check(t: Tables) -> DataFrame:
    """Lists of lines that don't have as many items as their notes."""
    folded = t.conversations.groupBy(F.col("conv_id").alias("id")).agg(F.array_join(fold.ordered_list(F.when(F.col("role") != "system", F.col("role")), F.col("turn")), "\n").alias("definition"), F.to_json(fold.ordered_list(F.col("turn").cast("string"), F.col("turn"))).alias("meta"))
    return govern.alignment(folded, ["definition"], "meta")


@query("SELECT doc_id FROM documents WHERE trim(text, ' ') <> '' AND len(string_split(text, chr(10))) <> len(string_split(replace(text, '. ', '.' || chr(10)), chr(10)))")
def misalign_rows(t: Tables) -> DataFrame:
    """Rows whose two lists of lines differ in length."""
    return t.documents.where(misaligned(F.col("text"), F.replace("text", F.lit(". "), F.lit(".\n")))).select("doc_id")


@query("SELECT count(*) AS total, count(*) FILTER (q OR x) AS core, count(*) FILTER (NOT (q OR x)) AS tail, count(*) AS covered, 0::BIGINT AS overlapping FROM (SELECT coalesce(quality, 0) > 0 AS q, coalesce(toxic, 0) > 0 AS x FROM documents LEFT JOIN labels USING (doc_id))")
def core_nullsafe(t: Tables) -> DataFrame:
    """Core and tail make up all rows, though most signs are null."""
    from lexigrid.operators.classify import core

    d = t.documents.join(t.labels, "doc_id", "left").withColumn("tag", F.lit(None).cast("string"))
    is_core = core(["quality", "toxic"])
    return govern.partition_check(d, {"core": is_core, "tail": ~is_core})


@query("SELECT c_custkey, CASE WHEN c_nationkey < 5 THEN 'NEW' WHEN c_nationkey = 5 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer")
def update_by_id(t: Tables) -> DataFrame:
    changes = t.customer.where("c_nationkey <= 5").select("c_custkey", F.when(F.col("c_nationkey") < 5, "NEW").alias("c_mktsegment"))
    return sinks.updated_by_id(t.customer.select("c_custkey", "c_mktsegment"), changes, "c_custkey")


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN (SELECT min(n_name) FROM nation WHERE n_nationkey = c_nationkey) ELSE c_mktsegment END AS label FROM customer")
def fill_where_blank(t: Tables) -> DataFrame:
    d = t.customer.select("c_custkey", "c_nationkey", F.when(F.col("c_acctbal") < 0, " ").otherwise(F.col("c_mktsegment")).alias("label"))
    return sinks.filled_where_blank(d, t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("label")), "c_nationkey", "label").select("c_custkey", "label")


@query("SELECT c_custkey AS id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'HOUSE' ELSE c_mktsegment END AS segment FROM customer")
def guarded_update(t: Tables) -> DataFrame:
    """A change counts only where the value is still what it was; the others are rejected."""
    d = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    return merge.guarded(d, d.select("id", F.lit("BUILDING").alias("before"), F.lit("HOUSE").alias("after")), "segment")[0]


@query("SELECT outcome, count(*) AS count FROM (SELECT CASE WHEN c_nationkey < 5 THEN 'fix: keep' WHEN c_acctbal < 0 THEN 'blank' WHEN length(c_mktsegment) > 8 THEN 'long' ELSE 'ok' END AS outcome FROM customer WHERE c_nationkey < 20) GROUP BY outcome")
def response_outcomes(t: Tables) -> DataFrame:
    """What becomes of replies: kept, blank, rejected by a gate, written."""
    d = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    replies = t.customer.where("c_nationkey < 20").select(F.col("c_custkey").alias("id"), F.when(F.col("c_nationkey") < 5, "keep").otherwise("rewrite").alias("fix"), F.when(F.col("c_acctbal") < 0, "  ").otherwise(F.col("c_mktsegment")).alias("text"))
    return merge.response_applied(d, replies, "segment", gates=[("long", F.length("text") > 8)])[1]


@query("SELECT p_partkey AS id, '<' || replace(p_name, ' ', '> <') || '>' AS composed FROM part WHERE NOT contains(p_name, 'ring') AND contains(p_name, ' ')")
def composed_words(t: Tables) -> DataFrame:
    """Several words' pronunciation from the parts', only where each has one."""
    words = t.part.select(F.explode(F.split("p_name", " ")).alias("word")).distinct().where("NOT contains(word, 'ring')").select("word", F.concat(F.lit("<"), "word", F.lit(">")).alias("ipa"))
    return reconcile.composed(t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("word")), words)
