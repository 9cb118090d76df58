"""Folds, runs, first and last values, tags and topics."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.operators import fold, stats, topics
from lexigrid.queries.registry import Tables, query
from lexigrid.sources.readers import last_per_key
from lexigrid.sources.sinks import dense_ids


def _types_by_day(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.collect_set("event_type").alias("types"))


_SETS = "sets AS (SELECT user_id, ts::DATE AS day, list_sort(list_distinct(list(event_type))) AS types FROM events GROUP BY ALL)"
_COUNTS = "c AS (SELECT topic, count(*) AS n FROM (SELECT unnest(types) AS topic FROM sets) GROUP BY topic)"
_PAIRS = "p AS (SELECT a, b, count(*) AS n FROM (SELECT a, unnest(types) AS b FROM (SELECT types, unnest(types) AS a FROM sets)) WHERE a <> b GROUP BY a, b)"


@query(
    """WITH m AS (SELECT *, CASE WHEN event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM m)
SELECT user_id, run::BIGINT AS run, any_value(event_type) AS event_type, count(*) AS rows, min(ts) AS first, max(ts) AS last FROM r GROUP BY user_id, run"""
)
def adjacent_runs(t: Tables) -> DataFrame:
    return fold.adjacent_runs(t.events, ["user_id"], ["ts", "event_id"], "event_type")


@query("SELECT o_custkey, arg_min(s, o_orderkey) FILTER (WHERE s IS NOT NULL) AS status FROM (SELECT o_custkey, o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderstatus END AS s FROM orders) GROUP BY o_custkey")
def first_wins(t: Tables) -> DataFrame:
    """Of each customer the first status that is known."""
    s = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None)).otherwise(F.col("o_orderstatus"))
    return t.orders.groupBy("o_custkey").agg(fold.first_value(s, F.col("o_orderkey")).alias("status"))


@query("SELECT user_id, arg_max(value, event_id) AS value, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def last_wins(t: Tables) -> DataFrame:
    return last_per_key(t.events.select("user_id", "event_id", "value", "event_type"), ["user_id"], "event_id").select("user_id", "value", "event_type")


@query("SELECT user_id, string_agg(event_type, '>' ORDER BY e) AS seen FROM (SELECT user_id, event_type, min(event_id) AS e FROM events GROUP BY user_id, event_type) GROUP BY user_id")
def ordered_distinct(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.array_join(fold.ordered_distinct(F.col("event_type"), F.col("event_id")), ">").alias("seen"))


@query("SELECT user_id, string_agg(DISTINCT event_type, '/' ORDER BY event_type) AS types FROM events GROUP BY user_id")
def pos_set_join(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(fold.joined_set(F.col("event_type")).alias("types"))


@query(
    """SELECT c_mktsegment AS key, min(c_custkey) AS first_seq, arg_min(c_name, c_custkey) FILTER (WHERE c_acctbal >= 0) AS name, string_agg(DISTINCT CAST(c_nationkey AS VARCHAR), '/' ORDER BY CAST(c_nationkey AS VARCHAR)) AS nations,
bool_or(c_acctbal < 0) AS owes, 'mf' AS gender FROM customer GROUP BY c_mktsegment"""
)
def fold_records(t: Tables) -> DataFrame:
    """Many records into one row: first known name, set of nations, a flag, the closure of two genders."""
    d = t.customer.select("c_custkey", "c_mktsegment", F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("name"), F.col("c_nationkey").cast("string").alias("nations"), (F.col("c_acctbal") < 0).alias("owes"), F.when(F.col("c_acctbal") < 3000, "m").otherwise("f").alias("gender"))
    return fold.fold(d, F.col("c_mktsegment"), "c_custkey", {"name": "first", "nations": "set", "owes": "any", "gender": "gender"})


@query(
    """WITH e AS (SELECT user_id, event_id, CASE event_type WHEN 'view' THEN 'm' WHEN 'click' THEN 'f' WHEN 'error' THEN 'n' END AS g, json_extract_string(props, '$.k') AS gen FROM events),
f AS (SELECT user_id, g, arg_min(gen, event_id) AS gen FROM e WHERE g IS NOT NULL GROUP BY user_id, g)
SELECT user_id, '[' || string_agg('{"g":"' || g || '","gen":"' || gen || '"}', ',' ORDER BY position(g IN 'mfn')) || ']' AS noun_variants FROM f GROUP BY user_id HAVING count(*) > 1"""
)
def noun_variants(t: Tables) -> DataFrame:
    """A paradigm for each gender of words that have several."""
    g = F.element_at(F.create_map(*map(F.lit, ("view", "m", "click", "f", "error", "n"))), F.col("event_type"))
    return fold.paradigms(t.events.select("user_id", "event_id", g.alias("g"), F.get_json_object("props", "$.k").alias("gen")), "user_id", "g", ["gen"], "event_id")


@query("SELECT lang, count(*) AS total, count(*) FILTER (text IS NOT NULL AND trim(text, ' ') <> '') AS with_text, count(*) FILTER (contains(text, chr(10))) AS multi_line, count(*) FILTER (n_chars > 1000) AS long FROM documents GROUP BY lang")
def field_stats(t: Tables) -> DataFrame:
    from lexigrid.functions.text import present

    return stats.field_stats(t.documents, {"with_text": present(F.col("text")), "multi_line": F.contains("text", F.lit("\n")), "long": F.col("n_chars") > 1000}, ["lang"])


@query("SELECT event_type AS tag, count(*) AS n FROM events WHERE event_type NOT IN ('view', 'click') GROUP BY event_type")
def drop_ledger(t: Tables) -> DataFrame:
    """Tags in none of the known bags."""
    return stats.unknown_tags(t.events.select(F.array("event_type").alias("tags")), "tags", ["view", "click"])


@query("SELECT combination, count(*) AS n FROM (SELECT string_agg(DISTINCT event_type, '+' ORDER BY event_type) AS combination FROM events GROUP BY user_id, ts::DATE) GROUP BY combination")
def combo_freq(t: Tables) -> DataFrame:
    return stats.combinations(_types_by_day(t), "types")


@query("SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 10")
def most_common_sources(t: Tables) -> DataFrame:
    return stats.most_common(t.documents, "source", 10)


@query(f"WITH {_SETS}, {_COUNTS} SELECT * FROM c")
def topic_counts(t: Tables) -> DataFrame:
    return topics.counts(_types_by_day(t), "types")


@query("SELECT a.p_brand AS a, b.p_brand AS b, count(*) AS n FROM (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey) a JOIN (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey) b USING (l_orderkey) WHERE a.p_brand <> b.p_brand GROUP BY ALL")
def cooccurrence(t: Tables) -> DataFrame:
    """Brands that occur in one order."""
    sets = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("l_orderkey").agg(F.collect_set("p_brand").alias("brands"))
    return topics.cooccurrence(sets, "brands")


@query(f"WITH {_SETS}, {_COUNTS}, {_PAIRS} SELECT p.a AS topic, p.b AS ancestor FROM p JOIN c x ON p.a = x.topic JOIN c y ON p.b = y.topic WHERE p.n = x.n AND y.n > x.n")
def ancestors(t: Tables) -> DataFrame:
    return topics.ancestors(_types_by_day(t), "types")


@query(
    """WITH sets AS (SELECT o_orderkey, list_distinct(list_filter(['ALL', o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 200000 THEN 'BIG' END], lambda x: x IS NOT NULL)) AS types FROM orders),
c AS (SELECT topic, count(*) AS n FROM (SELECT unnest(types) AS topic FROM sets) GROUP BY topic),
p AS (SELECT a, b, count(*) AS n FROM (SELECT a, unnest(types) AS b FROM (SELECT types, unnest(types) AS a FROM sets)) WHERE a <> b GROUP BY a, b),
anc AS (SELECT p.a, p.b FROM p JOIN c x ON p.a = x.topic JOIN c y ON p.b = y.topic WHERE p.n = x.n AND y.n > x.n),
m AS (SELECT o_orderkey, types, unnest(types) AS topic FROM sets),
leaf AS (SELECT m.o_orderkey, m.topic, c.n FROM m JOIN c USING (topic) WHERE NOT EXISTS (SELECT 1 FROM anc WHERE anc.b = m.topic AND list_contains(m.types, anc.a))),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY n, topic) AS k FROM leaf)
SELECT o_orderkey, string_agg(topic, '>' ORDER BY k) AS top FROM r WHERE k <= 2 GROUP BY o_orderkey"""
)
def topic_labels(t: Tables) -> DataFrame:
    """Leaves of the ontology that the orders' marks make, the rarest two."""
    done = F.col("o_orderstatus") == "F"
    sets = t.orders.select("o_orderkey", F.array_compact(F.array(F.lit("ALL"), F.col("o_orderstatus"), F.when(done, F.col("o_orderpriority")), F.when(done & (F.col("o_totalprice") > 200000), "BIG"))).alias("types"))
    return topics.pruned(sets, "types").select("o_orderkey", F.array_join("top", ">").alias("top"))


@query("WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type), u AS (SELECT DISTINCT user_id, event_type FROM events), r AS (SELECT user_id, event_type, n, row_number() OVER (PARTITION BY user_id ORDER BY n, event_type)::INTEGER AS rank FROM u JOIN c USING (event_type)) SELECT * FROM r WHERE rank <= 2")
def rarest_two(t: Tables) -> DataFrame:
    return topics.rarest(t.events, ["user_id"], "event_type")


@query("SELECT doc_id, (row_number() OVER (ORDER BY lang, doc_id) - 1) // 100 AS chunk, ((row_number() OVER (ORDER BY lang, doc_id) - 1) % 100 + 1)::INT AS local FROM documents")
def chunk_batches(t: Tables) -> DataFrame:
    return fold.chunks(t.documents.select("doc_id", "lang"), ["lang", "doc_id"], 100).select("doc_id", "chunk", "local")


@query("SELECT row_number() OVER (ORDER BY p_name, p_partkey) AS id, p_partkey FROM part")
def dense_numbers(t: Tables) -> DataFrame:
    return dense_ids(t.part.select("p_name", "p_partkey"), ["p_name", "p_partkey"]).select("id", "p_partkey")


@query("SELECT lower(p_name) AS key, string_agg(DISTINCT CASE WHEN p_size < 25 THEN upper(p_name) ELSE p_name END, '|' ORDER BY CASE WHEN p_size < 25 THEN upper(p_name) ELSE p_name END) AS spellings FROM part GROUP BY lower(p_name)")
def spelling_sets(t: Tables) -> DataFrame:
    d = t.part.select(F.when(F.col("p_size") < 25, F.upper("p_name")).otherwise(F.col("p_name")).alias("word"))
    return fold.spellings(d).select("key", F.array_join("spellings", "|").alias("spellings"))


@query("SELECT md5(lower(text)) AS digest, count(*) AS copies FROM documents GROUP BY lower(text) HAVING count(*) > 1")
def dedupe_copies(t: Tables) -> DataFrame:
    """Texts that occur more than once, case aside."""
    return t.documents.groupBy(F.md5(F.lower("text")).alias("digest")).agg(F.count("*").alias("copies")).where("copies > 1")


@query("SELECT sign, count(*) AS n FROM (SELECT unnest(string_split(translate(text, 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789 .,' || chr(10), ''), '')) AS sign FROM documents) WHERE sign <> '' GROUP BY sign")
def residue_signs(t: Tables) -> DataFrame:
    import string

    return stats.residue(t.documents, "text", string.ascii_letters + string.digits + " .,\n")
