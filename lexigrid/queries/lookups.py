"""Look-ups, lines and JSON."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.functions import text
from lexigrid.operators import lookup
from lexigrid.queries.registry import Tables, fold, query, trimmed_lines


@query("SELECT p_partkey, p_name, p_size FROM part WHERE starts_with(p_name, 'red') ORDER BY CASE WHEN p_name = 'red ring' THEN 0 ELSE 1 END, p_size ASC NULLS LAST, length(p_name), p_name, p_partkey LIMIT 20")
def prefix_search_name(t: Tables) -> DataFrame:
    """The first 20 of a prefix search, ranked: the exact word, frequency, length, word."""
    order = lookup.by_frequency("Red Ring", "p_name", "p_size")
    return lookup.search(t.part, "RED", 20, "p_name", None, order, "p_partkey").select("p_partkey", "p_name", "p_size")


@query(
    f"""WITH d AS (SELECT doc_id, source, {trimmed_lines('text')}[1] AS head FROM documents)
SELECT doc_id, source, head FROM d WHERE starts_with({fold('head')}, 'src1') OR starts_with({fold('source')}, 'src1') ORDER BY length(head), head, doc_id LIMIT 50"""
)
def prefix_or_key(t: Tables) -> DataFrame:
    """A prefix of the first line or of the source; the first 50."""
    d = t.documents.select("doc_id", "source", text.first_line(F.col("text")).alias("head"))
    return lookup.search(d, "SRC1", 50, "head", "source", lookup.by_length("head"), "doc_id")


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%_d r%' ESCAPE '!' AND starts_with(substr(p_name, 3), 'd r') ORDER BY p_name, p_partkey LIMIT 30")
def prefix_with_wildcard(t: Tables) -> DataFrame:
    """What is typed may hold live wildcards: `__d r` finds `red ring` and the like."""
    return lookup.search(t.part, "__d r", 30, "p_name", None, [F.col("p_name")], "p_partkey").select("p_partkey", "p_name")


@query(f"SELECT k AS asked_key, p_partkey, p_name, p_size FROM (SELECT upper(p_name) AS k, p_partkey, p_name, p_size, row_number() OVER (PARTITION BY {fold('p_name')} ORDER BY p_size DESC, p_partkey) AS r FROM part) WHERE r = 1")
def exact_lookup_many(t: Tables) -> DataFrame:
    """For each name, in another case, its best row."""
    keys = t.part.select(F.upper("p_name").alias("asked_key")).distinct()
    return lookup.exact_many(t.part.select("p_partkey", "p_name", "p_size"), keys, "asked_key", "p_name", "p_size", "p_partkey")


@query("SELECT c_custkey, c_name FROM customer WHERE lower(c_name) = 'customer#000000007' ORDER BY c_custkey LIMIT 1")
def exact_lookup_one(t: Tables) -> DataFrame:
    """One word in another case."""
    return lookup.exact(t.customer, " CUSTOMER#000000007 ", "c_name", [F.col("c_custkey")]).select("c_custkey", "c_name")


@query("SELECT p, rank, p_partkey, p_name FROM (SELECT p, p_partkey, p_name, row_number() OVER (PARTITION BY p ORDER BY p_size, p_name, p_partkey)::INTEGER AS rank FROM part JOIN (SELECT DISTINCT substr(p_name, 1, 3) AS p FROM part) ON starts_with(p_name, p)) WHERE rank <= 3")
def prefix_search_many(t: Tables) -> DataFrame:
    """The first three for each of many prefixes."""
    prefixes = t.part.select(F.substring("p_name", 1, 3).alias("p")).distinct()
    return lookup.search_many(t.part, prefixes, "p", 3, [F.col("p_size").asc_nulls_last(), F.col("p_name"), F.col("p_partkey")], "p_name").select("p", "rank", "p_partkey", "p_name")


@query("SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring') AND NOT starts_with(p_name, 'ring') ORDER BY p_size, length(p_name), p_name, p_partkey LIMIT 25")
def contains_search(t: Tables) -> DataFrame:
    return lookup.contains_not_prefix(t.part, "Ring", 25, "p_name", "p_size", "p_partkey").select("p_partkey", "p_name")


@query("SELECT n_nationkey + 100 AS id, n_name AS word, r_name AS bases FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT r_regionkey, r_name, '' FROM region")
def base_join_one_level(t: Tables) -> DataFrame:
    """A word's bases as entries of their own: nations point to their region, to themselves and to nothing known."""
    regions = t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("word"), F.lit(None).cast("string").alias("exchange"))
    pointing = F.concat(F.lit("0:"), F.lower("r_name"), F.lit("\n0:"), "n_name", F.lit("\n0:nowhere\n0:"), F.lower("r_name"))
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select((F.col("n_nationkey") + 100).alias("id"), F.col("n_name").alias("word"), pointing.alias("exchange"))
    d = regions.unionByName(nations)
    return lookup.bases(d, d, columns=["word"]).select("id", "word", F.array_join(F.transform("bases", lambda b: b["word"]), ",").alias("bases"))


@query(f"SELECT conv_id, turn, {trimmed_lines('text')}[1] AS brief FROM conversations")
def brief_first_line(t: Tables) -> DataFrame:
    return t.conversations.select("conv_id", "turn", text.first_line(F.col("text")).alias("brief"))


@query(f"SELECT doc_id, i::INTEGER AS n, l[i] AS line FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, {trimmed_lines('text')} AS l FROM documents))")
def sense_split(t: Tables) -> DataFrame:
    """Lines numbered, blank ones left out."""
    return t.documents.select("doc_id", F.posexplode(text.lines(F.col("text"))).alias("n", "line")).withColumn("n", F.col("n") + 1)


@query("SELECT event_type, count(*) AS n, count(k) AS parsed, sum(k)::BIGINT AS total FROM (SELECT event_type, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events) GROUP BY event_type")
def json_props(t: Tables) -> DataFrame:
    """JSON of which some is cut short: what can't be parsed is null, not an error."""
    broken = F.when(F.col("event_type") == "error", F.substring("props", 1, 3)).otherwise(F.col("props"))
    k = F.from_json(broken, "k long")["k"]
    return t.events.groupBy("event_type").agg(F.count("*").alias("n"), F.count(k).alias("parsed"), F.sum(k).alias("total"))


@query("SELECT doc_id, lower(strip_accents(text)) AS search_key FROM documents")
def search_keys(t: Tables) -> DataFrame:
    """Whole texts without accents."""
    return t.documents.select("doc_id", text.unaccent(F.col("text")).alias("search_key"))


@query("SELECT p_partkey, p_name AS phrase, p_type AS zh FROM part")
def collocations(t: Tables) -> DataFrame:
    """A phrase and its translation told apart where Han begins."""
    x = text.collocation(F.concat("p_name", F.lit(" 甲"), "p_type"))
    return t.part.select("p_partkey", x["text"].alias("phrase"), F.substring(x["zh"], F.lit(2), F.length(x["zh"])).alias("zh"))


@query("SELECT c_custkey, nullif(concat_ws('/', CASE WHEN c_acctbal >= 0 THEN 's:' || c_mktsegment END, 'n:' || c_name), '') AS exchange, c_name AS found FROM customer")
def exchange_notation(t: Tables) -> DataFrame:
    """The notation of forms, made and read again; pairs without a word are left out."""
    pairs = F.array(F.struct(F.lit("s").alias("code"), F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("word")), F.struct(F.lit("n").alias("code"), F.col("c_name").alias("word")))
    made = t.customer.select("c_custkey", text.exchange_of(pairs).alias("exchange"))
    found = F.filter(text.exchange_map(F.col("exchange")), lambda x: x["code"] == "n")
    return made.select("c_custkey", "exchange", F.element_at(found, 1)["word"].alias("found"))
