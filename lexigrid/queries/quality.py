"""Classification, samples, measures, and the admission limiter."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.operators import classify, govern, sampling
from lexigrid.queries.registry import Tables, query
from lexigrid.streaming import limiter

_SHAPES = {0: "[网络] 大环", 1: "[网络] 大环\n小环", 2: "[人名] 约翰", 3: "abbr. 缩写", 4: "[医] 环", 5: "n. ring的复数形式", 6: "n. 环", 7: "n. 环"}


@query(
    """SELECT p_partkey, CASE k WHEN 0 THEN 'B1' WHEN 1 THEN 'B2' WHEN 2 THEN 'C2' WHEN 3 THEN 'C3' WHEN 4 THEN 'C4' WHEN 5 THEN 'A1' WHEN 6 THEN 'C6' ELSE CASE WHEN p_type = 'SMALL' THEN 'C1' ELSE 'C3' END END AS bucket
FROM (SELECT p_partkey, p_type, p_size % 8 AS k FROM part)"""
)
def tail_buckets(t: Tables) -> DataFrame:
    """The nine classes of rows outside the core, over texts of each shape."""
    k = F.col("p_size") % 8
    body = F.element_at(F.create_map(*[F.lit(x) for p in _SHAPES.items() for x in p]), k)
    word = F.when((k == 7) & (F.col("p_type") == "SMALL"), F.initcap(F.substring_index("p_name", " ", 1))).otherwise(F.when(k == 7, F.upper(F.substring_index("p_name", " ", 1))).otherwise(F.col("p_name")))
    word = F.when((k == 7) & (F.col("p_type") == "SMALL"), F.concat(word, F.lit(" "), F.substring_index("p_name", " ", -1))).otherwise(word)
    return t.part.select("p_partkey", classify.tail_bucket(word, body).alias("bucket"))


@query(
    """SELECT count(*) AS total, count(*) FILTER (long) AS long, count(*) FILTER (NOT long AND lines) AS lines, count(*) FILTER (NOT long AND NOT lines) AS rest, count(*) AS covered, 0::BIGINT AS overlapping
FROM (SELECT n_chars > 2000 AS long, contains(text, chr(10)) AS lines FROM documents)"""
)
def bucket_partition(t: Tables) -> DataFrame:
    """An ordered case is exhaustive and exclusive."""
    long, lines = F.col("n_chars") > 2000, F.contains("text", F.lit("\n"))
    return govern.partition_check(t.documents, {"long": long, "lines": ~long & lines, "rest": ~long & ~lines})


@query("SELECT doc_id, lang FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 100")
def seeded_sample(t: Tables) -> DataFrame:
    return sampling.sample(t.documents.select("doc_id", "lang"), 100, "doc_id", 7)


@query(
    """WITH s AS (SELECT doc_id, CASE WHEN n_chars > 5000 THEN 'long' WHEN lang <> 'en' THEN 'foreign' WHEN contains(text, chr(10)) THEN 'lines' END AS stratum FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5('3:' || doc_id), doc_id) AS k FROM s WHERE stratum IS NOT NULL)
SELECT doc_id, stratum FROM r WHERE k <= CASE stratum WHEN 'long' THEN 10 WHEN 'foreign' THEN 25 ELSE 40 END"""
)
def stratified_sample(t: Tables) -> DataFrame:
    """Quotas by stratum; a row belongs to the first stratum that it satisfies."""
    strata = {"long": F.col("n_chars") > 5000, "foreign": F.col("lang") != "en", "lines": F.contains("text", F.lit("\n"))}
    return sampling.stratified(t.documents, strata, {"long": 10, "foreign": 25, "lines": 40}, "doc_id", 3).select("doc_id", "stratum")


@query("WITH q AS (SELECT lang, greatest(1, count(*) * 50 // (SELECT count(*) FROM documents)) AS quota FROM documents GROUP BY lang), r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('0:' || doc_id), doc_id) AS k FROM documents) SELECT doc_id, lang FROM r JOIN q USING (lang) WHERE k <= quota")
def proportional_sample(t: Tables) -> DataFrame:
    return sampling.proportional(t.documents.select("doc_id", "lang"), "lang", 50, "doc_id")


@query("SELECT doc_id, false AS repeat FROM documents UNION ALL SELECT doc_id, true FROM documents WHERE substr(md5('1:' || doc_id), 1, 8) < '0ccccccc'")
def repeated_sample(t: Tables) -> DataFrame:
    """A share of rows twice, to measure a judge's own noise."""
    return sampling.with_repeats(t.documents.select("doc_id"), 0.05, "doc_id")


@query(
    """SELECT lang, tp, fp, fn, tn, tp / greatest(tp + fp, 1) AS precision, tp / greatest(tp + fn, 1) AS recall FROM (SELECT lang, count(*) FILTER (toxic = 1 AND quality = 0) AS tp, count(*) FILTER (toxic = 0 AND quality = 0) AS fp,
count(*) FILTER (toxic = 1 AND quality = 1) AS fn, count(*) FILTER (toxic = 0 AND quality = 1) AS tn FROM labels JOIN documents USING (doc_id) GROUP BY lang)"""
)
def precision_recall(t: Tables) -> DataFrame:
    """How well bad quality predicts toxicity, by language."""
    j = t.labels.join(t.documents.select("doc_id", "lang"), "doc_id")
    return sampling.precision_recall(j, F.col("toxic"), F.col("quality") == 0, ["lang"])


@query("SELECT count(*) FILTER (c_mktsegment = 'FURNITURE') AS fixed, count(*) FILTER (c_mktsegment = 'BUILDING') AS broke, count(*) FILTER (c_mktsegment = 'MACHINERY') AS neutral, count(*) FILTER (c_mktsegment NOT IN ('FURNITURE', 'BUILDING', 'MACHINERY')) AS unchanged FROM customer")
def regression(t: Tables) -> DataFrame:
    """A change against an authority: what it mended, what it broke."""
    s = F.col("c_mktsegment")
    after = F.when(s.isin("FURNITURE", "MACHINERY", "BUILDING"), F.concat(s, F.lit("*"))).otherwise(s)
    truth = F.when(s == "FURNITURE", "FURNITURE*").when(s == "MACHINERY", "other").otherwise(s)
    return sampling.regression(t.customer.select(s.alias("b"), after.alias("a"), truth.alias("t")), "b", "a", "t")


_GATE = """WITH RECURSIVE e AS (SELECT {client} AS client, event_id, epoch_us(ts) // 1000 AS ms FROM {source}),
w(client, start) AS (SELECT client, min(ms) FROM e GROUP BY client UNION ALL SELECT w.client, (SELECT min(ms) FROM e WHERE e.client = w.client AND e.ms >= w.start + {window}) FROM w WHERE w.start IS NOT NULL),
h AS (SELECT e.client, e.event_id, e.ms, row_number() OVER (PARTITION BY e.client, v.start ORDER BY e.ms, e.event_id) AS hits FROM e JOIN (SELECT client, start, lead(start, 1, 9223372036854775807) OVER (PARTITION BY client ORDER BY start) AS next FROM w WHERE start IS NOT NULL) v ON e.client = v.client AND e.ms >= v.start AND e.ms < v.next)"""


@query(_GATE.format(client="CAST(user_id AS VARCHAR)", source="events", window=86_400_000) + ' SELECT client, event_id AS "order", ms, hits, hits > 4 AS limited FROM h')
def rate_limit_anchored(t: Tables) -> DataFrame:
    """Four requests a day, where a user's day begins with the first request after the last day's end."""
    return limiter.per_client(t.events, "user_id", "ts", "event_id", 86_400_000, 4)


@query(_GATE.format(client="'all'", source="events", window=3_600_000) + ' SELECT event_id AS "order" FROM h WHERE hits > 12')
def rate_limit_global(t: Tables) -> DataFrame:
    """The requests beyond twelve an hour, all users together."""
    return limiter.global_rejections(t.events, "ts", "event_id", 3_600_000, 12)


@query('SELECT client, start, hits, hits > 3 AS limited FROM (SELECT CAST(user_id AS VARCHAR) AS client, date_trunc(\'day\', ts) AS start, count(*) AS hits FROM events GROUP BY ALL)')
def rate_limit_tumbling(t: Tables) -> DataFrame:
    return limiter.tumbling(t.events, "user_id", "ts", "1 day", 3)


@query()
def rate_limit_admitted(t: Tables) -> DataFrame:
    """Both gates: 503, 429 or 200 for each request."""
    return limiter.admitted(t.events, "user_id", "ts", "event_id", 86_400_000, 4, 300)
