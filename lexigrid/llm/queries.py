"""The queries of this subpackage, with production parameters, and the SQL that DuckDB can run for them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexigrid.llm import bpe, embedding_dedup, line_dedup, packing, quality_rules, secret_scan, simhash_dedup, substring_dedup, toxicity, url_filter
from lexigrid.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

#: The vocabulary of operator 9: a file of ranks, which every driver that runs the query must have.
VOCABULARY = os.environ.get("LEXIGRID_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.run_dedup(table(spark, sf_dir, "documents"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_classes(table(spark, sf_dir, "embeddings"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_intervals(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.removed_pairs(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_matches(table(spark, sf_dir, "pages"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), VOCABULARY)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_filter(table(spark, sf_dir, "documents")).select("doc_id", "lang", "source", "n_chars")


QUALITY_SQL = "SELECT doc_id, lang, source, n_chars FROM documents WHERE text IS NOT NULL" + "".join(f" AND NOT ({r.sql.replace('{t}', 'text')})" for r in quality_rules.RULES)


SUBSTRING_SQL = r"""
WITH texts AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w FROM documents),
places AS (SELECT doc_id, unnest(range(1, len(w) - {n} + 2)) AS i, w FROM texts WHERE len(w) >= {n}),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + {n} - 1], ' ') AS g FROM places),
repeated AS (SELECT doc_id, i, doc_id = d AND i = p AS first FROM windows JOIN (SELECT g, min((doc_id, i)) AS m, m[1] AS d, m[2] AS p FROM windows GROUP BY g HAVING count(*) > 1) USING (g)),
tokens AS (SELECT doc_id, t, bool_or(first) AS kept FROM (SELECT doc_id, first, unnest(range(i - 1, i - 1 + {n})) AS t FROM repeated) GROUP BY doc_id, t),
steps AS (SELECT doc_id, t, kept, t - row_number() OVER (PARTITION BY doc_id, kept ORDER BY t) AS run FROM tokens)
SELECT doc_id, min(t) AS start_token, max(t) + 1 AS end_token, kept FROM steps GROUP BY doc_id, kept, run
""".replace("{n}", str(substring_dedup.WINDOW))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


SECRETS_SQL = " UNION ALL ".join(
    f"SELECT doc_id, {_quoted(r.name)} AS rule, i::INTEGER AS match_no, length(m[i])::INTEGER AS n_chars, md5(m[i]) AS digest FROM (SELECT doc_id, m, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(text, {_quoted(r.pattern)}) AS m FROM documents))" for r in secret_scan.RULES
)

URL_SQL = "SELECT page_id, url, rule FROM pages, (VALUES " + ", ".join(f"({_quoted(r.name)}, {_quoted(r.pattern)})" for r in url_filter.RULES) + ") AS rules (rule, pattern) WHERE regexp_matches(lower(url), pattern)"


EMBEDDING_SQL = f"""
WITH RECURSIVE links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= {embedding_dedup.THRESHOLD}
),
reached (a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
classes AS (SELECT a, min(b) AS class_id FROM reached GROUP BY a)
SELECT c.a AS vec_id, c.class_id, (SELECT count(*) FROM links l WHERE l.a = c.a) AS n_links FROM classes c
"""


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in (op1_line_dedup, op2_embedding_dedup, op3_secret_scan, op4_substring_dedup, op5_packing, op6_simhash_dedup, op7_url_filter, op8_toxicity, op9_bpe, op10_quality_rules)}


def oracle_sql() -> dict[str, str]:
    return {"op2_embedding_dedup": EMBEDDING_SQL, "op3_secret_scan": SECRETS_SQL, "op7_url_filter": URL_SQL, "op4_substring_dedup": SUBSTRING_SQL, "op10_quality_rules": QUALITY_SQL}
