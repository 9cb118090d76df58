"""Spelling to sound, differences and labels, over the tables' words."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.functions import g2p, text
from lexigrid.operators import stats
from lexigrid.queries.registry import Tables, query


@query()
def spelt_words(t: Tables) -> DataFrame:
    """(lang, word, sound): every word of the Spanish and German documents, spelt to sound."""
    d = t.documents.where(F.col("lang").isin("es", "de")).select("lang", F.explode(F.regexp_extract_all("text", F.lit("[A-Za-zÀ-ÖØ-öø-ÿ]+"), F.lit(0))).alias("word")).distinct()
    return d.select("lang", "word", F.when(F.col("lang") == "es", g2p.to_ipa(F.when(F.col("lang") == "es", F.col("word")), "es")).otherwise(g2p.to_ipa(F.when(F.col("lang") == "de", F.col("word")), "de")).alias("sound"))


@query("SELECT substr(p_name, 1, 1) AS old, 'Z' AS new, count(*) AS n FROM part WHERE p_size % 2 = 0 GROUP BY 1 UNION ALL SELECT '', 'ZZ', count(*) FROM part WHERE p_size % 2 = 1")
def difference_pairs(t: Tables) -> DataFrame:
    """The stretches in which two values differ, counted."""
    after = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Z"), F.substring("p_name", 2, 100))).otherwise(F.concat("p_name", F.lit("ZZ")))
    return stats.difference_pairs(t.part.select(F.col("p_name").alias("b"), after.alias("a")), "b", "a")


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN '' ELSE 'yzz' END AS added, CASE WHEN p_size % 2 = 0 THEN substr(p_name, 1, 1) ELSE '' END AS dropped FROM part")
def sign_bags(t: Tables) -> DataFrame:
    """Which signs were added and dropped, as bags."""
    after = F.when(F.col("p_size") % 2 == 0, F.substring("p_name", 2, 100)).otherwise(F.concat(F.lit("z"), "p_name", F.lit("yz")))
    x = stats.added_and_dropped(F.col("p_name"), after)
    return t.part.select("p_partkey", x["added"].alias("added"), x["dropped"].alias("dropped"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'vt.' END AS pos, CASE WHEN p_size % 2 = 0 THEN p_name ELSE p_name || ' n. x' END AS label_text FROM part")
def labelled_lines(t: Tables) -> DataFrame:
    """Lines with a part of speech before them, and without."""
    x = text.labelled_line(F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("vt. "), "p_name")).otherwise(F.concat("p_name", F.lit(" n. x"))))
    return t.part.select("p_partkey", x["pos"].alias("pos"), x["text"].alias("label_text"))
