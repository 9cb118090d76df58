"""A topic ontology from co-occurrence: what always comes with a rarer topic is its ancestor; labels are leaves, the rarest first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exploded(df: DataFrame, key: list[str], topics: str) -> DataFrame:
    """(key, topic), each topic of a set once."""
    return df.select(*key, F.explode(F.array_distinct(F.col(topics))).alias("topic"))


def counts(df: DataFrame, topics: str) -> DataFrame:
    return df.select(F.explode(F.array_distinct(F.col(topics))).alias("topic")).groupBy("topic").agg(F.count("*").alias("n"))


def cooccurrence(df: DataFrame, topics: str) -> DataFrame:
    """(a, b, n) of ordered pairs of different topics in one set. Pairs are made within a row, so no join; the aggregate combines early."""
    own = F.array_distinct(F.col(topics))
    pairs = F.flatten(F.transform(own, lambda a: F.transform(F.filter(own, lambda b: b != a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return df.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("n"))


def ancestors(df: DataFrame, topics: str) -> DataFrame:
    """(topic, ancestor): each set with topic has ancestor, which occurs more often."""
    n = counts(df, topics)
    pairs = cooccurrence(df, topics)
    child = n.select(F.col("topic").alias("a"), F.col("n").alias("na"))
    parent = n.select(F.col("topic").alias("b"), F.col("n").alias("nb"))
    return pairs.join(child, "a").where("n = na").join(parent, "b").where("nb > na").select(F.col("a").alias("topic"), F.col("b").alias("ancestor"))


def pruned(df: DataFrame, topics: str, most: int = 2) -> DataFrame:
    """df with `top`: of each set the topics that are no ancestor of another in it (all, if none is left), the rarest first, `most` of them.

    Ancestors and counts are tables of one row for each topic or pair: they are joined, not collected.
    """
    anc = ancestors(df, topics).groupBy("topic").agg(F.collect_set("ancestor").alias("over"))
    facts = counts(df, topics).join(anc, "topic", "left")
    sets = df.select(F.array_sort(F.array_distinct(F.col(topics))).alias("_set")).where(F.size("_set") > 0).distinct()
    parts = sets.select("_set", F.explode("_set").alias("topic")).join(facts, "topic")
    grouped = parts.groupBy("_set").agg(F.array_sort(F.collect_list(F.struct("n", "topic"))).alias("all"), F.flatten(F.collect_list(F.coalesce("over", F.array().cast("array<string>")))).alias("over"))
    leaves = F.filter("all", lambda x: ~F.array_contains(F.col("over"), x["topic"]))
    top = F.slice(F.transform(F.when(F.size(leaves) > 0, leaves).otherwise(F.col("all")), lambda x: x["topic"]), 1, most)
    labelled = grouped.select("_set", top.alias("top"))
    joined = df.withColumn("_set", F.array_sort(F.array_distinct(F.col(topics)))).join(labelled, "_set", "left").drop("_set")
    return joined.withColumn("top", F.coalesce("top", F.array().cast("array<string>")))


def rarest(df: DataFrame, key: list[str], value: str, most: int = 2) -> DataFrame:
    """(key, value, n, rank): of each key the values that are rarest in the whole table."""
    n = df.groupBy(value).agg(F.count("*").alias("n"))
    own = df.select(*key, value).distinct().join(n, value)
    best = own.groupBy(*key).agg(F.slice(F.array_sort(F.collect_set(F.struct("n", value))), 1, most).alias("l"))
    return best.select(*key, F.posexplode("l").alias("i", "x")).select(*key, F.col(f"x.{value}").alias(value), F.col("x.n").alias("n"), (F.col("i") + 1).alias("rank"))


def into_meta(meta: Column, tops: Column) -> Column:
    """Sense notes with their topics, by position; unchanged if there aren't as many."""
    return F.when(F.size(meta) == F.size(tops), F.zip_with(meta, tops, lambda m, t: m.withField("top", t))).otherwise(meta)
