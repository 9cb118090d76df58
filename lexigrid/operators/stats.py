"""Counts and reports."""

from __future__ import annotations

import difflib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrid.functions.text import blank, misaligned, present


def field_stats(df: DataFrame, flags: dict[str, Column], groups: list[str] = ()) -> DataFrame:
    """total and how many rows satisfy each condition."""
    return df.groupBy(*groups).agg(F.count("*").alias("total"), *[F.count(F.when(c, 1)).alias(n) for n, c in flags.items()])


def dictionary_stats(df: DataFrame, ipa: str) -> DataFrame:
    return field_stats(df, {"lemmas": F.col("is_lemma").cast("int") == 1, "translated": present(F.col("translation")), "phonetic": present(F.col(ipa))})


def english_stats(df: DataFrame) -> DataFrame:
    some = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    return field_stats(df, {"translated": some("translation"), "phoneticUk": some("phonetic_uk"), "phoneticUs": some("phonetic_us"), "definitions": some("definition")})


def unknown_tags(df: DataFrame, tags: str, known: list[str]) -> DataFrame:
    """(tag, n) of tags in none of the bags, the most frequent first. known is a constant list, tested within the scan."""
    return df.select(F.explode(F.array_except(F.col(tags), F.array(*map(F.lit, known)))).alias("tag")).groupBy("tag").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "tag")


def combinations(df: DataFrame, tags: str) -> DataFrame:
    """(combination, n) of sets of tags, sorted and joined by +."""
    return df.groupBy(F.array_join(F.array_sort(F.array_distinct(F.col(tags))), "+").alias("combination")).agg(F.count("*").alias("n"))


def most_common(df: DataFrame, value: str, k: int) -> DataFrame:
    return df.groupBy(value).agg(F.count("*").alias("n")).orderBy(F.desc("n"), value).limit(k)


def residue(df: DataFrame, column: str, inventory: str) -> DataFrame:
    """(sign, n) of the signs beyond the inventory."""
    rest = F.translate(F.col(column), inventory, "")
    return df.select(F.explode(F.split(rest, "")).alias("sign")).where("sign <> ''").groupBy("sign").agg(F.count("*").alias("n"))


def verdicts(df: DataFrame, verdict: str, level: str) -> DataFrame:
    """(level, verdict, n, share within the level)."""
    n = df.groupBy(level, verdict).agg(F.count("*").alias("n"))
    total = n.groupBy(level).agg(F.sum("n").alias("_all"))
    return n.join(total, level).select(level, verdict, "n", (F.col("n") / F.greatest("_all", F.lit(1))).alias("share"))


def structural_audit(df: DataFrame, lists: list[str], meta: str, ipa: str) -> DataFrame:
    """Counters of what a finished table must not have, in one pass."""
    lemma = F.coalesce(F.col("is_lemma").cast("int") == 1, F.lit(False))
    return field_stats(
        df,
        {
            "no_word": blank(F.col("word")),
            "no_key": blank(F.col("word_norm")),
            "lemma_no_translation": lemma & blank(F.col("translation")),
            "form_no_base": ~lemma & blank(F.col("exchange")),
            "misaligned": misaligned(*[F.col(c) for c in lists]),
            "bad_meta": present(F.col(meta)) & F.from_json(F.col(meta), "array<string>").isNull(),
            "no_ipa": blank(F.col(ipa)),
            "flagged": present(F.col("flag")),
            "self_base": F.col("exchange") == F.concat(F.lit("0:"), F.col("word")),
        },
    )


def added_and_dropped(before: Column, after: Column) -> Column:
    """(added, dropped): signs as often as one has more of them than the other, in sorted order."""

    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        from collections import Counter

        out = []
        for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True):
            x, y = Counter(x or ""), Counter(y or "")
            out.append({"added": "".join(sorted((y - x).elements())), "dropped": "".join(sorted((x - y).elements()))})
        return pa.array(out, pa.struct([("added", pa.string()), ("dropped", pa.string())]))

    return F.arrow_udf(run, T.StructType([T.StructField("added", T.StringType()), T.StructField("dropped", T.StringType())]))(before, after)


def difference_pairs(df: DataFrame, before: str, after: str) -> DataFrame:
    """(old, new, n) of the stretches in which two values differ, the most frequent first."""

    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True):
            x, y = x or "", y or ""
            out.append([{"old": x[i:j], "new": y[k:m]} for op, i, j, k, m in difflib.SequenceMatcher(None, x, y, autojunk=False).get_opcodes() if op != "equal"])
        return pa.array(out, pa.list_(pa.struct([("old", pa.string()), ("new", pa.string())])))

    kind = T.ArrayType(T.StructType([T.StructField("old", T.StringType()), T.StructField("new", T.StringType())]))
    distinct = df.where(F.col(before) != F.col(after)).groupBy(F.col(before).alias("b"), F.col(after).alias("a")).agg(F.count("*").alias("n"))  # each pair is compared once
    pairs = distinct.select("n", F.explode(F.arrow_udf(run, kind)(F.col("b"), F.col("a"))).alias("p"))
    return pairs.groupBy("p.old", "p.new").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "old", "new")


def cost(tokens_in: Column, tokens_out: Column, at: Column, price_in: float, price_out: float, peak: tuple[int, int] = (9, 18)) -> Column:
    """Price per million tokens, doubled in the peak hours."""
    hour = F.hour(at)
    return (tokens_in * price_in + tokens_out * price_out) / 1e6 * F.when((hour >= peak[0]) & (hour < peak[1]), 2).otherwise(1)
