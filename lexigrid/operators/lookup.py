"""Look-ups: exact, by prefix, and the bases of a form; each also for many keys at once, as a join.

Where an order has nulls, they come last, as in SQL: a row may be found by its key and have no word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.functions.text import LOWER, UPPER, ascii_fold, base_forms, key_range, like_prefix


def best_first(lemma: str | None = "is_lemma", tie: str = "id") -> list[Column]:
    """Lemmas first, then the smallest id."""
    return ([F.col(lemma).desc_nulls_last()] if lemma else []) + [F.col(tie).asc_nulls_last()]


def folded(typed: str) -> str:
    return typed.translate(str.maketrans(UPPER, LOWER))


def exact(df: DataFrame, typed: str, word: str = "word", order: list[Column] | None = None, sorted_by: str | None = None) -> DataFrame:
    """The best row whose word is what was typed, letters of ASCII folded; none for blanks.

    sorted_by: a column with the folded word by which the table is clustered; the scan then reads the row groups that may have it.
    """
    typed = typed.strip()
    if not typed:
        return df.limit(0)
    own = F.col(sorted_by) if sorted_by else ascii_fold(F.col(word))
    return df.where(own == folded(typed)).orderBy(*(order or best_first())).limit(1)


def exact_many(df: DataFrame, keys: DataFrame, key: str, word: str = "word", lemma: str | None = "is_lemma", tie: str = "id") -> DataFrame:
    """For each key its best row: a join on the folded word, and an aggregate instead of a sort."""
    wanted = keys.select(F.col(key).alias("_key"), ascii_fold(F.trim(key)).alias("_folded")).where("_folded <> ''").distinct()
    hits = wanted.join(df.withColumn("_folded", ascii_fold(F.col(word))), "_folded")
    rank = F.struct(*([(-F.coalesce(F.col(lemma).cast("int"), F.lit(-1))).alias("l")] if lemma else []), F.col(tie).alias("t"))
    best = hits.groupBy("_key").agg(F.min_by(F.struct(*df.columns), rank).alias("_best"))
    return best.select(F.col("_key").alias(key) if key not in df.columns else F.col("_key").alias(f"asked_{key}"), "_best.*")


def by_length(word: str = "word") -> list[Column]:
    """The shortest word, then its text; rows without one last."""
    return [F.length(word).asc_nulls_last(), F.col(word).asc_nulls_last()]


def by_frequency(typed: str, word: str = "word", frequency: str = "frq") -> list[Column]:
    """The exact word, then rising rank in frequency (unknown last), length, word."""
    return [F.when(ascii_fold(F.col(word)) == ascii_fold(F.lit(typed)), 0).otherwise(1), F.col(frequency).asc_nulls_last(), *by_length(word)]


def by_lemma(typed: str, word: str = "word", lemma: str = "is_lemma") -> list[Column]:
    """The exact word, then lemmas, length, word."""
    return [F.when(ascii_fold(F.col(word)) == ascii_fold(F.lit(typed)), 0).otherwise(1), F.col(lemma).desc_nulls_last(), *by_length(word)]


def clamp(limit: object, default: int = 20, most: int = 50) -> int:
    """A limit from 1 to most; default for what is no number."""
    try:
        number = int(float(limit))
    except (TypeError, ValueError, OverflowError):
        return default
    return max(1, min(most, number))


def search(df: DataFrame, typed: str, limit: int = 20, word: str = "word", key: str | None = "word_norm", order: list[Column] | None = None, tie: str = "id", sorted_by: str | None = None) -> DataFrame:
    """The first rows, in order, whose word or search key begins with what was typed; % and _ are live. None for blanks.

    sorted_by: as in `exact`; key must be lower case then. The ranges of both columns that a prefix allows reach the scan. Sorted with a limit this is a top-k: each partition keeps no more than limit rows, and there is no shuffle of the table.
    """
    typed = typed.strip()
    if not typed:
        return df.limit(0)
    hit = like_prefix(F.col(word), typed)
    near = key_range(F.col(sorted_by), folded(typed)) if sorted_by else None
    if key:
        hit = hit | like_prefix(F.col(key), typed)
        near = near | key_range(F.col(key), folded(typed)) if near is not None else None
    if near is not None:
        df = df.where(near)  # a condition of its own, of comparisons alone: what a scan can take
    return df.where(hit).orderBy(*(order or by_lemma(typed, word)), F.col(tie).asc_nulls_last()).limit(limit)


def contains_not_prefix(df: DataFrame, typed: str, limit: int = 20, word: str = "word", frequency: str = "frq", tie: str = "id") -> DataFrame:
    """Rows that contain what was typed elsewhere than at the beginning."""
    folded = ascii_fold(F.lit(typed))
    c = ascii_fold(F.col(word))
    return df.where(F.contains(c, folded) & ~F.startswith(c, folded)).orderBy(F.col(frequency).asc_nulls_last(), *by_length(word), F.col(tie).asc_nulls_last()).limit(limit)


def search_many(df: DataFrame, queries: DataFrame, typed: str, limit: int, order: list[Column], word: str = "word") -> DataFrame:
    """The first rows for each of many prefixes without wildcards.

    Words are cut at the lengths that the prefixes have, and meet them whole: an equi-join in which a word meets just what it begins with.
    """
    q = queries.select(F.col(typed).alias("_typed"), ascii_fold(F.trim(typed)).alias("_p")).where("_p <> ''").distinct()
    lengths = sorted(r[0] for r in q.select(F.length("_p")).distinct().collect())  # a row for each length
    cuts = F.transform(F.filter(F.array(*map(F.lit, lengths)) if lengths else F.array().cast("array<int>"), lambda n: n <= F.length(word)), lambda n: F.substring(ascii_fold(F.col(word)), F.lit(1), n))
    hits = q.join(df.withColumn("_p", F.explode(cuts)), "_p")
    # of each prefix the best rows of each slice of words first, so that a short prefix is no single task
    sliced = hits.withColumn("_slice", F.pmod(F.xxhash64(*df.columns), F.lit(64)))
    first = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("_typed", "_slice").orderBy(*order))).where(F.col("rank") <= limit)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("_typed").orderBy(*order)))
    return ranked.where(F.col("rank") <= limit).select(F.col("_typed").alias(typed), "rank", *df.columns)


def bases(df: DataFrame, entries: DataFrame, word: str = "word", exchange: str = "exchange", tie: str = "id", columns: list[str] = ("word", "pos")) -> DataFrame:
    """entries with `bases`: what df has of each form's bases, in their order, one level deep; the word itself and unknown bases are left out."""
    edges = entries.select(F.col(tie).alias("_of"), F.col(word).alias("_self"), F.posexplode(base_forms(F.col(exchange))).alias("_i", "_base")).where("_base <> _self")
    targets = df.select(ascii_fold(F.col(word)).alias("_k"), F.col(tie).alias("_t"), F.coalesce(F.col("is_lemma").cast("int"), F.lit(0)).alias("_l") if "is_lemma" in df.columns else F.lit(0).alias("_l"), F.struct(*columns).alias("_b"))
    found = edges.join(targets, ascii_fold(F.col("_base")) == F.col("_k"))
    best = found.groupBy("_of", "_i").agg(F.min_by("_b", F.struct(-F.col("_l"), "_t")).alias("_b"))
    lists = best.groupBy("_of").agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_b"))), lambda x: x["_b"]).alias("bases"))
    joined = entries.join(lists, F.col(tie) == F.col("_of"), "left").drop("_of")
    kind = joined.schema["bases"].dataType.simpleString()
    return joined.withColumn("bases", F.coalesce("bases", F.array().cast(kind)))
