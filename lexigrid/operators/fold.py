"""Folds of many records into one row for each key, whatever the partitions: the order is a column, never the order of arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_value(value: Column, order: Column) -> Column:
    """The first value that isn't null. (min_by alone may give a null of an earlier record.)"""
    return F.min_by(value, F.when(value.isNotNull(), order))


def last_value(value: Column, order: Column) -> Column:
    return F.max_by(value, F.when(value.isNotNull(), order))


def ordered_list(value: Column, order: Column) -> Column:
    """All values that aren't null, in order."""
    return F.transform(F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v"))))), lambda x: x["v"])


def ordered_distinct(value: Column, order: Column) -> Column:
    """Each value once, at its first place."""
    return F.array_distinct(ordered_list(value, order))


def joined_set(value: Column, by: str = "/") -> Column:
    """The distinct values, sorted, as one text; null if there is none."""
    return F.nullif(F.array_join(F.array_sort(F.collect_set(value)), by), F.lit(""))


def any_true(flag: Column) -> Column:
    return F.coalesce(F.bool_or(flag), F.lit(False))


def gender(value: Column, both: str = "mf") -> Column:
    """m and f of any record make both."""
    m, f = any_true(value.isin("m", both)), any_true(value.isin("f", both))
    return F.when(m & f, both).when(m, "m").when(f, "f").otherwise(F.max(value))


def transitivity(value: Column) -> Column:
    t, i = any_true(F.contains(value, F.lit("t"))), any_true(F.contains(value, F.lit("i")))
    return F.when(t & i, "ti").when(t, "t").when(i, "i")


def fold(df: DataFrame, key: Column, order: str, columns: dict[str, str]) -> DataFrame:
    """One row for each key. columns: name to how: first, last, list, distinct, set, any, gender, transitivity."""
    how = {
        "first": lambda c: first_value(c, F.col(order)),
        "last": lambda c: last_value(c, F.col(order)),
        "list": lambda c: ordered_list(c, F.col(order)),
        "distinct": lambda c: ordered_distinct(c, F.col(order)),
        "set": joined_set,
        "any": any_true,
        "gender": gender,
        "transitivity": transitivity,
    }
    return df.groupBy(key.alias("key")).agg(F.min(order).alias("first_seq"), *[how[h](F.col(c)).alias(c) for c, h in columns.items()])


def paradigms(df: DataFrame, key: str, gender: str, fields: list[str], order: str, genders: str = "mfn") -> DataFrame:
    """For words of several genders a JSON list with each gender's first fields, in the order of genders; words of one gender get none."""
    own = df.where(F.col(gender).isin(*genders)).groupBy(key, gender).agg(*[first_value(F.col(f), F.col(order)).alias(f) for f in fields])
    item = F.struct(F.expr(f"instr('{genders}', {gender})").alias("o"), F.struct(F.col(gender).alias("g"), *fields).alias("v"))
    lists = own.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("l"))
    return lists.where(F.size("l") > 1).select(key, F.to_json(F.transform("l", lambda x: x["v"]), {"ignoreNullFields": "false"}).alias("noun_variants"))


def adjacent_runs(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Maximal runs of rows with one value: (keys, run, value, rows, first, last) with first and last of the first order column."""
    w = Window.partitionBy(*keys).orderBy(*order)
    new = (~F.col(value).eqNullSafe(F.lag(value).over(w)) | F.lag(F.lit(1)).over(w).isNull()).cast("int")
    marked = df.withColumn("_new", new).withColumn("run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "run").agg(F.first(value).alias(value), F.count("*").alias("rows"), F.min(order[0]).alias("first"), F.max(order[0]).alias("last"))


def chunks(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """df with `chunk` and `local` (1 .. size): batches of size rows in this order."""
    from lexigrid.sources.sinks import dense_ids

    numbered = dense_ids(df, order, "_n", 0)
    return numbered.withColumn("chunk", F.expr(f"_n div {size}")).withColumn("local", (F.col("_n") % size + 1).cast("int")).drop("_n")


def spellings(df: DataFrame, word: str = "word") -> DataFrame:
    """(key, spellings) of the words that are alike but for case."""
    return df.groupBy(F.lower(word).alias("key")).agg(F.array_sort(F.collect_set(word)).alias("spellings"))
