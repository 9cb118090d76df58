"""Samples and quality control: seeded samples that don't depend on partitions, strata with quotas, controls, precision and recall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_of(key: Column, seed: str | int) -> Column:
    """A pseudo-random order that other engines can compute too: the MD5 of seed and key."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def sample(df: DataFrame, n: int, key: str, seed: str | int = 0) -> DataFrame:
    """n rows, uniformly; the same whatever the partitions. A top-k, no full sort."""
    return df.orderBy(order_of(F.col(key), seed), key).limit(n)


def stratified(df: DataFrame, strata: dict[str, Column], quota: int | dict[str, int], key: str, seed: str | int = 0) -> DataFrame:
    """df's sampled rows with `stratum`, the first that a row satisfies; rows of none are left out; at most quota of each.

    Rows are ranked within (stratum, slice of the hash) first and then over the slices' best, so a large stratum is no single task.
    """
    case = F.lit(None).cast("string")
    for name, condition in reversed(list(strata.items())):
        case = F.when(F.coalesce(condition, F.lit(False)), name).otherwise(case)
    most = F.lit(quota) if isinstance(quota, int) else F.element_at(F.create_map(*[F.lit(x) for p in quota.items() for x in p]), F.col("stratum"))
    drawn = df.withColumn("stratum", case).where("stratum IS NOT NULL").withColumn("_h", order_of(F.col(key), seed)).withColumn("_slice", F.substring("_h", 1, 2))
    first = drawn.withColumn("_r", F.row_number().over(Window.partitionBy("stratum", "_slice").orderBy("_h", key))).where(F.col("_r") <= most)
    return first.withColumn("_r", F.row_number().over(Window.partitionBy("stratum").orderBy("_h", key))).where(F.col("_r") <= most).drop("_h", "_slice", "_r")


def proportional(df: DataFrame, stratum: str, total: int, key: str, seed: str | int = 0, even: bool = False) -> DataFrame:
    """total rows over the strata, by their shares (rounded down, one at least) or evenly."""
    sizes = df.groupBy(stratum).count()
    all_ = sizes.agg(F.sum("count").alias("_all"), F.count("*").alias("_strata"))
    quota = F.expr(f"{total} div _strata") if even else F.greatest(F.lit(1), F.floor(F.col("count") * total / F.col("_all")))
    quotas = sizes.crossJoin(F.broadcast(all_)).select(F.col(stratum).alias("_s"), quota.cast("long").alias("_quota"))  # all_ is one row
    drawn = df.join(quotas, F.col(stratum) == F.col("_s")).withColumn("_h", order_of(F.col(key), seed)).withColumn("_slice", F.substring("_h", 1, 2))
    # as in `stratified`: the slices' best first
    first = drawn.withColumn("_r", F.row_number().over(Window.partitionBy(stratum, "_slice").orderBy("_h", key))).where("_r <= _quota")
    return first.withColumn("_r", F.row_number().over(Window.partitionBy(stratum).orderBy("_h", key))).where("_r <= _quota").select(*df.columns)


def with_repeats(df: DataFrame, share: float, key: str, seed: str | int = 1) -> DataFrame:
    """df with `repeat` false, and a share of its rows again with `repeat` true: they show how much a judge disagrees with itself."""
    cut = f"{min(0xFFFFFFFF, int(share * 2**32)):08x}"
    again = df.where(F.substring(order_of(F.col(key), seed), 1, 8) < cut)
    return df.withColumn("repeat", F.lit(False)).unionByName(again.withColumn("repeat", F.lit(True)))


def with_controls(df: DataFrame, column: str, key: str, share: float, seed: str | int = 2) -> DataFrame:
    """df with `control`: a share of rows get a wrong value on purpose, its second half before its first. A judge should object to them."""
    cut = f"{min(0xFFFFFFFF, int(share * 2**32)):08x}"
    half = F.expr(f"length({column}) div 2")
    wrong = F.concat(F.substring(F.col(column), half + 1, F.length(column)), F.substring(F.col(column), F.lit(1), half))
    chosen = (F.substring(order_of(F.col(key), seed), 1, 8) < cut) & (wrong != F.col(column))
    return df.withColumn("control", F.coalesce(chosen, F.lit(False))).withColumn(column, F.when(F.col("control"), wrong).otherwise(F.col(column)))


def precision_recall(df: DataFrame, label: Column, predicted: Column, groups: list[str] = ()) -> DataFrame:
    """(groups, tp, fp, fn, tn, precision, recall) of rows whose label isn't null."""
    y, p = label.cast("boolean"), F.coalesce(predicted.cast("boolean"), F.lit(False))
    n = lambda c: F.count(F.when(c, 1))
    counted = df.where(y.isNotNull()).groupBy(*groups).agg(n(y & p).alias("tp"), n(~y & p).alias("fp"), n(y & ~p).alias("fn"), n(~y & ~p).alias("tn"))
    ratio = lambda a, b: F.col(a) / F.greatest(F.col(a) + F.col(b), F.lit(1))
    return counted.withColumn("precision", ratio("tp", "fp")).withColumn("recall", ratio("tp", "fn"))


def regression(df: DataFrame, before: str, after: str, truth: str) -> DataFrame:
    """(fixed, broke, neutral, unchanged) of a change against an authority."""
    b, a, t = F.col(before), F.col(after), F.col(truth)
    n = lambda c: F.count(F.when(c, 1))
    same = b.eqNullSafe(a)
    return df.where(t.isNotNull()).agg(n(~same & ~b.eqNullSafe(t) & a.eqNullSafe(t)).alias("fixed"), n(~same & b.eqNullSafe(t)).alias("broke"), n(~same & ~b.eqNullSafe(t) & ~a.eqNullSafe(t)).alias("neutral"), n(same).alias("unchanged"))


def agreement_rates(df: DataFrame, found: str, truth: str, groups: list[str] = ()) -> DataFrame:
    """Shares of each kind of agreement between generated and attested pronunciations."""
    from lexigrid.functions.ipa import agreement

    kinds = ["exact", "notation", "stress", "openness", "different"]
    own = df.where(F.col(truth).isNotNull()).withColumn("_kind", F.when(F.col(found).isNull(), "none").otherwise(agreement(F.col(found), F.col(truth))))
    return own.groupBy(*groups).agg(F.count("*").alias("n"), *[(F.count(F.when(F.col("_kind") == k, 1)) / F.greatest(F.count("*"), F.lit(1))).alias(k) for k in [*kinds, "none"]])
