"""Merges of competing sources: the authority's value stays, gaps are filled, disagreement is recorded; and what is reverted."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.functions.text import blank, present


@dataclass(frozen=True)
class Field:
    """accept: a condition on the offered value (a column) without which it doesn't count. pos: a value is taken only for words of these.

    overwrite: taken as offered, even if null. logged: whether a disagreement is recorded.
    """

    name: str
    accept: object = None
    pos: tuple[str, ...] = ()
    overwrite: bool = False
    logged: bool = True


LEVELS = tuple(a + n for a in "ABC" for n in "12")


def joined_lines(c: Column) -> Column:
    """A list as lines, trimmed, without blank ones; null if none is left."""
    return F.nullif(F.array_join(F.filter(F.transform(c, lambda x: F.trim(x)), lambda x: x != ""), "\n"), F.lit(""))


def level(c: Column) -> Column:
    up = F.upper(F.trim(c))
    return F.when(up.isin(*LEVELS), up)


def _offered(field: Field, posset: Column | None) -> Column:
    value = F.trim(F.col(f"_new_{field.name}"))
    value = F.when(value != "", value) if not field.overwrite else F.col(f"_new_{field.name}")
    if field.accept is not None:
        value = F.when(field.accept(value), value)
    if field.pos and posset is not None:
        value = F.when(F.arrays_overlap(posset, F.array(*map(F.lit, field.pos))), value)
    return value


def fill_merge(df: DataFrame, offers: DataFrame, fields: list[Field], key: str = "id", pos: str | None = "pos", word: str = "word") -> tuple[DataFrame, DataFrame]:
    """(merged, conflicts). Offers' keys must be unique; keys that df lacks are ignored.

    conflicts has (word, field, kept, offered) where both have a value and they differ but for blanks at the ends.
    """
    names = [f.name for f in fields]
    new = offers.select(F.col(key), F.lit(True).alias("_hit"), *[F.col(n).alias(f"_new_{n}") for n in names])
    joined = df.join(new, key, "left")
    posset = F.split(F.coalesce(F.col(pos), F.lit("")), "/") if pos else None
    joined = joined.withColumns({f"_new_{f.name}": _offered(f, posset) for f in fields})
    merged = {}
    for f in fields:
        old, offered = F.col(f.name), F.col(f"_new_{f.name}")
        merged[f.name] = F.when(F.col("_hit"), offered).otherwise(old) if f.overwrite else F.when(blank(old), F.coalesce(offered, old)).otherwise(old)
    out = joined.select(*[merged.get(c, F.col(c)).alias(c) for c in df.columns])
    logged = [f.name for f in fields if f.logged and not f.overwrite]
    if not logged:
        return out, joined.select(F.col(word).alias("word"), F.lit("").alias("field"), F.lit("").alias("kept"), F.lit("").alias("offered")).limit(0)
    stacked = F.stack(F.lit(len(logged)), *[x for n in logged for x in (F.lit(n), F.trim(F.col(n).cast("string")), F.col(f"_new_{n}").cast("string"))])
    conflicts = joined.where(F.col("_hit")).select(F.col(word).alias("word"), stacked.alias("field", "kept", "offered")).where(present(F.col("kept")) & F.col("offered").isNotNull() & (F.col("kept") != F.col("offered")))
    return out, conflicts


def resolved_gender(known: Column, offered: Column) -> Column:
    """known: the senses' distinct genders. None: the offer; one: mf if either says so, else the newcomer; several: null, they stay."""
    only = F.try_element_at(known, F.lit(1))
    ok = offered.isin("m", "f", "mf")
    return F.when(~ok | offered.isNull(), F.lit(None).cast("string")).when(F.size(known) == 0, offered).when(F.size(known) > 1, F.lit(None).cast("string")).when(only == offered, only).when((only == "mf") | (offered == "mf"), "mf").otherwise(offered)


def with_gender(meta: Column, resolved: Column, senses: Column) -> Column:
    """Sense notes with this gender; without notes, as many as there are senses, one at least."""
    empty = F.transform(F.sequence(F.lit(1), F.greatest(F.size(senses), F.lit(1))), lambda _: F.struct(resolved.alias("g")))
    return F.when(resolved.isNull(), meta).when(F.size(meta) > 0, F.transform(meta, lambda m: m.withField("g", resolved))).otherwise(empty)


def fill_in_order(*sources: tuple[str, Column]) -> tuple[Column, Column]:
    """The first value that isn't blank, and its source's name."""
    value, name = F.lit(None).cast("string"), F.lit(None).cast("string")
    for label, c in reversed(sources):
        value, name = F.when(present(c), c).otherwise(value), F.when(present(c), F.lit(label)).otherwise(name)
    return value, name


def overlay(*sources: tuple[DataFrame, str], key: str = "id", name: str = "grade") -> DataFrame:
    """(key, name) with the value of the first source that has the key; each source is (key, its value column)."""
    ranked = None
    for i, (df, column) in enumerate(sources):
        own = df.select(key, F.struct(F.lit(i).alias("i"), F.col(column).cast("string").alias("v")).alias("c"))
        ranked = own if ranked is None else ranked.unionByName(own)
    return ranked.where("c.v IS NOT NULL").groupBy(key).agg(F.min("c").alias("c")).select(key, F.col("c.v").alias(name))


def preserved_then(df: DataFrame, column: str, normalised: Column, raw: str | None = None, source: tuple[str, Column] | None = None) -> DataFrame:
    """df with the value as it came in raw (kept if there already) and the normal form in column."""
    raw = raw or f"{column}_raw"
    kept = F.coalesce(F.col(raw), F.col(column)) if raw in df.columns else F.col(column)
    return df.withColumns({raw: kept, column: normalised, **({source[0]: source[1]} if source else {})})


def guarded(df: DataFrame, changes: DataFrame, column: str, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(updated, rejected). changes: (key, before, after). A change counts only where the current value is still its before."""
    joined = df.join(changes.select(key, F.col("before").alias("_b"), F.col("after").alias("_a"), F.lit(True).alias("_hit")), key, "left")
    fits = F.col("_hit") & F.col(column).eqNullSafe(F.col("_b"))
    updated = joined.withColumn(column, F.when(fits, F.col("_a")).otherwise(F.col(column))).select(*df.columns)
    rejected = joined.where(F.col("_hit") & ~fits).select(key, F.col("_b").alias("before"), F.col(column).alias("current"), F.col("_a").alias("after"))
    return updated, rejected


def reverted(df: DataFrame, ledger: DataFrame, column: str, key: str = "id", blocked: DataFrame | None = None, order: str | None = None) -> DataFrame:
    """df with the ledger's changes undone where the last of them still stands; ids in blocked are left as they are.

    Of several entries for a key, in the order of the ledger's column `order`, the first's before is restored if the value is the last's
    after. Without an order a key's entries must form a chain: the first is the one whose before no other has as its after, the last
    likewise; where no chain has such ends the least and the greatest count.
    """
    undo = ledger if blocked is None else ledger.join(blocked.select(key).distinct(), key, "left_anti")
    if order:
        ends = undo.groupBy(key).agg(F.max_by("after", order).alias("before"), F.min_by("before", order).alias("after"))
    else:
        own = undo.groupBy(key).agg(F.collect_set("before").alias("b"), F.collect_set("after").alias("a"), F.min("before").alias("least"), F.max("after").alias("most"))
        ends = own.select(key, F.coalesce(F.array_max(F.array_except("a", "b")), "most").alias("before"), F.coalesce(F.array_min(F.array_except("b", "a")), "least").alias("after"))
    return guarded(df, ends, column, key)[0]


def response_applied(df: DataFrame, replies: DataFrame, column: str, key: str = "id", gates: list[tuple[str, Column]] = ()) -> tuple[DataFrame, DataFrame]:
    """(updated, outcomes). replies: (key, fix, text). Written only if fix is `rewrite`, the text isn't blank and no gate rejects it.

    gates are (reason, condition on `text` and the columns of df); the first that holds rejects. outcomes counts reasons, `ok` among them.
    """
    joined = df.join(replies.select(key, F.col("fix").alias("fix"), F.trim("text").alias("text")), key, "left")
    why = F.when(F.col("fix").isNull(), F.lit(None).cast("string")).when(F.col("fix") != "rewrite", F.concat(F.lit("fix: "), F.col("fix"))).when(blank(F.col("text")), "blank")
    for reason, condition in gates:
        why = why.when(condition, reason)
    judged = joined.withColumn("_why", why.otherwise("ok"))
    updated = judged.withColumn(column, F.when(F.col("_why") == "ok", F.col("text")).otherwise(F.col(column))).select(*df.columns)
    return updated, judged.where("_why IS NOT NULL").groupBy(F.col("_why").alias("outcome")).count()


def gate_reasons(old: Column, new: Column, letters: str, least: float = 0.6, han: str = r"[㐀-鿿]") -> Column:
    """Why a new value isn't taken: empty, han, letters (signs beyond the class), shorter (under least of the old length); null if it is."""
    return (
        F.when(blank(new), "empty")
        .when(new.rlike(han), "han")
        .when(new.rlike(f"[^{letters}]"), "letters")
        .when(F.length(new) < F.length(old) * least, "shorter")
    )
