"""Rewriting texts from evidence: which rows have an anchor, what is asked, what of the answers is taken. Answers are tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.functions.text import clean_gloss, line_count, lines, present
from lexigrid.operators.classify import anchor_outcome, anchor_text
from lexigrid.operators.merge import response_applied
from lexigrid.operators.sampling import proportional


def collect(rows: DataFrame, anchors: DataFrame, buckets: list[str], key: str = "id", word: str = "word") -> tuple[DataFrame, DataFrame]:
    """(ready, outcomes): rows of the buckets with their anchor's text; the others counted by reason. anchors: (word, senses), unique."""
    joined = rows.join(anchors.select(F.lower(word).alias("_w"), "senses"), F.lower(word) == F.col("_w"), "left").withColumn("anchor", anchor_text(F.col("senses")))
    judged = joined.withColumn("outcome", anchor_outcome(F.col("bucket"), buckets, F.try_element_at("senses", F.lit(1))))
    return judged.where("outcome = 'ok'").drop("_w", "senses", "outcome"), judged.groupBy("outcome").count()


def through_base(rows: DataFrame, anchors: DataFrame, pattern: str = r"(?i)\bof\s+([^\s.;,]+)[.;,]?$", word: str = "word", text: str = "translation") -> DataFrame:
    """rows with `anchor`: their own, or, where that says `X of base`, the base's anchor or else the base's own text. One hop, no more."""
    own = anchors.select(F.lower(word).alias("_w"), F.try_element_at("senses", F.lit(1)).alias("_a"))
    j = rows.join(own, F.lower(word) == F.col("_w"), "left").drop("_w").withColumn("_base", F.lower(F.nullif(F.regexp_extract("_a", pattern, 1), F.lit(""))))
    theirs = anchors.select(F.lower(word).alias("_w"), F.try_element_at("senses", F.lit(1)).alias("_ba"))
    texts = rows.groupBy(F.lower(word).alias("_tw")).agg(F.min(text).alias("_bt"))
    j = j.join(theirs, F.col("_base") == F.col("_w"), "left").join(texts, F.col("_base") == F.col("_tw"), "left")
    return j.withColumn("anchor", F.when(F.col("_base").isNull(), F.col("_a")).otherwise(F.coalesce("_ba", "_bt"))).select(*rows.columns, "anchor")


def suspects(ledger: DataFrame, words: DataFrame, done: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Rows of a ledger (id, base, label) whose label is a verb's while the base is none, or whose base is an abbreviation; less what is done."""
    base = words.groupBy(F.lower("word").alias("_w")).agg(F.max(F.array_contains(F.split(F.coalesce("pos", F.lit("")), "/"), "v")).alias("_verb"))
    j = ledger.join(base, F.lower("base") == F.col("_w"), "left")
    verbal = F.col("label").rlike("分词|过去式|第三人称")
    reason = F.when(verbal & ~F.coalesce("_verb", F.lit(False)), "no verb").when(F.col("base").rlike("^[A-Z]{2,}$"), "abbreviation")
    out = j.withColumn("reason", reason).where("reason IS NOT NULL").drop("_w", "_verb")
    return out if done is None else out.join(done.select(key).distinct(), key, "left_anti")


def originals(judged_bad: DataFrame, ledger: DataFrame, key: str = "id") -> DataFrame:
    """The text before a fill, of rows that were judged bad after it."""
    return judged_bad.select(key).distinct().join(ledger.select(key, "word", "before"), key)


def pool(rows: DataFrame, done: DataFrame, buckets: list[str], total: int, key: str = "id", even: bool = False, seed: str = "pool") -> DataFrame:
    """A sample over the buckets of what isn't done yet."""
    return proportional(rows.where(F.col("bucket").isin(*buckets)).join(done.select(key).distinct(), key, "left_anti"), "bucket", total, key, seed, even)


def payload(rows: DataFrame, cross: DataFrame, gloss: str = "definition", key: str = "id", reference: str = r"(?i)\b(?:see|vid|véase)\s+([^\s.;,]+)") -> DataFrame:
    """(id, payload) to ask with: cleaned lines, and the translations of words that they refer to. A row of which a line becomes blank is left out."""
    cleaned = F.transform(F.split(F.col(gloss), "\n"), lambda x: clean_gloss(x))
    own = rows.withColumn("_lines", cleaned).where(F.forall("_lines", lambda x: x != ""))
    refs = own.select(key, F.explode(F.array_distinct(F.transform(F.col("_lines"), lambda x: F.lower(F.regexp_extract(x, reference, 1))))).alias("_r")).where("_r <> ''")
    said = refs.join(cross.groupBy(F.lower("word").alias("_r")).agg(F.min("translation").alias("_t")), "_r").groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("_r", "_t")))).alias("_refs"))
    return own.join(said, key, "left").select(key, F.to_json(F.struct(F.col(key), F.col("word"), F.col("_lines").alias("glosses"), F.col("_refs").alias("references"))).alias("payload"))


def apply_translations(rows: DataFrame, replies: DataFrame, gloss: str = "definition", key: str = "id") -> tuple[DataFrame, DataFrame, int]:
    """(updated, outcomes, filled). replies: (id, word, lines). Taken only if the word is still the same, there are as many lines as glosses,
    and none is blank. filled is how many blank translations become something: what a governed update declares."""
    j = rows.join(replies.select(key, F.col("word").alias("_w"), F.col("lines").alias("_l")), key, "left")
    why = F.when(F.col("_l").isNull(), F.lit(None).cast("string")).when(F.col("_w") != F.col("word"), "word").when(F.size("_l") != line_count(F.col(gloss)), "count").when(F.exists("_l", lambda x: F.trim(x) == ""), "blank").otherwise("ok")
    j = j.withColumn("_why", why)
    updated = j.withColumn("translation", F.when(F.col("_why") == "ok", F.array_join("_l", "\n")).otherwise(F.col("translation"))).select(*rows.columns)
    filled = j.where((F.col("_why") == "ok") & ~present(F.col("translation"))).count()
    return updated, j.where("_why IS NOT NULL").groupBy(F.col("_why").alias("outcome")).count(), filled


def replay(rows: DataFrame, ledger: DataFrame | None, replies: DataFrame, column: str, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Answers applied as if for the first time: an earlier ledger's changes are undone before."""
    from lexigrid.operators.merge import reverted

    return response_applied(rows if ledger is None else reverted(rows, ledger, column, key), replies, column, key)


def appended_sense(rows: DataFrame, extra: DataFrame, gloss: str = "definition", text: str = "translation", meta: str = "meta", key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(updated, rejected): one more sense at the end of three aligned lists. Rows that aren't aligned before, or already have the text, are rejected.

    extra: (id, gloss, zh, note), note a JSON object.
    """
    j = rows.join(extra.select(key, F.col("gloss").alias("_g"), F.col("zh").alias("_z"), F.col("note").alias("_n")), key, "left")
    notes = F.coalesce(F.from_json(F.col(meta), "array<string>"), F.array().cast("array<string>"))
    aligned = (line_count(F.col(gloss)) == line_count(F.col(text))) & (line_count(F.col(gloss)) == F.size(notes))
    known = F.array_contains(lines(F.col(text)), F.col("_z"))
    why = F.when(F.col("_z").isNull(), F.lit(None).cast("string")).when(~aligned, "misaligned").when(known, "known").otherwise("ok")
    j = j.withColumn("_why", why)
    plus = lambda c, x: F.when(F.col("_why") == "ok", F.concat_ws("\n", F.nullif(c, F.lit("")), x)).otherwise(c)
    listed = F.concat(F.lit("["), F.array_join(F.concat(notes, F.array(F.col("_n"))), ","), F.lit("]"))
    updated = j.withColumns({gloss: plus(F.col(gloss), F.col("_g")), text: plus(F.col(text), F.col("_z")), meta: F.when(F.col("_why") == "ok", listed).otherwise(F.col(meta))}).select(*rows.columns)
    return updated, j.where("_why IN ('misaligned', 'known')").select(key, F.col("_why").alias("reason"))


def pos_patched(notes: Column, glosses: Column, by_gloss: Column, single: Column) -> Column:
    """Sense notes with the part of speech that (word, gloss) has in the source, else the word's only one, else as it was."""
    return F.transform(F.arrays_zip(notes.alias("n"), glosses.alias("g")), lambda x: x["n"].withField("pos", F.coalesce(F.element_at(by_gloss, x["g"]), single, x["n"]["pos"])))
