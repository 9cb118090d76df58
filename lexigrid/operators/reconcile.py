"""Reconciliation of sources: provenance, confirmation by independent sources, comparisons of sets and of translations, votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.functions.text import HAN, blank, present


def provenance(value: Column, authority: Column, rule: Column) -> Column:
    """Where a value comes from: authority, rule, overwritten (both are known and it is neither), unknown; null if there is none."""
    return F.when(blank(value), F.lit(None).cast("string")).when(value == authority, "authority").when(value == rule, "rule").when(authority.isNotNull() & rule.isNotNull(), "overwritten").otherwise("unknown")


def translation_source(text: Column, overridden: Column, template: str) -> Column:
    """override, template (each line matches), llm; null if there is none."""
    from lexigrid.functions.text import every_line

    return F.when(blank(text), F.lit(None).cast("string")).when(F.coalesce(overridden, F.lit(False)), "override").when(every_line(text, template), "template").otherwise("llm")


def gender_source(value: Column, extracted: Column, from_meta: Column) -> Column:
    return F.when(blank(value), F.lit(None).cast("string")).when(value == extracted, "head").when(value == from_meta, "senses").otherwise("llm")


def confirmed(df: DataFrame, edition: DataFrame, value: str, source: str, own: str, folds: list[object], word: str = "word") -> DataFrame:
    """df with `confirm`: exact or notation where an independent source says the same, null otherwise.

    edition: (word, value) of one row each. Rows whose value came from that very edition (source = own) are never confirmed by it.
    """
    joined = df.join(edition.select(F.col(word).alias("_w"), F.col(value).alias("_v")), F.col(word) == F.col("_w"), "left")
    alike = F.lit(False)
    for fold in folds:
        alike = alike | (fold(F.col("_v")) == fold(F.col(value)))
    independent = F.coalesce(F.col(source) != own, F.lit(True)) & present(F.col(value)) & F.col("_v").isNotNull()
    tier = F.when(independent & (F.col("_v") == F.col(value)), "exact").when(independent & alike, "notation")
    return joined.withColumn("confirm", tier).select(*[c for c in df.columns if c != "confirm"], "confirm")


def crosstab(df: DataFrame, rows: str, columns: str, values: list[str] | None = None) -> DataFrame:
    """Counts by rows and columns, with a total; values, if given, spare a job that finds them."""
    pivoted = df.groupBy(rows).pivot(columns, values).count() if values else df.groupBy(rows).pivot(columns).count()
    names = [c for c in pivoted.columns if c != rows]
    counts = [F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in names]
    return pivoted.select(rows, *[c.alias(n) for c, n in zip(counts, names, strict=True)], sum(counts, F.lit(0)).alias("total"))


def set_verdict(ours: Column, theirs: Column) -> Column:
    """faithful (the same set), subset, superset, overlap, conflict (nothing in common), missing (we have none), unverifiable."""
    a, b = F.array_distinct(ours), F.array_distinct(theirs)
    return (
        F.when(F.coalesce(F.size(b), F.lit(0)) < 1, "unverifiable")
        .when(F.coalesce(F.size(a), F.lit(0)) < 1, "missing")
        .when((F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0), "faithful")
        .when(F.size(F.array_except(a, b)) == 0, "subset")
        .when(F.size(F.array_except(b, a)) == 0, "superset")
        .when(F.arrays_overlap(a, b), "overlap")
        .otherwise("conflict")
    )


def gloss_tokens(text: Column, simplified: dict[str, str] | None = None) -> Column:
    """The words of a gloss: runs between punctuation and blanks. Bracketed remarks are words like others.

    simplified: traditional signs to simple ones, so that both ways of writing compare.
    """
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s*[a-z]{1,6}[.]\s*", "")
    if simplified:
        plain = F.translate(plain, "".join(simplified), "".join(simplified.values()))
    return F.array_distinct(F.filter(F.split(plain, r"[\s,;，；、。./·()（）]+"), lambda t: t != ""))


def han_signs(text: Column, common: str = "的了一是在") -> Column:
    signs = F.split(F.coalesce(text, F.lit("")), "")
    return F.array_distinct(F.filter(signs, lambda s: s.rlike(HAN) & ~F.contains(F.lit(common), s)))


def agreement_level(ours: Column, theirs: Column) -> Column:
    """L1: a token of one is, or is in, a token of the other; L2: they share a sign that carries meaning; none; unverifiable."""
    a, b = gloss_tokens(ours), gloss_tokens(theirs)
    l1 = F.exists(a, lambda x: F.exists(b, lambda y: F.contains(x, y) | F.contains(y, x)))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), "unverifiable").when(l1, "L1").when(F.arrays_overlap(han_signs(ours), han_signs(theirs)), "L2").otherwise("none")


def uncovered_senses(ours: Column, theirs: Column) -> Column:
    """Those of their senses of which no sense of ours shares a token."""
    return F.filter(theirs, lambda z: ~F.exists(ours, lambda o: F.arrays_overlap(gloss_tokens(o), gloss_tokens(z))))


def sense_evidence(own: Column, first: Column, second: Column) -> Column:
    """How sure it is that senses are missing: both (both sources have more), one, none."""
    more = lambda n: F.coalesce(n > own, F.lit(False))
    return F.when(more(first) & more(second), "both").when(more(first) | more(second), "one").otherwise("none")


def vote(kept: Column, offered: Column, fresh: Column) -> Column:
    """keep, override, three_way or no_vote."""
    return F.when(blank(fresh), "no_vote").when(fresh == kept, "keep").when(fresh == offered, "override").otherwise("three_way")


def triage(kept: Column, offered: Column, key: object, residual: str = r"[()\[\]~]") -> Column:
    """Conflicts that are only notation, that have leftovers of markup, and real ones."""
    return F.when(key(kept) == key(offered), "notation").when(kept.rlike(residual) | offered.rlike(residual), "residual").otherwise("lexical")


def harvested_accents(entries: DataFrame, key: object) -> DataFrame:
    """(word_norm, accented): of the spellings with an accent the first for each key."""
    forms = entries.select("seq", F.explode(F.concat(F.array(F.col("word")), F.transform("forms", lambda f: F.trim(f["form"])))).alias("w")).where(F.col("w").rlike("[àèéìíòóùáú]"))
    return forms.groupBy(key(F.col("w")).alias("word_norm")).agg(F.min_by("w", "seq").alias("accented"))


def harvested_forms(entries: DataFrame) -> DataFrame:
    """(word, ipa): the first pronunciation that any entry's list of forms gives a form."""
    forms = entries.select("seq", F.posexplode("forms").alias("i", "f")).where(present(F.col("f.ipa")) & present(F.col("f.form")))
    junk = F.coalesce(F.arrays_overlap("f.tags", F.array(*map(F.lit, "inflection-template multiword-construction table-tags".split()))), F.lit(False))
    return forms.where(~junk & F.col("f.form").rlike(r"(?U)^[\p{L}][\p{L}'’ -]*$")).groupBy(F.lower(F.trim("f.form")).alias("word")).agg(F.min_by(F.trim("f.ipa"), F.struct("seq", "i")).alias("ipa"))


def inherited(df: DataFrame, base_col: str, ipa: str, stem: object, onset: object, word: str = "word") -> DataFrame:
    """df with `inherited`: the base's pronunciation where stem and onset of form and base agree; null otherwise."""
    b = df.select(F.col(word).alias("_b"), F.col(ipa).alias("_bi")).where(present(F.col("_bi"))).groupBy("_b").agg(F.min("_bi").alias("_bi"))
    joined = df.join(b, F.col(base_col) == F.col("_b"), "left")
    fits = (stem(F.col(word)) == stem(F.col("_b"))) & (onset(F.col(word)) == onset(F.col("_b")))
    return joined.withColumn("inherited", F.when(fits, F.col("_bi"))).drop("_b", "_bi")


def composed(df: DataFrame, parts: DataFrame, word: str = "word", ipa: str = "ipa", key: str = "id", sandhi: list[tuple[str, str]] = ()) -> DataFrame:
    """(key, composed): for words of several parts the parts' pronunciations in order, only where every part has one."""
    tokens = df.where(F.contains(F.trim(word), F.lit(" "))).select(key, F.posexplode(F.split(F.trim(word), r"\s+")).alias("i", "_t"))
    known = parts.where(present(F.col(ipa))).groupBy(F.lower(word).alias("_p")).agg(F.min(ipa).alias("_ipa"))
    joined = tokens.join(known, F.lower("_t") == F.col("_p"), "left")
    whole = joined.groupBy(key).agg(F.bool_and(F.col("_ipa").isNotNull()).alias("all"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "_ipa"))), lambda x: x["_ipa"]), " ").alias("c"))
    c = F.col("c")
    for pattern, replacement in sandhi:
        c = F.regexp_replace(c, pattern, replacement)
    return whole.where("all").select(key, c.alias("composed"))


def template_translations(df: DataFrame, known: DataFrame, patterns: list[tuple[str, str]], gloss: str = "definition", key: str = "id") -> DataFrame:
    """(key, translation) of rows each of whose lines is `Diminutive of x` or the like with x's translation known: x's and the suffix.

    patterns: (expression whose group 1 is x, suffix). One line that fits none, or whose x is unknown, leaves the whole row out.
    """
    lines = df.select(key, F.posexplode(F.split(F.col(gloss), "\n")).alias("i", "line"))
    base, suffix = F.lit(None).cast("string"), F.lit(None).cast("string")
    for pattern, tail in reversed(patterns):
        base = F.when(F.col("line").rlike(pattern), F.regexp_extract("line", pattern, 1)).otherwise(base)
        suffix = F.when(F.col("line").rlike(pattern), F.lit(tail)).otherwise(suffix)
    asked = lines.withColumn("_x", base).withColumn("_s", suffix)
    own = known.groupBy(F.lower("word").alias("_w")).agg(F.min("translation").alias("_t"))
    joined = asked.join(own, F.lower("_x") == F.col("_w"), "left").withColumn("_line", F.concat("_t", "_s"))
    rows = joined.groupBy(key).agg(F.bool_and(F.col("_line").isNotNull()).alias("all"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "_line"))), lambda x: x["_line"]), "\n").alias("translation"))
    return rows.where("all").select(key, "translation")


def candidate_roots(df: DataFrame, words: DataFrame, prefixes: list[str], suffixes: list[tuple[str, str]], key: object, word: str = "word", most: int = 3) -> DataFrame:
    """(word, roots): up to `most` known words that word may derive from, by a prefix taken away or an ending swapped, the longest first."""
    c = F.col(word)
    made = [F.when(F.startswith(c, F.lit(p)) & (F.length(c) > len(p) + 2), F.substring(c, F.lit(len(p) + 1), F.length(c))) for p in prefixes]
    made += [F.when(F.endswith(c, F.lit(a)) & (F.length(c) > len(a) + 2), F.concat(F.substring(c, F.lit(1), F.length(c) - len(a)), F.lit(b))) for a, b in suffixes]
    tried = df.select(c.alias("_of"), F.explode(F.array_distinct(F.array_compact(F.array(*made)))).alias("_c")).where("_c <> _of")
    known = words.select(F.col(word).alias("_root"), key(F.col(word)).alias("_k"))
    found = tried.join(known, key(F.col("_c")) == F.col("_k")).groupBy("_of").agg(F.array_sort(F.collect_set(F.struct((-F.length("_root")).alias("n"), F.col("_root").alias("r")))).alias("l"))
    return found.select(F.col("_of").alias(word), F.slice(F.transform("l", lambda x: x["r"]), 1, most).alias("roots"))


def evidence(sources: dict[str, DataFrame], words: DataFrame, word: str = "word", gloss: str = "gloss") -> DataFrame:
    """(word, evidence): for words without a gloss what each named source says, in the order of the sources' names."""
    every = None
    for name, df in sorted(sources.items()):
        own = df.join(words.select(word).distinct(), word, "left_semi").where(present(F.col(gloss))).select(word, F.struct(F.lit(name).alias("source"), F.col(gloss).alias("gloss")).alias("e"))
        every = own if every is None else every.unionByName(own)
    return every.groupBy(word).agg(F.array_sort(F.collect_set("e")).alias("evidence"))
