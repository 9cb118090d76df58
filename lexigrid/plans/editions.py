"""Intake beyond the plain build: new words of the English extract, another edition's entries as staged rows, essentials filled in afterwards,
parts of speech of senses, the recovery of feminine equivalents, and where the text of a pointing row may come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.functions import morph
from lexigrid.functions.text import HAN, blank, lines, present
from lexigrid.operators import govern
from lexigrid.operators.classify import guard_flags, shell
from lexigrid.operators.fold import first_value, ordered_distinct
from lexigrid.operators.reconcile import gloss_tokens, han_signs

UK = ["UK", "Received-Pronunciation", "British"]
US = ["US", "General-American", "American"]
_CODES = [("s", ("plural",), ()), ("p", ("past",), ("participle",)), ("d", ("past", "participle"), ()), ("i", ("present", "participle"), ()), ("3", ("third-person", "singular"), ()), ("r", ("comparative",), ()), ("t", ("superlative",), ())]


def _strings(xs: list[str]) -> Column:
    return F.array(*map(F.lit, xs))


def accented_ipa(sounds: Column, wanted: list[str]) -> Column:
    """The first pronunciation with one of the tags, else the first without any tag; of several after commas the first, without its marks."""
    clean = F.transform(F.filter(sounds, lambda s: s["ipa"].isNotNull()), lambda s: F.struct(F.trim(F.regexp_replace(F.element_at(F.split(s["ipa"], ","), 1), r"^[/\[\] ]+|[/\[\] ]+$", "")).alias("ipa"), morph.tags_of(s).alias("tags")))
    some = F.filter(clean, lambda s: s["ipa"] != "")
    tagged = F.filter(some, lambda s: F.arrays_overlap(s["tags"], _strings(wanted)))
    plain = F.filter(some, lambda s: F.size(s["tags"]) == 0)
    return F.coalesce(F.try_element_at(tagged, F.lit(1))["ipa"], F.try_element_at(plain, F.lit(1))["ipa"])


def form_codes(forms: Column) -> Column:
    """The entry's forms as `code:form/code:form`; a form's code is the first of the list that its tags allow."""

    def code(f: Column) -> Column:
        out = F.lit(None).cast("string")
        for name, need, without in reversed(_CODES):
            fits = morph.has(morph.tags_of(f), *need)
            if without:
                fits = fits & ~morph.any_of(morph.tags_of(f), *without)
            out = F.when(fits, F.lit(name)).otherwise(out)
        return out

    pairs = F.transform(F.filter(forms, lambda f: F.coalesce(f["form"], F.lit("")) != ""), lambda f: F.concat(code(f), F.lit(":"), f["form"]))
    return F.nullif(F.array_join(F.filter(pairs, lambda p: p.isNotNull()), "/"), F.lit(""))


def english_new_words(entries: DataFrame, known: DataFrame, most: int = 5) -> DataFrame:
    """A row (key, word, definition, phonetic_uk, phonetic_us, pos, exchange) for each word that known lacks, case aside.

    definition: the first `most` glosses of the first entry that has any, one a line. Each other column: the first entry's that has it; word
    and pos: the first entry's. entries have `seq`.
    """
    fresh = entries.join(known.select(F.lower("word").alias("_k")).distinct(), F.lower("word") == F.col("_k"), "left_anti")
    glosses = F.flatten(F.transform(F.col("senses"), lambda s: F.coalesce(s["glosses"], F.array().cast("array<string>"))))
    own = fresh.select(
        F.lower("word").alias("key"), "seq", "word",
        F.nullif(F.array_join(F.slice(glosses, 1, most), "\n"), F.lit("")).alias("definition"),
        accented_ipa(F.col("sounds"), UK).alias("phonetic_uk"), accented_ipa(F.col("sounds"), US).alias("phonetic_us"),
        F.concat(morph.short_pos(F.lower("pos")), F.lit(":100")).alias("pos"), form_codes(F.col("forms")).alias("exchange"),
    )
    order = F.col("seq")
    return own.groupBy("key").agg(F.min_by("word", order).alias("word"), *[first_value(F.col(c), order).alias(c) for c in ("definition", "phonetic_uk", "phonetic_us")], F.min_by("pos", order).alias("pos"), first_value(F.col("exchange"), order).alias("exchange"))


INFLECTION = (
    r"(?i)persona\b|\b(?:plural|singular)\b|gerundio|(?:partici|infini)(?:pio|tivo)|imperativo|(?:indica|subjun)(?:tivo|ctivo)|condicional|forma del? |(?:femen|mascul)ino|"
    r"(?:superla|diminu|aumenta)tivo|grafía alternativa|enclític|del verbo|pretérito|(?:presente|futuro) de"
)


def form_entry(pos_title: Column, title: str = "Forma") -> Column:
    """Whether an entry's heading says that it is an inflected form. A hint for the whole entry, never decisive for a sense."""
    return F.startswith(F.coalesce(pos_title, F.lit("")), F.lit(title))


def form_sense(sense: Column, entry_is_form: Column, prose: str = INFLECTION) -> Column:
    """Whether a sense describes an inflection: it links to a base, or the entry is a form and the sense's own words say so, too."""
    linked = (F.coalesce(F.size(sense["form_of"]), F.lit(0)) > 0) | (F.coalesce(F.size(sense["alt_of"]), F.lit(0)) > 0)
    return linked | (entry_is_form & F.coalesce(F.try_element_at(sense["glosses"], F.lit(1)).rlike(prose), F.lit(False)))


def in_either(one: DataFrame, other: DataFrame, word: str = "word") -> DataFrame:
    """The distinct folded words of both: those in the table already and those that come with this batch."""
    return one.select(F.lower(word).alias("word")).unionByName(other.select(F.lower(word).alias("word"))).distinct()


def staged_rows(records: DataFrame, table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, counts). records: (word, pos, glosses, infl, bases, is_lemma). Bases that neither the table nor the batch has aren't pointed to;
    a form's translation is its inflection, a lemma's is left open. counts: how many bases dangle, how many rows are lemmas and forms."""
    known = in_either(table, records).withColumnRenamed("word", "_known")
    edges = records.select("word", F.posexplode("bases").alias("i", "base")).join(known, F.lower("base") == F.col("_known"), "left")
    lists = edges.groupBy("word").agg(F.transform(F.array_sort(F.collect_list(F.when(F.col("_known").isNotNull(), F.struct("i", "base")))), lambda x: F.concat(F.lit("0:"), x["base"])).alias("_to"), F.count(F.when(F.col("_known").isNull(), 1)).alias("_dangling"))
    joined = records.join(lists, "word", "left")
    as_lines = lambda c: F.nullif(F.array_join(c, "\n"), F.lit(""))
    rows = joined.select("word", "pos", F.col("is_lemma").cast("int").alias("is_lemma"), as_lines(F.col("glosses")).alias("definition"), F.when(~F.col("is_lemma"), as_lines(F.col("infl"))).alias("translation"), as_lines(F.col("_to")).alias("exchange"))
    counts = joined.agg(F.coalesce(F.sum("_dangling"), F.lit(0)).alias("dangling"), F.count(F.when(F.col("is_lemma"), 1)).alias("lemmas"), F.count(F.when(~F.col("is_lemma"), 1)).alias("forms"))
    return rows, counts


def expected_changes(rows: DataFrame, columns: list[str]) -> dict[str, int]:
    """What inserting rows must change: the number of rows, and of values in each column; what a governed update declares."""
    return {r["name"]: r["n"] for r in govern.snapshot(rows, columns).collect()}  # a row for each column


def stage_and_apply(store: object, rows: DataFrame, dry: bool = True) -> dict[str, int]:
    """The declared changes of inserting rows into the store's table; applied, under a session that admits just these, unless dry."""
    from lexigrid.sources.sinks import inserted

    current = store.current()
    declared = expected_changes(inserted(current.limit(0), rows), current.columns)
    if not dry:
        govern.Session(store, declared, list(current.columns)).apply(lambda d: inserted(d, rows))
    return declared


def backfilled(df: DataFrame, essence: DataFrame, gates: dict[str, tuple[str, ...]], key: str = "word", pos: str = "pos") -> DataFrame:
    """df with its blank essentials from essence (unique by `key`, case aside), each only for words of the parts of speech that gates name."""
    own = essence.select(F.lower(key).alias("_k"), *[F.col(c).alias(f"_e_{c}") for c in gates])
    posset = F.split(F.coalesce(F.col(pos), F.lit("")), "/")
    joined = df.join(own, F.lower(key) == F.col("_k"), "left")
    return joined.withColumns({c: F.when(blank(F.col(c)) & F.arrays_overlap(posset, _strings(list(some))), F.coalesce(F.col(f"_e_{c}"), F.col(c))).otherwise(F.col(c)) for c, some in gates.items()}).select(*df.columns)


def sense_parts(senses: DataFrame) -> DataFrame:
    """(key, gloss, pos): of each word's gloss the part of speech that the first sense with it has. senses: (key, seq, gloss, pos)."""
    return senses.where(present(F.col("gloss"))).groupBy("key", "gloss").agg(F.min_by("pos", "seq").alias("pos"))


def parts_patched(df: DataFrame, parts: DataFrame, key: str = "id", word: str = "word", gloss: str = "definition", pos: str = "pos") -> DataFrame:
    """df with `line_pos`, a part of speech for each line of the glosses: the one of (word, line), else the word's only one, else none."""
    each = df.select(key, F.lower(word).alias("key"), F.split(F.coalesce(F.col(pos), F.lit("")), "/").alias("_own"), F.posexplode(F.split(F.col(gloss), "\n")).alias("i", "gloss"))
    found = each.join(parts.withColumnRenamed("pos", "_pos"), ["key", "gloss"], "left")
    one = F.coalesce("_pos", F.when(F.size("_own") == 1, F.nullif(F.element_at("_own", 1), F.lit(""))))
    lists = found.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", one.alias("p")))), lambda x: x["p"]).alias("line_pos"))
    return df.join(lists, key, "left")


def reflexive_bases(df: DataFrame, base: Column, direct: Column, other: Column) -> DataFrame:
    """Rows of the other kind whose base has a row of the direct kind: a semi join of the table with itself."""
    own = df.where(direct).select(base.alias("_b")).where("_b IS NOT NULL").distinct()
    return df.where(other).withColumn("_of", base).join(own, F.col("_of") == F.col("_b"), "left_semi").drop("_of")


def gender_repaired(df: DataFrame, dual: DataFrame, gloss: str = "definition", gender: str = "gender", key: str = "word") -> DataFrame:
    """df with the gender of senses that dual (key, gloss, gender) knows, only where one of the row's glosses is just that text."""
    each = df.select(key, F.explode(F.split(F.col(gloss), "\n")).alias("gloss")).distinct().join(dual.select(F.col("key").alias(key), "gloss", F.col("gender").alias("_g")), [key, "gloss"])
    own = each.groupBy(key).agg(F.when(F.size(F.collect_set("_g")) > 1, "mf").otherwise(F.min("_g")).alias("_new"))
    return df.join(own, key, "left").withColumn(gender, F.coalesce("_new", gender)).select(*df.columns)


EQUIVALENT = r"equivalent of ([^\s,;.:()]+)"


def feminine_candidates(entries: DataFrame) -> DataFrame:
    """(word, base, glosses): words of which a sense that was dropped as a form says `equivalent of` another word. entries have `seq`."""
    s = entries.select("word", "seq", F.posexplode("senses").alias("at", "s"))
    s = s.select("word", F.struct("seq", "at").alias("o"), F.array_join("s.glosses", " ").alias("g")).where(F.contains("g", F.lit("equivalent of")) & F.array_contains(morph.tags_of(F.col("s")), "form-of"))
    return s.groupBy("word").agg(F.nullif(F.regexp_extract(F.min_by("g", "o"), EQUIVALENT, 1), F.lit("")).alias("base"), ordered_distinct(F.col("g"), F.col("o")).alias("glosses"))


def real_senses(text: Column, label: str) -> Column:
    """The lines of a translation that aren't only the label of a form."""
    return F.filter(lines(text), lambda x: ~x.rlike(label))


def feminine_bucket(text: Column, label: str) -> Column:
    """A: nothing but labels, the sense has to be written; C: real senses are there, it may be one of them."""
    return F.when(F.size(real_senses(text, label)) > 0, "C").otherwise("A")


def novel_senses(offered: Column, ours: Column) -> Column:
    """Offered senses of which none of ours shares a token or a sign that carries meaning, each once: of offers that share tokens the first."""

    def alike(a: Column, b: Column) -> Column:
        return F.exists(gloss_tokens(a), lambda x: F.exists(gloss_tokens(b), lambda y: F.contains(x, y) | F.contains(y, x)))

    fresh = F.filter(offered, lambda z: (F.size(gloss_tokens(z)) > 0) & ~F.exists(ours, lambda o: alike(z, o) | F.arrays_overlap(han_signs(z), han_signs(o))))
    return F.aggregate(fresh, F.array().cast("array<string>"), lambda kept, z: F.when(F.exists(kept, lambda k: alike(k, z)), kept).otherwise(F.concat(kept, F.array(z))))


def feminine_recovered(table: DataFrame, entries: DataFrame, offers: DataFrame, label: str, word: str = "word", text: str = "translation") -> DataFrame:
    """(word, base, bucket, novel) for the candidates that the table has: the bucket of their row, and what offers (word, senses) add to it.

    Of several rows of a word a lemma's counts, then the least id.
    """
    own = table.groupBy(word).agg(F.min_by(text, F.struct((F.lit(0) - F.coalesce(F.col("is_lemma").cast("int"), F.lit(0))).alias("l"), F.col("id"))).alias("_text"))
    known = feminine_candidates(entries).join(own, word).join(offers.select(F.col(word), F.col("senses").alias("_offered")), word, "left")
    return known.select(word, "base", feminine_bucket(F.col("_text"), label).alias("bucket"), novel_senses(F.coalesce("_offered", F.array().cast("array<string>")), real_senses(F.col("_text"), label)).alias("novel"))


POINTER = r"(?i)([a-z][a-z' -]*?)\s*的(?:.*(?:复数|分词|时态|过去式|第三人称|比较级|最高级))"


def _with_bases(rows: DataFrame, pattern: str, key: str, word: str, text: str) -> DataFrame:
    """rows with `_base` (of `base的复数` and the like), and `_bt`, `_bw`, the translation and spelling of that base in rows."""
    texts = rows.groupBy(F.lower(F.trim(word)).alias("_w")).agg(F.min_by(F.struct(F.trim(F.coalesce(text, F.lit(""))).alias("t"), F.col(word).alias("w")), key).alias("_b"))
    asked = rows.withColumn("_base", F.nullif(F.lower(F.trim(F.regexp_extract(F.regexp_replace(F.coalesce(text, F.lit("")), "\n", " "), pattern, 1))), F.lit("")))
    return asked.join(texts, F.col("_base") == F.col("_w"), "left").withColumns({"_bt": F.col("_b.t"), "_bw": F.col("_b.w")}).drop("_b", "_w")


TAXON = r"(?i)^(?:genus|family|order|class|tribe|phylum|saint|st\.?) "


def pointer_targets(rows: DataFrame, blocked: DataFrame | None = None, pattern: str = POINTER, key: str = "id", word: str = "word", text: str = "translation") -> tuple[DataFrame, DataFrame]:
    """(targets, reasons): for rows whose translation is only a pointer the base's text, and why the others have none, counted.

    The reasons in order: blocked, no base, taxon, unknown base, web (crowd-sourced base), shell (the base only points), itself, no han, guard.
    """
    own = _with_bases(rows, pattern, key, word, text).where(shell(F.coalesce(F.col(text), F.lit(""))))
    stop = rows.limit(0).select(key) if blocked is None else blocked.select(key).distinct()
    own = own.join(stop.withColumn("_stop", F.lit(True)), key, "left")
    label = F.regexp_extract(F.col(text), "(复数|过去分词|现在分词|过去式|第三人称|比较级|最高级)", 1)
    why = (
        F.when(F.col("_stop"), "blocked")
        .when(F.col("_base").isNull(), "no base")
        .when(F.col("_base").rlike(TAXON), "taxon")
        .when(F.coalesce(F.col("_bt"), F.lit("")) == "", "unknown base")
        .when(F.contains("_bt", F.lit("[网络]")), "web")
        .when(shell(F.col("_bt")), "shell")
        .when(F.col("_base") == F.lower(F.trim(word)), "itself")
        .when(~F.col("_bt").rlike(HAN), "no han")
        .when(F.size(guard_flags(F.col("_bw"), F.col("_bt"), F.lit("v"), F.col(word), label)) > 0, "guard")
        .otherwise("ok")
    )
    judged = own.withColumn("_why", why)
    return judged.where("_why = 'ok'").select(key, word, F.col("_base").alias("base"), F.col("_bt").alias("base_text")), judged.groupBy(F.col("_why").alias("reason")).count()


def anchor_layers(rows: DataFrame, glosses: DataFrame, real: DataFrame, pattern: str = POINTER, key: str = "id", word: str = "word", text: str = "translation") -> DataFrame:
    """(key, base, layer) of rows that only point to a base: what may anchor their rewriting.

    E no base; P pseudo-plural of a known base; F pseudo-plural of an unknown one; D no anchor; A the base has a gloss and Han text, B Han
    text only, C a gloss only. A pseudo-plural is of a taxon or a name, unless real (word) has the plural itself. glosses: (word).
    """
    own = _with_bases(rows, pattern, key, word, text).where(shell(F.coalesce(F.col(text), F.lit(""))))
    own = own.join(glosses.select(F.lower("word").alias("_g")).distinct(), F.col("_base") == F.col("_g"), "left").join(real.select(F.lower("word").alias("_r")).distinct(), F.lower(word) == F.col("_r"), "left")
    name = F.col("_base").rlike(TAXON) | F.coalesce(F.col("_bw").rlike(r"(?U)^\p{Lu}"), F.lit(False)) | F.col(word).rlike(r"(?U)^\p{Lu}")
    pseudo, han = name & F.col("_r").isNull(), F.coalesce(F.col("_bt").rlike(HAN), F.lit(False))
    layer = (
        F.when(F.col("_base").isNull(), "E")
        .when(pseudo & F.col("_bt").isNotNull(), "P")
        .when(pseudo, "F")
        .when(F.col("_g").isNull() & ~han, "D")
        .when(F.col("_g").isNotNull() & han, "A")
        .when(han, "B")
        .otherwise("C")
    )
    return own.select(key, F.col("_base").alias("base"), layer.alias("layer"))


def migration(before: DataFrame, after: DataFrame, verdict: str, key: str = "id") -> DataFrame:
    """(before, after, n): how verdicts moved between two judgements of the same rows; a row that the second lacks has `novote`."""
    b, a = before.select(key, F.col(verdict).alias("before")), after.select(key, F.col(verdict).alias("after"))
    return b.join(a, key, "left").withColumn("after", F.coalesce("after", F.lit("novote"))).groupBy("before", "after").agg(F.count("*").alias("n"))


def moved(migrated: DataFrame, good: str = "ok", bad: tuple[str, ...] = ("bad", "warn")) -> DataFrame:
    """(improved, degraded) of a migration."""
    was_bad, is_bad = F.col("before").isin(*bad), F.col("after") == bad[0]
    return migrated.agg(F.coalesce(F.sum(F.when(was_bad & (F.col("after") == good), F.col("n"))), F.lit(0)).alias("improved"), F.coalesce(F.sum(F.when((F.col("before") == good) & is_bad, F.col("n"))), F.lit(0)).alias("degraded"))


def flag_group(flag: Column, mark: str = "misalign") -> Column:
    """A_misalign, B_semflag or C_noflag: what a flag says, for a comparison of the groups."""
    return F.when(F.contains(F.coalesce(flag, F.lit("")), F.lit(mark)), "A_misalign").when(present(flag), "B_semflag").otherwise("C_noflag")


def flagged(df: DataFrame, flag: str = "flag", mark: str = "__misalign__") -> tuple[DataFrame, DataFrame]:
    """(rows whose flag begins with mark, rows with another flag). An underscore of the mark is itself, not a wildcard."""
    hit = F.startswith(F.coalesce(F.col(flag), F.lit("")), F.lit(mark))
    return df.where(hit), df.where(present(F.col(flag)) & ~hit)


def group_quality(judged: DataFrame, group: Column, verdict: str = "verdict") -> DataFrame:
    """(group, total, ok, warn, bad, bad_share) of judged rows by group."""
    counts = judged.groupBy(group.alias("group")).agg(F.count("*").alias("total"), *[F.count(F.when(F.col(verdict) == v, 1)).alias(v) for v in ("ok", "warn", "bad")])
    return counts.withColumn("bad_share", F.col("bad") / F.greatest("total", F.lit(1)))


def length_band(c: Column, least: int, most: int) -> Column:
    return F.length(c).between(least, most)


def hold_out(df: DataFrame, composed: DataFrame, ipa: str = "ipa", key: str = "id", stress: str = "ˈˌ") -> DataFrame:
    """(outcome, n) of composed pronunciations against those that are known: uncovered, exact, stress (only its marks differ), differs."""
    truth = df.where(F.contains(F.trim("word"), F.lit(" ")) & present(F.col(ipa))).join(composed, key, "left")
    bare = lambda c: F.translate(c, stress, "")
    outcome = F.when(F.col("composed").isNull(), "uncovered").when(F.col("composed") == F.col(ipa), "exact").when(bare(F.col("composed")) == bare(F.col(ipa)), "stress").otherwise("differs")
    return truth.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


def pool_from_files(spark: object, path: str, schema: str, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows of a pool's JSON-lines files, each key once, by its last line, without those that are done."""
    from lexigrid.sources.readers import read_log

    return read_log(spark, path, schema, key).join(done.select(key).distinct(), key, "left_anti")


def noun_variants(c: Column) -> Column:
    """A JSON list of a noun's paradigms as (g, gen, pl, note); items without a gender are left out, and what is no JSON gives none."""
    kind = "array<struct<g:string,gen:string,pl:string,note:string>>"
    return F.filter(F.coalesce(F.from_json(c, kind), F.array().cast(kind)), lambda x: present(x["g"]))
