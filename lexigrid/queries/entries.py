"""Source entries, made of the tables' rows: read, folded, built into dictionaries, taken in, governed and undone."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.functions import ipa, labels, morph
from lexigrid.operators import govern, merge, reconcile
from lexigrid.plans import build, editions
from lexigrid.queries.registry import Tables, query
from lexigrid.sources import readers, sinks

_POS = {"SMALL": "verb", "LARGE": "adj", "PROMO": "name"}
_WORD = "CASE WHEN p_size % 3 = 0 THEN upper(p_name || ' ' || p_partkey % 5) ELSE p_name || ' ' || p_partkey % 5 END"
_SHORT = "CASE p_type WHEN 'SMALL' THEN 'v' WHEN 'LARGE' THEN 'adj' WHEN 'PROMO' THEN 'name' ELSE 'n' END"
_LONG = "CASE p_type WHEN 'SMALL' THEN 'verb' WHEN 'LARGE' THEN 'adj' WHEN 'PROMO' THEN 'name' ELSE 'noun' END"
_FORM = "p_partkey % 7 = 0"


def _strings(*xs: Column | str) -> Column:
    return F.array(*[F.lit(x) if isinstance(x, str) else x for x in xs])


def _lines(t: Tables) -> DataFrame:
    """(p_partkey, value): a line of JSON for each part. The narrow rows are spread first: a file has few row groups, and each would be one task's."""
    size, key = F.col("p_size"), F.col("p_partkey")
    word = F.concat("p_name", F.lit(" "), key % 5)
    none = F.array().cast("array<string>")
    form = key % 7 == 0
    link = F.when(form, F.array(F.struct(F.concat(F.lit("base "), F.lower("p_type")).alias("word"))))
    sense = F.struct(
        F.array(F.concat("p_brand", F.lit("  "), F.lower("p_type"))).alias("glosses"),
        F.when(form, none).when(size % 3 == 0, _strings("feminine")).when(size % 3 == 1, _strings("masculine")).otherwise(none).alias("tags"),
        link.alias("form_of"),
    )
    sound = lambda text, *tags: F.struct(text.alias("ipa"), (_strings(*tags) if tags else none).alias("tags"))
    sounds = F.array(sound(F.concat(F.lit("["), "p_name", F.lit("]")), "UK"), sound(F.concat(F.lit("/"), F.lower("p_type"), F.lit("/, /x/")), *("US",)), sound(F.concat(F.lit("/"), "p_brand", F.lit("/"))))
    forms = F.array(F.struct(F.concat("p_name", F.lit("s")).alias("form"), _strings("plural").alias("tags")), F.struct(F.when(size % 2 == 0, F.concat("p_name", F.lit("ed"))).otherwise("").alias("form"), _strings("past", "participle").alias("tags")))
    entry = F.struct(
        F.when(size % 3 == 0, F.upper(word)).otherwise(word).alias("word"),
        F.when(key % 10 == 0, "xx").otherwise("es").alias("lang_code"),
        F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in _POS.items() for x in p]), F.col("p_type")), F.lit("noun")).alias("pos"),
        F.when(size % 4 == 0, "Forma verbal").otherwise("Sustantivo").alias("pos_title"),
        sounds.alias("sounds"), F.array(sense).alias("senses"), forms.alias("forms"),
    )
    parts = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size").repartition("p_partkey")
    return parts.select("p_partkey", F.to_json(entry).alias("value"))


def _entries(t: Tables) -> DataFrame:
    return _lines(t).select(F.col("p_partkey").alias("seq"), F.from_json("value", readers.ENTRY).alias("e")).select("seq", "e.*")


def _dumped(t: Tables) -> str:
    """The lines in a folder of files, every eleventh cut short."""
    path = sinks.shared_path(t.spark, "dump")
    _lines(t).select(F.when(F.col("p_partkey") % 11 == 0, F.substring("value", 1, 20)).otherwise(F.col("value")).alias("value")).write.text(path)
    return path


@query(
    f"""SELECT bad, pos, count(*) AS n, sum(senses)::BIGINT AS senses FROM (SELECT p_partkey % 11 = 0 AS bad, CASE WHEN p_partkey % 11 <> 0 THEN {_LONG} END AS pos, CASE WHEN p_partkey % 11 <> 0 THEN 1 END AS senses
FROM part WHERE p_partkey % 11 = 0 OR p_partkey % 10 <> 0) GROUP BY bad, pos"""
)
def entries_read(t: Tables) -> DataFrame:
    """JSON lines written and read again; lines cut short are counted as bad."""
    found = readers.read_entries(t.spark, _dumped(t), "es")
    return found.groupBy("bad", "pos").agg(F.count("*").alias("n"), F.sum(F.size("senses")).alias("senses"))


@query(f"SELECT lower({_WORD}) AS word, count(*) AS n FROM part WHERE p_partkey % 11 <> 0 AND p_partkey % 10 <> 0 AND p_name IN (SELECT p_name FROM part WHERE p_size < 5) AND lower({_WORD}) = p_name || ' 1' GROUP BY 1")
def entries_of_words(t: Tables) -> DataFrame:
    """The good entries whose word is among given ones: a semi join behind the reader."""
    wanted = t.part.where("p_size < 5").select(F.concat("p_name", F.lit(" 1")).alias("word"))
    found = readers.only_words(readers.good_entries(readers.read_entries(t.spark, _dumped(t), "es")), wanted)
    return found.groupBy(F.lower("word").alias("word")).agg(F.count("*").alias("n"))


_RECORDS = f"""e AS (SELECT p_partkey AS seq, lower({_WORD}) AS key, {_WORD} AS word, {_SHORT} AS pos, {_LONG} AS long, p_brand || ' ' || lower(p_type) AS gloss, {_FORM} AS form, 'base ' || lower(p_type) AS base, p_size FROM part),
g AS (SELECT key, CASE WHEN form THEN NULL ELSE gloss END AS gloss, CASE WHEN form THEN base END AS base, seq, p_size, form, long FROM e),
distinct_gloss AS (SELECT key, gloss, min(seq) AS s FROM g WHERE gloss IS NOT NULL GROUP BY key, gloss), distinct_base AS (SELECT key, base, min(seq) AS s FROM g WHERE base IS NOT NULL GROUP BY key, base),
f AS (SELECT key, min(seq) AS seq, CASE WHEN bool_or(word = key) THEN key ELSE arg_min(word, seq) END AS word, (SELECT string_agg(DISTINCT x.pos, '/' ORDER BY x.pos) FROM e x WHERE x.key = e.key) AS pos,
  coalesce((SELECT string_agg(d.gloss, chr(10) ORDER BY d.s) FROM distinct_gloss d WHERE d.key = e.key), '') AS glosses, coalesce((SELECT string_agg(d.base, chr(10) ORDER BY d.s) FROM distinct_base d WHERE d.key = e.key), '') AS bases,
  coalesce((SELECT string_agg(d.base || ' 的 变位形式', chr(10) ORDER BY d.s) FROM distinct_base d WHERE d.key = e.key), '') AS infl,
  bool_or(NOT form AND long IN ('noun', 'name') AND p_size % 3 = 0) AS fem, bool_or(NOT form AND long IN ('noun', 'name') AND p_size % 3 = 1) AS masc FROM e GROUP BY key)"""


@query(f"WITH {_RECORDS} SELECT key, word, pos, glosses, bases, infl, CASE WHEN fem AND masc THEN 'mf' WHEN fem THEN 'f' WHEN masc THEN 'm' END AS gender FROM f")
def folded_entries(t: Tables) -> DataFrame:
    """Many entries folded into one row for each word, in source order."""
    out = build.folded(_entries(t), build.LANGUAGES["it"])
    joined = lambda c: F.array_join(c, "\n").alias(c)
    return out.select("key", "word", "pos", joined("glosses"), joined("bases"), joined("infl"), "gender")


@query(
    f"""WITH {_RECORDS} SELECT row_number() OVER (ORDER BY seq, key) AS id, word, lower(word) AS word_norm, (glosses <> '' OR bases = '')::INTEGER AS is_lemma, nullif(glosses, '') AS definition,
CASE WHEN glosses = '' AND bases <> '' THEN infl END AS translation, CASE WHEN bases <> '' THEN '0:' || replace(bases, chr(10), chr(10) || '0:') END AS exchange FROM f"""
)
def dictionary_table(t: Tables) -> DataFrame:
    """The finished table: numbered in source order, lemmas told from forms."""
    return build.build(_entries(t), "it").select("id", "word", "word_norm", "is_lemma", "definition", "translation", "exchange")


@query(
    f"""WITH {_RECORDS}, known AS (SELECT DISTINCT lower(p_name || ' ' || p_partkey % 5) AS k FROM part WHERE p_size < 25),
new AS (SELECT *, CASE WHEN word = key THEN word ELSE word END AS w FROM f WHERE key NOT IN (SELECT k FROM known))
SELECT 10000 + row_number() OVER (ORDER BY word) AS id, word, pos, 'other-edition' AS source FROM new"""
)
def edition_intake(t: Tables) -> DataFrame:
    """What another edition has and the table lacks, numbered behind the table's own rows."""
    known = t.part.where("p_size < 25").select(F.concat("p_name", F.lit(" "), F.col("p_partkey") % 5).alias("word")).distinct()
    table = known.select(F.lit(10000).cast("long").alias("id"), "word", F.lower("word").alias("word_norm"))
    rows, _ = build.intake(table, _entries(t), "it", "other-edition")
    return rows.select("id", "word", "pos", "source")


@query(
    f"""WITH e AS (SELECT p_partkey AS seq, lower({_WORD}) AS key, {_WORD} AS word, {_SHORT} || ':100' AS pos, p_brand || '  ' || lower(p_type) AS definition, p_name AS uk, lower(p_type) AS us, p_name, p_size FROM part)
SELECT key, arg_min(word, seq) AS word, arg_min(definition, seq) AS definition, arg_min(uk, seq) AS phonetic_uk, arg_min(us, seq) AS phonetic_us, arg_min(pos, seq) AS pos,
arg_min('s:' || p_name || 's' || CASE WHEN p_size % 2 = 0 THEN '/d:' || p_name || 'ed' ELSE '' END, seq) AS exchange FROM e WHERE key NOT IN (SELECT p_name || ' 2' FROM part) GROUP BY key"""
)
def english_new_words(t: Tables) -> DataFrame:
    """New words of the English extract, with accents' pronunciations and coded forms."""
    return editions.english_new_words(_entries(t), t.part.select(F.concat("p_name", F.lit(" 2")).alias("word")))


@query(
    """WITH k AS (SELECT c_custkey AS i, lower(c_name) AS key FROM customer), e AS (SELECT i, key, i % 6 AS m, CASE i % 6 WHEN 0 THEN 'customer#000000001' WHEN 1 THEN 'cüstomer#000000002' WHEN 2 THEN 'two words' WHEN 3 THEN 'junk' WHEN 4 THEN 'unknown ' || i % 3 ELSE 'nobody' || i % 5 END AS base FROM k)
SELECT key, CASE m WHEN 0 THEN base WHEN 1 THEN 'customer#000000002' WHEN 2 THEN 'target' WHEN 3 THEN '' WHEN 4 THEN base ELSE base END AS bases FROM e WHERE NOT (m = 3 AND i % 2 = 0)
UNION ALL SELECT 'target', '' UNION ALL SELECT DISTINCT base, '' FROM e WHERE m = 5"""
)
def closed_bases(t: Tables) -> DataFrame:
    """No base is left dangling: kept, repointed, dropped as junk, respelt, or given a bare row."""
    i = F.col("c_custkey")
    base = F.when(i % 6 == 0, F.lit("customer#000000001")).when(i % 6 == 1, F.lit("cüstomer#000000002")).when(i % 6 == 2, F.lit("two words")).when(i % 6 == 3, F.lit("junk")).when(i % 6 == 4, F.concat(F.lit("unknown "), i % 3)).otherwise(F.concat(F.lit("nobody"), i % 5))
    none = F.array().cast("array<string>")
    glosses = F.when(i % 2 == 0, none).otherwise(F.array(F.lit("a gloss")))
    words = t.customer.select(F.lower("c_name").alias("key"), i.alias("seq"), F.lower("c_name").alias("word"), F.array(F.lower("c_name")).alias("spellings"), glosses.alias("glosses"), none.alias("infl"), F.array(base).alias("bases"))
    decided = t.spark.createDataFrame([("two words", "repoint", "target")], "base string, action string, target string")
    out, _ = build.closed(words, decided, ["junk"])
    return out.select("key", F.array_join("bases", "\n").alias("bases"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'checked' END AS flag, s_name FROM supplier")
def governed_update(t: Tables) -> DataFrame:
    """A first version, an update with what it declares, and one that is rejected: the second version stays."""
    store = sinks.Store(t.spark, sinks.shared_path(t.spark, "store"))
    first = t.supplier.select("s_suppkey", F.lit(None).cast("string").alias("flag"), "s_name")
    govern.Session(store, {govern.ROWS: None, "s_suppkey": None, "s_name": None}).apply(lambda _: first)
    changed = lambda d: d.withColumn("flag", F.when(F.col("s_suppkey") % 3 == 0, "checked"))
    govern.Session(store, {"flag": first.where("s_suppkey % 3 = 0").count()}).apply(changed)
    try:
        govern.Session(store, {}).apply(lambda d: d.where("s_suppkey > 0"))
    except govern.Rejected:
        pass
    return store.current()


@query("SELECT s_suppkey AS id, CASE WHEN s_suppkey % 4 = 0 THEN 'new' WHEN s_suppkey % 4 = 1 THEN 'later' ELSE s_name END AS v FROM supplier")
def ledger_undone(t: Tables) -> DataFrame:
    """Changes undone by a ledger, appended in two parts: what changed again later and what is blocked stays."""
    path = sinks.shared_path(t.spark, "ledger")
    base = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("v"))
    sinks.append_ledger(base.select("id", F.col("v").alias("before"), F.concat("v", F.lit("'")).alias("after"), F.lit(1).alias("step")), path)
    sinks.append_ledger(base.select("id", F.concat("v", F.lit("'")).alias("before"), F.lit("new").alias("after"), F.lit(2).alias("step")), path)
    now = base.withColumn("v", F.when(F.col("id") % 4 == 1, "later").otherwise("new"))
    return merge.reverted(now, t.spark.read.parquet(path), "v", blocked=base.where("id % 4 = 0").select("id"), order="step")


@query("SELECT p_partkey AS id, p_name || CASE WHEN p_partkey % 2 = 0 THEN '!' ELSE '' END AS v FROM part UNION ALL SELECT p_partkey + 1000000, NULL FROM part WHERE p_size = 1")
def updated_and_inserted(t: Tables) -> DataFrame:
    """Rows written by id, rows added with the columns they have."""
    df = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("v"))
    out = sinks.updated_by_id(df, df.where("id % 2 = 0").select("id", F.concat("v", F.lit("!")).alias("v")))
    return sinks.inserted(out, t.part.where("p_size = 1").select((F.col("p_partkey") + 1000000).alias("id")))


def _grammar(t: Tables, name: str, expansion: Column, pos: Column, forms: Column) -> DataFrame:
    """Entries whose word is the part's first word, with one head line and forms."""
    kind = readers.ENTRY
    entry = F.struct(F.substring_index("p_name", " ", 1).alias("word"), pos.alias("pos"), F.array(F.struct(F.lit(name).alias("name"), expansion.alias("expansion"))).alias("head_templates"), forms.alias("forms"), F.array(F.struct(F.array(F.lit("g")).alias("glosses"), F.when(F.col("p_size") % 2 == 0, _strings("transitive")).otherwise(_strings("intransitive")).alias("tags"))).alias("senses"))
    return t.part.select("p_partkey", F.from_json(F.to_json(entry), kind).alias("e")).select("p_partkey", "e.*")


_FIRST = "split_part(p_name, ' ', 1)"


def _form(text: Column, *tags: str) -> Column:
    return F.struct(text.alias("form"), _strings(*tags).alias("tags"))


@query(
    f"""SELECT p_partkey, CASE WHEN p_size % 3 > 0 THEN CASE p_size % 3 WHEN 1 THEN 'f' ELSE 'mf' END END AS gender, CASE WHEN p_size % 3 > 0 AND p_size % 2 = 0 THEN {_FIRST} || 'es' END AS plural,
CASE WHEN p_size % 3 = 0 THEN CASE WHEN p_size % 2 = 0 THEN 't' ELSE 'i' END END AS transitivity FROM part"""
)
def essence_spanish(t: Tables) -> DataFrame:
    """Gender and irregular plurals of nouns from the head line, transitivity of verbs from their senses."""
    w = F.substring_index("p_name", " ", 1)
    size = F.col("p_size")
    expansion = F.concat(w, F.when(size % 3 == 1, F.lit(" f")).otherwise(" m or f"), F.lit(" (plural "), w, F.when(size % 2 == 0, F.lit("es)")).otherwise("s)"))
    e = _grammar(t, "es-noun", expansion, F.when(size % 3 == 0, "verb").otherwise("noun"), F.array(_form(w, "x")))
    own = morph.spanish()
    return e.select("p_partkey", *[own[c].alias(c) for c in ("gender", "plural", "transitivity")])


@query(
    f"""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'both' ELSE 'avere' END AS aux, CASE WHEN p_size % 2 = 0 THEN 't' ELSE 'i' END AS transitivity FROM part"""
)
def essence_italian(t: Tables) -> DataFrame:
    """The auxiliary of verbs, from the head line."""
    w, size = F.substring_index("p_name", " ", 1), F.col("p_size")
    e = _grammar(t, "it-verb", F.concat(w, F.when(size % 2 == 0, F.lit(" (auxiliary avére or èssere)")).otherwise(" (auxiliary avére)")), F.lit("verb"), F.array(_form(w, "x")))
    own = morph.italian()
    return e.withColumn("categories", F.lit(None).cast("array<string>")).select("p_partkey", own["aux"].alias("aux"), own["transitivity"].alias("transitivity"))


@query(f"SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN {_FIRST} || 'x' END AS plural, CASE WHEN p_size % 3 = 0 THEN {_FIRST} || 'e' END AS feminine, CASE WHEN p_size % 5 = 0 THEN 1 END AS invariable FROM part")
def essence_french(t: Tables) -> DataFrame:
    """Irregular plurals, feminines of adjectives, invariable words."""
    w, size = F.substring_index("p_name", " ", 1), F.col("p_size")
    forms = F.array(_form(F.when(size % 2 == 0, F.concat(w, F.lit("x"))).otherwise(F.concat(w, F.lit("s"))), "plural"), _form(F.concat(w, F.lit("e")), "feminine"))
    e = _grammar(t, "fr-adj", F.concat(w, F.when(size % 5 == 0, F.lit(" (invariable)")).otherwise("")), F.when(size % 3 == 0, "adj").otherwise("noun"), forms)
    own = morph.french()
    return e.select("p_partkey", *[own[c].alias(c) for c in ("plural", "feminine", "invariable")])


@query(f"SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN {_FIRST} || 'ado' ELSE {_FIRST} || 'ido' END AS pp, {_FIRST} || 'to' AS pp_short, CASE WHEN p_size % 2 = 0 THEN 't' ELSE 'i' END AS transitivity FROM part")
def essence_portuguese(t: Tables) -> DataFrame:
    """Participles, long from the head line or the forms, short from the forms."""
    w, size = F.substring_index("p_name", " ", 1), F.col("p_size")
    forms = F.array(_form(F.concat(w, F.lit("ido")), "past", "participle"), _form(F.concat(w, F.lit("to")), "past", "participle", "short-form"))
    e = _grammar(t, "pt-verb", F.when(size % 2 == 0, F.concat(w, F.lit(" (past participle "), w, F.lit("ado)"))).otherwise(w), F.lit("verb"), forms)
    own = morph.portuguese()
    return e.select("p_partkey", *[own[c].alias(c) for c in ("pp", "pp_short", "transitivity")])


@query(
    f"""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'f' ELSE 'm' END AS gender, {_FIRST} || 'es' AS genitive, {_FIRST} || 'en' AS plural FROM part WHERE p_size % 3 > 0 UNION ALL SELECT p_partkey, NULL, NULL, NULL FROM part WHERE p_size % 3 = 0"""
)
def essence_german(t: Tables) -> DataFrame:
    """Gender, genitive and plural of nouns."""
    w, size = F.substring_index("p_name", " ", 1), F.col("p_size")
    expansion = F.concat(w, F.when(size % 2 == 0, F.lit(" f")).otherwise(" m"), F.lit(" (genitive "), w, F.lit("es, plural "), w, F.lit("en)"))
    e = _grammar(t, "de-noun", expansion, F.when(size % 3 == 0, "verb").otherwise("noun"), F.array(_form(w, "x")))
    own = morph.german()
    return e.select("p_partkey", *[own[c].alias(c) for c in ("gender", "genitive", "plural")])


@query(
    f"""SELECT p_partkey AS seq, {_FORM} AS points, CASE WHEN {_FORM} THEN 'base ' || lower(p_type) END AS base, p_size % 4 = 0 AS form_entry, {_FORM} AS form_sense, {_SHORT} AS pos,
CASE WHEN NOT ({_FORM}) AND {_LONG} IN ('noun', 'name') THEN CASE p_size % 3 WHEN 0 THEN 'f' WHEN 1 THEN 'm' END END AS g FROM part"""
)
def sense_notes(t: Tables) -> DataFrame:
    """Which senses point to a base, and the notes of each."""
    s = _entries(t).select("seq", "pos", "pos_title", F.element_at("senses", 1).alias("s"))
    meta = morph.sense_meta(F.col("s"), F.col("pos"))
    return s.select("seq", morph.points(F.col("s")).alias("points"), morph.base_of(F.col("s")).alias("base"), editions.form_entry(F.col("pos_title")).alias("form_entry"), editions.form_sense(F.col("s"), editions.form_entry(F.col("pos_title"))).alias("form_sense"), meta["pos"].alias("pos"), meta["g"].alias("g"))


@query(
    """SELECT p_partkey AS seq, p_name AS first, '/' || lower(p_type) || '/, /x/' AS picked, '/' || lower(p_type) || '/, /x/' AS us, 3 AS variants, p_brand AS plain, p_name AS uk FROM part"""
)
def source_sounds(t: Tables) -> DataFrame:
    """Pronunciations of a source's records: the first, the slashed one, a region's, the best of all variants."""
    c, v = F.col("sounds"), F.col("v")
    e = _entries(t).select("seq", "sounds", ipa.sounds_variants(c).alias("v"))
    return e.select("seq", ipa.first_variant(v).alias("first"), ipa.pick_ipa(c).alias("picked"), ipa.region_ipa(c, "US", ["UK"]).alias("us"), F.size(v).alias("variants"), ipa.best_variant(v, [], ["UK", "US"]).alias("plain"), ipa.best_variant(v, ["UK"], ["US"]).alias("uk"))


_TAGGED = ["indicative present first-person singular", "gerund", "subjunctive imperfect third-person singular", "participle past"]


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '陈述式·现在时·第一人称·单数' WHEN 1 THEN '副动词' WHEN 2 THEN '虚拟式·未完成过去时·第三人称·单数' ELSE '过去分词' END AS label FROM orders")
def order_labels(t: Tables) -> DataFrame:
    """Labels of inflected forms, from tags."""
    tags = F.element_at(F.array(*[F.array(*map(F.lit, x.split())) for x in _TAGGED]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return t.orders.select("o_orderkey", labels.compose(tags, "es").alias("label"))


_ENGLISH = ["plural of", "past tense of", "comparative form of", "a kind of"]


@query(
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 3 THEN NULL ELSE p_name END AS base, CASE p_partkey % 4 WHEN 0 THEN '复数' WHEN 1 THEN '过去式' WHEN 2 THEN '比较级' END AS label,
CASE p_partkey % 4 WHEN 0 THEN 'plural' WHEN 1 THEN '' WHEN 2 THEN 'comparative' ELSE '' END AS tags FROM part"""
)
def english_pointers(t: Tables) -> DataFrame:
    """Glosses that only point to another word, and the tags that they name."""
    gloss = F.concat(F.element_at(F.array(*map(F.lit, _ENGLISH)), (F.col("p_partkey") % 4 + 1).cast("int")), F.lit(" "), "p_name", F.lit("."))
    x = labels.english_form(gloss)
    return t.part.select("p_partkey", x["base"].alias("base"), x["label"].alias("label"), F.array_join(labels.tags_of_prose(gloss), ",").alias("tags"))


@query(
    f"""WITH s AS (SELECT p_partkey AS seq, lower({_WORD}) AS key, p_brand || '  ' || lower(p_type) AS gloss, CASE p_size % 3 WHEN 0 THEN 'f' WHEN 1 THEN 'm' END AS g FROM part WHERE NOT ({_FORM}) AND p_type NOT IN ('SMALL', 'LARGE') AND p_size % 3 < 2),
d AS (SELECT key FROM s GROUP BY key HAVING count(DISTINCT g) = 2) SELECT key, gloss, arg_min(g, seq) AS gender FROM s WHERE key IN (SELECT key FROM d) GROUP BY key, gloss"""
)
def dual_genders(t: Tables) -> DataFrame:
    """The senses of words that have both genders somewhere."""
    return build.dual_genders(_entries(t), build.LANGUAGES["it"])


@query(
    f"""WITH e AS (SELECT lower({_WORD}) AS word, p_name || 's' AS form, '/' || p_name || 's/' AS f, p_partkey FROM part) SELECT lower(form) AS word, arg_min(f, p_partkey) AS ipa FROM e GROUP BY 1"""
)
def harvested_forms(t: Tables) -> DataFrame:
    """The first pronunciation that any entry's list of forms gives a form."""
    forms = F.array(F.struct(F.concat("p_name", F.lit("s")).alias("form"), F.concat(F.lit("/"), "p_name", F.lit("s/")).alias("ipa"), F.array().cast("array<string>").alias("tags")), F.struct(F.col("p_name").alias("form"), F.lit(None).cast("string").alias("ipa"), F.array().cast("array<string>").alias("tags")))
    return reconcile.harvested_forms(t.part.select(F.col("p_partkey").alias("seq"), forms.alias("forms")))


@query("SELECT lower(strip_accents(w)) AS word_norm, arg_min(w, p_partkey) AS accented FROM (SELECT p_partkey, replace(p_name, 'e', CASE WHEN p_size % 2 = 0 THEN 'è' ELSE 'é' END) AS w FROM part) WHERE contains(w, 'è') OR contains(w, 'é') GROUP BY 1")
def harvested_accents(t: Tables) -> DataFrame:
    """Of the spellings with an accent the first for each key."""
    from lexigrid.functions.text import unaccent

    w = F.replace(F.col("p_name"), F.lit("e"), F.when(F.col("p_size") % 2 == 0, F.lit("è")).otherwise(F.lit("é")))
    return reconcile.harvested_accents(t.part.select(F.col("p_partkey").alias("seq"), w.alias("word"), F.array().cast("array<struct<form:string>>").alias("forms")), unaccent)
