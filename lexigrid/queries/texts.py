"""Text, notation and pronunciation expressions over the tables' words and texts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.functions import ipa, repair, text
from lexigrid.operators import classify, sampling, stats
from lexigrid.plans import editions
from lexigrid.queries.registry import Tables, query, trimmed_lines


@query(
    """SELECT p_partkey, lower(replace(replace('Ä' || p_name || 'ß', 'Ä', 'ae'), 'ß', 'ss')) AS german_key, p_name AS shown, regexp_replace(p_name, '[aeiou]+$', '') AS stem,
CASE WHEN p_size % 2 = 0 THEN p_name END AS valid, CASE WHEN p_size * 1001 < 1024 THEN (p_size * 1001)::VARCHAR || ' B' ELSE printf('%.1f KB', p_size * 1001 / 1024.0) END AS size,
p_name LIKE '%red%' AND p_name NOT LIKE '%ring' AS liked, p_size % 3 > 0 AS every, length(p_name) BETWEEN 9 AND 11 AS band FROM part"""
)
def word_forms(t: Tables) -> DataFrame:
    """Keys, shown forms, stems, valid forms, sizes and pattern predicates of words."""
    name, size = F.col("p_name"), F.col("p_size")
    return t.part.select(
        "p_partkey", text.search_key(F.concat(F.lit("Ä"), name, F.lit("ß")), "de").alias("german_key"), text.display_form(F.initcap(name), F.array(name, F.initcap(name))).alias("shown"), text.ending_stem(name).alias("stem"),
        text.valid_form(F.when(size % 2 == 0, name).otherwise(F.concat(name, F.lit("7")))).alias("valid"), text.human_size(size * 1001).alias("size"), text.any_like(name, ["%red%"], ["%ring"]).alias("liked"),
        text.every_line(F.concat(name, F.when(size % 3 == 0, F.lit("\n7")).otherwise("\nx")), "^[a-z]").alias("every"), editions.length_band(name, 9, 11).alias("band"),
    )


@query(
    """SELECT doc_id, regexp_replace(trim(regexp_replace(replace(replace(text, chr(8203), ''), chr(65279), ''), '\\s+', ' ', 'g'), ' '), '^[;,；，。\\s]+|[;,；，\\s]+$', '', 'g') AS clean, len(regexp_extract_all(text, '[A-Za-z]')) AS letters FROM (SELECT doc_id, regexp_replace(text, '\\[[0-9]+\\]', '', 'g') AS text FROM documents)"""
)
def clean_texts(t: Tables) -> DataFrame:
    """Texts without artefacts and runs of blanks; the whole table."""
    return t.documents.select("doc_id", text.clean_gloss(F.col("text")).alias("clean"), F.regexp_count(F.regexp_replace("text", r"\[[0-9]+\]", ""), F.lit("[A-Za-z]")).alias("letters"))


_SIGNS = "w AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS word FROM documents)"


def _words(t: Tables) -> DataFrame:
    """The distinct words of the documents."""
    return t.documents.select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-zÀ-ÿ]+"), F.lit(0))).alias("word")).distinct()


@query(
    f"""WITH {_SIGNS} SELECT word, trim(translate(replace(replace('/' || replace(word, 'e', 'ɛ.') || '/', '.', ''), '/', ''), 'ðβɣŋ', 'dbɡn')) AS es, trim(replace(word, 'e', 'ɛ')) AS pt, replace(word, 'a', '') AS bare,
CASE WHEN contains(word, 'th') THEN replace(replace(word, 'th', 'θ'), 'θ', 's') END AS latam, translate(word, 'ɛɔɐɑ', 'eoaa') AS vowels, trim(replace(word, 'g', 'ɡ')) AS en, replace(lower(word), 'g', 'ɡ') AS triage FROM w"""
)
def sound_notation(t: Tables) -> DataFrame:
    """Normal forms of pronunciations, over every word of the documents as if it were one."""
    w = F.col("word")
    marked = F.concat(F.lit("/"), F.replace(w, F.lit("e"), F.lit("ɛ.")), F.lit("/"))
    th = F.replace(w, F.lit("th"), F.lit("θ"))
    return _words(t).select(
        "word", F.regexp_replace(ipa.spanish_shown(marked), "/", "").alias("es"), ipa.portuguese_shown(marked).alias("pt"), ipa.without(w, "a").alias("bare"), ipa.latin_american(th).alias("latam"),
        F.coalesce(repair.foreign_vowels(w), w).alias("vowels"), ipa.english_stored(w).alias("en"), ipa.triage_key(w).alias("triage"),
    )


@query(
    f"""WITH {_SIGNS} SELECT word, array_to_string(list_distinct_in_order, '') AS outside FROM (SELECT word, list_filter(list_transform(range(1, length(word) + 1), lambda i: CASE WHEN strpos('abcdefghijklmnopqrstuvwxyz', word[i]) = 0 AND strpos(word[1:i - 1], word[i]) = 0 THEN word[i] ELSE '' END), lambda x: x <> '') AS list_distinct_in_order FROM w)"""
)
def foreign_signs(t: Tables) -> DataFrame:
    """The signs of each word that an inventory lacks."""
    return _words(t).select("word", F.array_join(ipa.outside(F.col("word"), "abcdefghijklmnopqrstuvwxyz"), "").alias("outside"))


@query(
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'exact' WHEN 1 THEN 'notation' WHEN 2 THEN 'stress' WHEN 3 THEN 'openness' ELSE 'different' END AS kind,
CASE WHEN o_orderkey % 5 = 2 THEN 1 WHEN o_orderkey % 5 = 4 THEN 2 ELSE 2 END AS vowel FROM orders"""
)
def sound_agreement(t: Tables) -> DataFrame:
    """How a made pronunciation agrees with an attested one, and which vowel bears its stress."""
    k = (F.col("o_orderkey") % 5 + 1).cast("int")
    found = F.element_at(F.array(*map(F.lit, ["ˈkasa", "ˈka.sa", "kaˈsa", "ˈkɛsa", "ˈpero"])), k)
    truth = F.element_at(F.array(*map(F.lit, ["ˈkasa", "ˈkasa", "ˈkasa", "ˈkesa", "ˈkasa"])), k)
    return t.orders.select("o_orderkey", ipa.agreement(found, truth).alias("kind"), ipa.stressed_vowel(found).alias("vowel"))


@query("SELECT o_orderstatus, count(*) AS n, count(*) FILTER (o_orderkey % 3 = 0) / count(*) AS exact, count(*) FILTER (o_orderkey % 3 = 1) / count(*) AS stress, count(*) FILTER (o_orderkey % 3 = 2) / count(*) AS none, 0.0::DOUBLE AS notation, 0.0::DOUBLE AS openness, 0.0::DOUBLE AS different FROM orders GROUP BY 1")
def agreement_rates(t: Tables) -> DataFrame:
    k = F.col("o_orderkey") % 3
    d = t.orders.select("o_orderstatus", F.when(k == 0, "ˈkasa").when(k == 1, "kaˈsa").alias("found"), F.lit("ˈkasa").alias("truth"))
    return sampling.agreement_rates(d, "found", "truth", ["o_orderstatus"])


@query(
    """SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'ˈeksito' END AS ks, 'ˈθapato' AS consonants, CASE WHEN p_size % 3 = 0 THEN 'kaˈfe' END AS stress, CASE WHEN p_size % 4 = 0 THEN 'ˈtɛsta' END AS opening, CASE WHEN p_size % 5 = 0 THEN '/br/' ELSE 'own' END AS br FROM part"""
)
def sound_repairs(t: Tables) -> DataFrame:
    """Repairs, each made only under its conditions."""
    size = F.col("p_size")
    br, _ = repair.dual_filled(F.when(size % 5 == 0, "").otherwise("own"), F.lit(""), F.lit("/br/"), F.lit("pt"))
    return t.part.select(
        "p_partkey", repair.x_as_ks(F.when(size % 2 == 0, "éxito").otherwise("éxxito x"), F.lit("ˈeɡsito")).alias("ks"), repair.foreign_consonants(F.lit("zapato"), F.lit("ˈzapato")).alias("consonants"),
        repair.stress_only(F.when(size % 3 == 0, "café").otherwise("cafe"), F.lit("ˈkafe"), F.lit("/kaˈfe/"), F.lit(None).cast("string")).alias("stress"),
        repair.inherited_opening(F.lit("teste"), F.lit("ˈtesta"), F.lit("testa"), F.when(size % 4 == 0, "ˈtɛsta").otherwise("ˈtesta")).alias("opening"), br.alias("br"),
    )


@query(
    """SELECT event_id, '{"k": ' || json_extract_string(props, '$.k') || '}' AS repaired, CASE WHEN event_id % 3 = 0 THEN 'a' ELSE 'b' END AS near, CASE WHEN event_type = 'purchase' THEN 2.0 ELSE 1.0 END * (value + 1) * 1.5 / 1e6 * CASE WHEN hour(ts) >= 9 AND hour(ts) < 18 THEN 2 ELSE 1 END AS cost FROM events"""
)
def reply_parsing(t: Tables) -> DataFrame:
    """JSON cut out of chatty replies, spelling neighbours, and costs with peak hours."""
    reply = F.concat(F.lit("Sure! ```json\n"), F.regexp_replace("props", r"\}$", ",}"), F.lit("\n``` done"))
    near = F.when(text.edit_neighbours(F.lit("click"), F.when(F.col("event_id") % 3 == 0, "clcik").otherwise("view")), "a").otherwise("b")
    factor = F.when(F.col("event_type") == "purchase", 2.0).otherwise(1.0)
    return t.events.select("event_id", text.repair_json(reply).alias("repaired"), near.alias("near"), stats.cost(factor * (F.col("value") + 1), F.lit(0), F.col("ts"), 1.5, 3.0).alias("cost"))


@query(
    """SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'x' ELSE 'plain' END AS label, p_name || 'e' AS stem2, CASE WHEN p_size % 2 = 0 THEN 'x has it' WHEN p_size % 3 = 0 THEN 'def' ELSE '' END AS brief, p_size % 2 = 0 AS meaning, CASE WHEN p_size % 2 = 0 THEN 2 ELSE 0 END AS paradigms FROM part"""
)
def small_notations(t: Tables) -> DataFrame:
    """Labels of codes, stems of degrees, briefs, what is left of a text without noise, paradigms in JSON."""
    size, name = F.col("p_size"), F.col("p_name")
    code = F.when(size % 4 == 0, "k").otherwise("plain")
    variants = F.when(size % 2 == 0, F.lit('[{"g":"m","pl":"a"},{"g":"f"},{"pl":"x"}]')).otherwise("no json")
    return t.part.select(
        "p_partkey", F.element_at(text.labels_of(F.array(code), {"k": "x"}), 1).alias("label"), F.element_at(text.degree_stems(F.concat(name, F.lit("er"))), 2).alias("stem2"),
        text.brief(F.when(size % 2 == 0, F.lit(" \n x has it \n y")), F.when(size % 3 == 0, F.lit("def\nz"))).alias("brief"), text.has_meaning(F.when(size % 2 == 0, "[网络] 环").otherwise("[网络]"), r"\[[^\]]*\]").alias("meaning"), F.size(editions.noun_variants(variants)).alias("paradigms"),
    )


@query("SELECT tag, count(*) AS n FROM (SELECT unnest([event_type, 'k' || user_id % 3]) AS tag FROM events) WHERE tag NOT IN ('view', 'click', 'k0') GROUP BY tag")
def unknown_tags(t: Tables) -> DataFrame:
    """Tags that no bag knows, counted."""
    d = t.events.select(F.array("event_type", F.concat(F.lit("k"), F.col("user_id") % 3)).alias("tags"))
    return stats.unknown_tags(d, "tags", ["view", "click", "k0"])


@query("SELECT lang AS level, CASE WHEN n_chars > 1000 THEN 'ok' ELSE 'bad' END AS verdict, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY lang) AS share FROM documents GROUP BY 1, 2")
def verdict_shares(t: Tables) -> DataFrame:
    d = t.documents.select(F.col("lang").alias("level"), F.when(F.col("n_chars") > 1000, "ok").otherwise("bad").alias("verdict"))
    return stats.verdicts(d, "verdict", "level")


@query(
    """SELECT count(*) AS total, 0::BIGINT AS no_word, count(*) FILTER (p_size % 7 = 0) AS no_key, count(*) FILTER (p_size % 2 = 0 AND p_size % 3 = 0) AS lemma_no_translation, count(*) FILTER (p_size % 2 = 1 AND p_size % 5 > 0) AS form_no_base,
count(*) FILTER (p_size % 3 > 0 AND p_size % 4 = 0) AS misaligned, count(*) FILTER (p_size % 11 = 0) AS bad_meta, 0::BIGINT AS no_ipa, count(*) FILTER (p_size = 1) AS flagged, count(*) FILTER (p_size % 5 = 0) AS self_base FROM part"""
)
def structural_audit(t: Tables) -> DataFrame:
    """Counters of what a finished table must not have."""
    size, name = F.col("p_size"), F.col("p_name")
    d = t.part.select(
        name.alias("word"), F.when(size % 7 > 0, name).alias("word_norm"), (size % 2 == 0).cast("int").alias("is_lemma"), F.when(size % 3 > 0, F.lit("a\nb")).alias("translation"), F.when(size % 4 == 0, F.lit("a")).otherwise(F.lit("a\nb")).alias("definition"),
        F.when(size % 5 == 0, F.concat(F.lit("0:"), name)).alias("exchange"), F.when(size % 11 == 0, F.lit("{broken")).otherwise(F.lit("[]")).alias("meta"), F.lit("/x/").alias("ipa"), F.when(size == 1, F.lit("?")).alias("flag"),
    )
    return stats.structural_audit(d, ["translation", "definition"], "meta", "ipa")


@query(f"SELECT doc_id, len({trimmed_lines('text')}) AS n, coalesce(string_agg(x, '|' ORDER BY i), '') AS first FROM (SELECT doc_id, text, unnest(range(1, 3)) AS i, {trimmed_lines('text')}[i] AS x FROM documents) GROUP BY doc_id, text")
def leading_lines(t: Tables) -> DataFrame:
    """How many lines a text has, and its first two."""
    own = text.lines(F.col("text"))
    return t.documents.select("doc_id", F.size(own).cast("long").alias("n"), F.array_join(F.slice(own, 1, 2), "|").alias("first"))


_VERBAL = {0: ("cats", "cat", "复数", "n"), 1: ("running", "run", "现在分词", "v"), 2: ("FBIs", "FBI", "复数", "n"), 3: ("went", "go", "过去式", "n"), 4: ("a b", "a b", "复数", "n")}


@query("SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN 'C' WHEN 3 THEN 'F' ELSE 'DEG' END AS flags FROM orders")
def base_guards(t: Tables) -> DataFrame:
    """Why a form's text shouldn't be taken from its base."""
    k = (F.col("o_orderkey") % 5 + 1).cast("int")
    form, base, label, pos = (F.element_at(F.array(*[F.lit(_VERBAL[i][j]) for i in range(5)]), k) for j in range(4))
    return t.orders.select("o_orderkey", F.array_join(classify.guard_flags(base, F.lit("n. 猫"), pos, form, label), "").alias("flags"))
