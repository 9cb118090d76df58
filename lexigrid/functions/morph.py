"""What an entry says about its word's grammar: gender, plural, auxiliary, conjugation and so on, for five languages.

Entries are rows of `sources.entries.SCHEMA`. Everything is a JVM expression; each language has one function from an entry's columns to
named columns, each null where the entry is silent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOUNS = ("noun", "name", "proper noun")
LETTERS = {"es": "A-Za-zÁÉÍÓÚÜÑáéíóúüñ", "it": "A-Za-zÀÈÉÌÍÒÓÙàèéìíòóù", "fr": "A-Za-zÀ-ÖØ-öø-ÿŒœ", "pt": "A-Za-zÀ-ÖØ-öø-ÿ", "de": "A-Za-zÀ-ÖØ-öø-ÿß"}
PERSONS = [f"{n}-person" for n in ("first", "second", "third")]
NO_FORM = ["inflection-template", "table-tags"]


def _strings(*xs: str) -> Column:
    return F.array(*map(F.lit, xs)) if xs else F.array().cast("array<string>")


def tags_of(x: Column) -> Column:
    return F.coalesce(x["tags"], F.array().cast("array<string>"))


def has(tags: Column, *wanted: str) -> Column:
    """Whether all wanted tags are there."""
    return F.size(F.array_except(_strings(*wanted), tags)) == 0


def any_of(tags: Column, *some: str) -> Column:
    return F.arrays_overlap(tags, _strings(*some))


def first_match(c: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def head(templates: Column, name: str) -> Column:
    """The expansion of the first head template of that name."""
    return F.try_element_at(F.filter(templates, lambda h: h["name"] == name), F.lit(1))["expansion"]


def form_by_tags(forms: Column, lang: str, want: list[str], without: list[str] = (), skip: list[str] = NO_FORM) -> Column:
    """The first form with all of want and none of without that is written in the language's letters."""
    letters = LETTERS[lang]
    good = F.filter(forms, lambda f: has(tags_of(f), *want) & ~any_of(tags_of(f), *skip, *without) & F.trim(f["form"]).rlike(f"^[{letters}][{letters}'’ -]*$"))
    return F.trim(F.try_element_at(good, F.lit(1))["form"])


def sense_has(senses: Column, *tags: str) -> Column:
    return F.coalesce(F.exists(senses, lambda s: any_of(tags_of(s), *tags)), F.lit(False))


COMMON = ("by-personal-gender", "common", "gender-neutral")


def both_genders(feminine: Column, masculine: Column, common: Column) -> Column:
    return F.when(common | (feminine & masculine), "mf").when(feminine, "f").when(masculine, "m")


def gender_of_senses(senses: Column) -> Column:
    return both_genders(sense_has(senses, "feminine"), sense_has(senses, "masculine"), sense_has(senses, *COMMON))


def gender_of_meta(meta: Column) -> Column:
    """A word's gender from its senses': mf if any is, or if they differ."""
    own = F.array_distinct(F.filter(F.transform(meta, lambda m: m["g"]), lambda g: g.isNotNull() & (g != "")))
    return F.when(F.size(own) == 0, F.lit(None)).when(F.array_contains(own, "mf") | (F.size(own) > 1), "mf").otherwise(F.try_element_at(own, F.lit(1)))


def transitivity(senses: Column) -> Column:
    t, i = sense_has(senses, "transitive", "ambitransitive"), sense_has(senses, "intransitive", "ambitransitive")
    return F.when(t & i, "ti").when(t, "t").when(i, "i")


def irregular(form: Column, *regular: Column) -> Column:
    """form, unless it is one of the regular ones, case aside."""
    plain = F.lit(False)
    for r in regular:
        plain = plain | (F.lower(form) == F.lower(r))
    return F.when(~plain, form)


def _mapped(c: Column, table: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), c)


def _is(pos: Column, *names: str) -> Column:
    return pos.isin(*names)


def _after_word(expansion: Column, word: Column) -> Column:
    """The marks between the word and the first bracket."""
    before = F.substring_index(expansion, "(", 1)
    return F.when(F.startswith(before, word), F.substring(before, F.length(word) + 1, F.length(before))).otherwise(before)


def _marks(text: Column, *allowed: str) -> Column:
    return F.array_distinct(F.filter(F.split(text, r"[\s,]+"), lambda t: t.isin(*allowed)))


STEM_CHANGES = [x.split(">") for x in "e>ie o>ue u>ue e>i i>ie".split()]
_ES_COMPARATIVE = dict(x.split("=") for x in "alto=superior bajo=inferior bien=mejor bueno=mejor grande=mayor mal=peor malo=peor mucho=más pequeño=menor poco=menos".split())
_ES_INFINITIVE = "^(.*?)([aei]r|ír)(?:se)?$"


def stem_change(infinitive: Column, third_person: Column) -> Column:
    """How the last vowel of the stem differs in the third person: e→ie and the like."""
    stem = F.regexp_extract(infinitive, _ES_INFINITIVE, 1)
    present = F.regexp_replace(third_person, ".$", "")
    case = F.when(~infinitive.rlike(_ES_INFINITIVE) | (F.length(third_person) < 2) | (present == stem), F.lit(None).cast("string"))
    for old, new in STEM_CHANGES:
        changed = F.regexp_replace(stem, f"{old}([^{old}]*)$", f"{new}$1")
        case = case.when((changed != stem) & (changed == present), f"{old}→{new}")
    return case


def _labelled(expansion: Column, label: str, lang: str) -> Column:
    letters = LETTERS[lang]
    return first_match(expansion, f"{label} ([{letters}][{letters}'’-]*)")


def _feminine_of(expansion: Column, lang: str) -> Column:
    """The word after `feminine` where that isn't `feminine plural`."""
    letters = LETTERS[lang]
    return first_match(expansion, f"feminine (?!plural\\b)([{letters}][{letters}'’-]*)")


def spanish() -> dict[str, Column]:
    word, pos, forms, senses, heads = (F.col(c) for c in ("word", "pos", "forms", "senses", "head_templates"))
    noun = head(heads, "es-noun")
    marks = _marks(_after_word(noun, word), "m", "f", "mf")
    gender = F.when(F.array_contains(marks, "mf") | F.array_contains(marks, "f") & F.array_contains(marks, "m"), "mf").otherwise(F.try_element_at(marks, F.lit(1)))
    plural = _labelled(noun, "plural", "es")
    plural = F.when(~F.lower(plural).isin("invariable", "none", "only", "singular"), irregular(plural, F.concat(word, F.lit("s"))))
    third = form_by_tags(forms, "es", ["indicative", "present", "third-person", "singular"])
    participle = form_by_tags(forms, "es", ["past", "participle"], ["plural", "feminine"])
    stem = F.regexp_extract(word, _ES_INFINITIVE, 1)
    regular = F.concat(stem, F.when(F.regexp_extract(word, _ES_INFINITIVE, 2) == "ar", "ado").otherwise("ido"))
    adjective = F.coalesce(_feminine_of(head(heads, "es-adj"), "es"), form_by_tags(forms, "es", ["feminine", "singular"], ["plural"]), form_by_tags(forms, "es", ["feminine"], ["plural"]))
    is_noun, is_verb, is_adj = _is(pos, "noun", "name"), pos == "verb", pos == "adj"
    return {
        "gender": F.when(is_noun, gender),
        "plural": F.when(is_noun, plural),
        "feminine": F.when(is_noun, _feminine_of(noun, "es")).when(is_adj, adjective),
        "conjugation": F.when(is_verb, _mapped(first_match(word, _ES_INFINITIVE, 2), dict(x.split("=") for x in "ar=1 er=2 ir=3 ír=3".split()))),
        "stem_change": F.when(is_verb, stem_change(word, third)),
        "pp": F.when(is_verb, F.when(word.rlike(_ES_INFINITIVE), irregular(participle, regular)).otherwise(participle)),
        "transitivity": F.when(is_verb, transitivity(senses)),
        "comparative": _mapped(F.lower(word), _ES_COMPARATIVE),
    }


def italian() -> dict[str, Column]:
    word, pos, forms, senses, heads, categories = (F.col(c) for c in ("word", "pos", "forms", "senses", "head_templates", "categories"))
    expansions = F.lower(F.array_join(F.transform(heads, lambda h: F.coalesce(h["expansion"], F.lit(""))), "\n"))
    names = F.concat(F.coalesce(categories, F.array().cast("array<string>")), F.flatten(F.transform(senses, lambda s: F.transform(F.coalesce(s["categories"], F.filter(s["categories"], lambda c: F.lit(False))), lambda c: c["name"]))))
    verbs = "(?:avere|essere)"
    said = F.array_join(F.regexp_extract_all(F.translate(expansions, "éè", "ee"), F.lit(rf"auxiliary\s+({verbs}(?:\s+or\s+{verbs})?)"), F.lit(1)), " ")
    avere = F.contains(said, F.lit("avere")) | F.coalesce(F.array_contains(names, "taking avere as auxiliary"), F.lit(False))
    essere = F.contains(said, F.lit("essere")) | F.coalesce(F.array_contains(names, "taking essere as auxiliary"), F.lit(False))
    isc = F.coalesce(F.exists(heads, lambda h: F.coalesce(F.contains(F.element_at(h["args"], "1"), F.lit("isc")), F.lit(False))), F.lit(False))
    gender = gender_of_senses(senses)
    ok = lambda f: f.rlike(f"^[{LETTERS['it']}](?:[{LETTERS['it']}'’ ]*[{LETTERS['it']}])$")
    specs = F.flatten(
        F.transform(
            F.filter(heads, lambda h: h["name"] == "it-noun"),
            lambda h: F.flatten(F.transform(F.array_sort(F.filter(F.map_keys(h["args"]), lambda k: k.rlike("^([2-9]|[1-9][0-9]+)$"))), lambda k: F.split(F.trim(F.element_at(h["args"], k)), ","))),
        )
    )
    listed = F.filter(F.transform(specs, lambda s: F.struct(F.trim(F.regexp_replace(s, "<.*$", "")).alias("form"), F.nullif(F.regexp_extract(s, "<g:([mf])", 1), F.lit("")).alias("g"))), lambda p: ok(p["form"]))
    formed = F.transform(F.filter(forms, lambda f: F.array_contains(tags_of(f), "plural") & ~F.array_contains(tags_of(f), "singular") & ok(F.trim(f["form"]))), lambda f: F.struct(F.trim(f["form"]).alias("form"), F.when(F.array_contains(tags_of(f), "feminine"), "f").when(F.array_contains(tags_of(f), "masculine"), "m").alias("g")))
    crossed = lambda a: F.try_element_at(F.filter(a, lambda p: p["g"].isNotNull() & gender.isNotNull() & (p["g"] != gender)), F.lit(1))
    is_noun, is_verb = _is(pos, "noun", "name"), pos == "verb"
    number = F.try_element_at(F.flatten(F.transform(senses, lambda s: F.array_intersect(tags_of(s), _strings(*NUMBERS, "singular-only")))), F.lit(1))
    return {
        "aux": F.when(is_verb, F.when(avere & essere, "both").when(avere, "avere").when(essere, "essere")),
        "conj": F.when(is_verb, F.when(word.endswith("are"), "1").when(word.endswith("ire"), F.when(isc, "3isc").otherwise("3")).when(word.rlike("(e|r)re$"), "2")),
        "transitivity": F.when(is_verb, transitivity(senses)),
        "pronominal": F.when(is_verb & (word.rlike("[aei]rsi$") | sense_has(senses, "reflexive", "pronominal")), 1),
        "gender": F.when(is_noun, gender),
        "plural": F.when(is_noun, F.coalesce(crossed(listed)["form"], F.try_element_at(listed, F.lit(1))["form"], F.try_element_at(formed, F.lit(1))["form"])),
        "plural_gender": F.when(is_noun, F.coalesce(crossed(listed)["g"], crossed(formed)["g"])),
        "number_note": F.when(is_noun, number),
    }


def _gender_of_args(heads: Column, common: tuple[str, ...]) -> tuple[Column, Column, Column]:
    values = F.flatten(F.transform(heads, lambda h: F.transform(_strings(*"1 2 g g2".split()), lambda k: F.lower(F.trim(F.coalesce(F.element_at(h["args"], k), F.lit("")))))))
    some = lambda *xs: F.coalesce(F.arrays_overlap(values, _strings(*xs)), F.lit(False))
    return some("f", "f-p"), some("m", "m-p"), some(*common)


def _noun_gender(heads: Column, senses: Column, common: tuple[str, ...]) -> Column:
    f, m, c = _gender_of_args(heads, common)
    return both_genders(f | sense_has(senses, "feminine"), m | sense_has(senses, "masculine"), c | sense_has(senses, *COMMON))


def french() -> dict[str, Column]:
    word, pos, forms, senses, heads = (F.col(c) for c in ("word", "pos", "forms", "senses", "head_templates"))
    junk = [*NO_FORM, "multiword-construction"]
    built = lambda aux: F.coalesce(F.exists(forms, lambda f: F.trim(f["form"]).startswith(f"{aux} + ")), F.lit(False))
    avoir, etre = built("avoir"), built("être")
    presents = F.filter(forms, lambda f: ~F.array_contains(tags_of(f), "multiword-construction") & (has(tags_of(f), "participle", "present") | (tags_of(f) == _strings("gerund"))) & (F.trim(f["form"]) != ""))
    present = F.lower(F.trim(F.try_element_at(presents, F.lit(1))["form"]))
    low = F.lower(word)
    plural = F.coalesce(form_by_tags(forms, "fr", ["plural"], ["feminine", "masculine"], junk), form_by_tags(forms, "fr", ["plural"], [], junk))
    expansions = F.lower(F.array_join(F.transform(heads, lambda h: F.coalesce(h["expansion"], F.lit(""))), "\n"))
    invariable = F.coalesce(F.exists(heads, lambda h: F.coalesce(F.trim(F.element_at(h["args"], "inv")).isin("1", "yes"), F.lit(False))), F.lit(False)) | expansions.rlike(r"\((plural )?invariable\)") | sense_has(senses, "invariable")
    is_noun, is_verb, is_adj = _is(pos, "noun", "name"), pos == "verb", pos == "adj"
    return {
        "aux": F.when(is_verb, F.when(avoir & etre, "both").when(avoir, "avoir").when(etre, "être")),
        "vgroup": F.when(is_verb, F.when(low == "aller", "3").when(F.coalesce(present.endswith("issant"), F.lit(False)), "2").when(low.endswith("er"), "1").when(low.rlike("(ir|re)$"), "3")),
        "transitivity": F.when(is_verb, transitivity(senses)),
        "pronominal": F.when(is_verb & (low.rlike("^(se |s['’])") | sense_has(senses, "reflexive", "pronominal")), 1),
        "pp": F.when(is_verb, form_by_tags(forms, "fr", ["past", "participle"], ["feminine", "plural"], ["multiword-construction"])),
        "gender": F.when(is_noun, _noun_gender(heads, senses, ("?", "mf", "mfbysense"))),
        "plural": F.when(is_noun | is_adj, irregular(plural, F.concat(word, F.lit("s")), word)),
        "feminine": F.when(is_adj, form_by_tags(forms, "fr", ["feminine"], ["plural"], junk)),
        "invariable": F.when((is_noun | is_adj) & invariable, 1),
        "comparative": _mapped(low, dict(x.split("=") for x in "bien=mieux bon=meilleur mal=pis mauvais=pire petit=moindre".split())),
    }


def portuguese() -> dict[str, Column]:
    word, pos, forms, senses, heads = (F.col(c) for c in ("word", "pos", "forms", "senses", "head_templates"))
    low = F.lower(word)
    expansions = F.array_join(F.transform(heads, lambda h: F.coalesce(h["expansion"], F.lit(""))), "\n")
    plural = F.coalesce(form_by_tags(forms, "pt", ["plural"], ["feminine", "masculine"]), form_by_tags(forms, "pt", ["plural"]))
    is_noun, is_verb, is_adj = _is(pos, "noun", "name"), pos == "verb", pos == "adj"
    return {
        "vconj": F.when(is_verb, F.when(low.endswith("ar"), "1").when(low.endswith("er"), "2").when(low.endswith("ir"), "3").when(low.rlike("[oô]r$"), "por")),
        "transitivity": F.when(is_verb, transitivity(senses)),
        "pronominal": F.when(is_verb & (low.endswith("-se") | sense_has(senses, "reflexive", "pronominal")), 1),
        "pp": F.when(is_verb, F.coalesce(_labelled(expansions, "past participle", "pt"), form_by_tags(forms, "pt", ["past", "participle"], ["feminine", "plural", "short-form"], []))),
        "pp_short": F.when(is_verb, form_by_tags(forms, "pt", ["past", "participle", "short-form"], ["feminine", "plural"], [])),
        "gender": F.when(is_noun, _noun_gender(heads, senses, ("?", "m or f", "mf", "mfbysense"))),
        "plural": F.when(is_noun | is_adj, irregular(plural, F.concat(word, F.lit("s")), word)),
        "feminine": F.when(is_noun | is_adj, form_by_tags(forms, "pt", ["feminine"], ["plural"])),
        "comparative": _mapped(low, dict(x.split("=") for x in "bem=melhor bom=melhor grande=maior mal=pior mau=pior pequeno=menor".split())),
    }


_DE_DEGREES = dict(x.split("=") for x in "bald=eher,ehesten gern=lieber,liebsten gerne=lieber,liebsten groß=größer,größten gut=besser,besten hoch=höher,höchsten nah=näher,nächsten nahe=näher,nächsten viel=mehr,meisten".split())


def german() -> dict[str, Column]:
    word, pos, forms, senses, heads = (F.col(c) for c in ("word", "pos", "forms", "senses", "head_templates"))
    noun, verb, adj = (head(heads, f"de-{x}") for x in ("noun", "verb", "adj"))
    said = F.array_join(_marks(_after_word(noun, word), "m", "f", "n"), "/")
    by_senses = F.array_join(F.array_compact(F.array(*[F.when(sense_has(senses, t), g) for t, g in (("masculine", "m"), ("feminine", "f"), ("neuter", "n"))])), "/")
    auxiliary = F.regexp_extract(verb, r"auxiliary ([^)]+)", 1)
    haben, sein = F.contains(auxiliary, F.lit("haben")), F.contains(auxiliary, F.lit("sein"))
    kinds = "strong|weak|mixed"
    numbered = F.regexp_extract(verb, rf"class (\d+)\s+({kinds})", 2)
    vclass = F.when(numbered != "", F.concat(numbered, F.lit("-"), F.regexp_extract(verb, rf"class (\d+)\s+({kinds})", 1))).otherwise(first_match(verb, rf"\b({kinds}|irregular)\b"))
    split_form = F.filter(forms, lambda f: ~F.array_contains(tags_of(f), "multiword-construction") & has(tags_of(f), "present", "indicative") & any_of(tags_of(f), *PERSONS) & F.contains(F.trim(f["form"]), F.lit(" ")))
    prefix = F.substring_index(F.trim(F.try_element_at(split_form, F.lit(1))["form"]), " ", -1)
    known = F.split(_mapped(F.lower(word), _DE_DEGREES), ",")
    letters = LETTERS["de"]
    superlative = first_match(adj, f"superlative (am [{letters}][{letters}-]*|[{letters}][{letters}-]*)")
    is_noun, is_verb, is_adj = _is(pos, "noun", "name"), pos == "verb", _is(pos, "adj", "adv")
    return {
        "gender": F.when(is_noun, F.coalesce(F.nullif(said, F.lit("")), F.nullif(by_senses, F.lit("")))),
        "genitive": F.when(is_noun, _labelled(noun, "genitive", "de")),
        "plural": F.when(is_noun, _labelled(noun, "plural", "de")),
        "aux": F.when(is_verb, F.when(haben & sein, "both").when(haben, "haben").when(sein, "sein")),
        "praeteritum": F.when(is_verb, _labelled(verb, "past tense", "de")),
        "partizip2": F.when(is_verb, _labelled(verb, "past participle", "de")),
        "vclass": F.when(is_verb, vclass),
        "sep_prefix": F.when(is_verb, prefix),
        "separable": F.when(is_verb & prefix.isNotNull(), 1),
        "reflexive": F.when(is_verb & (F.lower(word).startswith("sich ") | sense_has(senses, "reflexive")), 1),
        "comparative": F.when(is_adj, F.coalesce(F.try_element_at(known, F.lit(1)), _labelled(adj, "comparative", "de"))),
        "superlative": F.when(is_adj, F.coalesce(F.concat(F.lit("am "), F.try_element_at(known, F.lit(2))), superlative)),
    }


ESSENCE = {"es": spanish, "it": italian, "fr": french, "pt": portuguese, "de": german}

POS = dict(x.split("=") for x in "adj=adj adv=adv article=art conj=conj contraction=contr det=det intj=intj name=name noun=n num=num phrase=phr prefix=pref prep=prep pron=pron proverb=prov suffix=suf verb=v".split())


def short_pos(pos: Column) -> Column:
    return F.coalesce(_mapped(pos, POS), pos)


#: Bags of tags. What is in none of them, nor composes to a label, is reported by `unknown_tags`.
REGIONS = (
    "Andalusia Antilles Aragon Argentina Asturias Australia Austria Belgium Bolivia Brazil Canada Canary-Islands Caribbean Catalonia Central Central-America Chile Colombia Costa-Rica Cuba "
    "Dominican-Republic Eastern Ecuador El-Salvador European France Galicia Germany Guatemala Honduras Iberian Italy Latin-America Lunfardo Mexico Navarre Nicaragua North-America Northern "
    "Panama Paraguay Peru Philippines Portugal Puerto-Rico Quebec Rioplatense South-America Southern Spain Switzerland Tuscany UK US Uruguay Valencia Venezuela Western"
).split()
REGISTERS = (
    "Internet archaic childish colloquial dated derogatory dialectal emphatic endearing euphemistic familiar figuratively formal historical humorous informal ironic jargon literary misspelling "
    "neologism nonstandard obsolete offensive pejorative poetic proscribed rare regional sarcastic slang slur uncommon vulgar"
).split()
NUMBERS = "collective invariable plural-only uncountable".split()


def sense_meta(sense: Column, pos: Column, common: bool = True) -> Column:
    """(pos, g, num, reg, lex) of a sense; tags keep the source's order. Only nouns have g and num."""
    tags = tags_of(sense)
    feminine, masculine = F.array_contains(tags, "feminine"), F.array_contains(tags, "masculine")
    g = both_genders(feminine, masculine, any_of(tags, *COMMON)) if common else F.when(feminine & ~masculine, "f").when(masculine & ~feminine, "m")
    noun = pos.isin(*NOUNS)
    kept = lambda bag: F.filter(tags, lambda t: t.isin(*bag))
    return F.struct(
        short_pos(pos).alias("pos"),
        F.when(noun, F.coalesce(g, F.when(F.array_contains(tags, "neuter"), "n"))).alias("g"),
        F.when(noun, kept(NUMBERS)).otherwise(F.array().cast("array<string>")).alias("num"),
        kept(REGIONS).alias("reg"),
        kept(REGISTERS).alias("lex"),
    )


_POINTING = (
    r"(?i)(only used in|inflection of|syntactic variant|combined with|\b(accusative|conditional|dative|gerund|imperative|imperfect|indicative|infinitive|participle|"
    r"plural|preterite|singular|subjunctive|(first|second|third)[- ]person)\b.{0,30}\bof\b)"
)
ABBREVIATIONS = ("abbreviation", "acronym", "initialism")


def points(sense: Column) -> Column:
    """Whether a sense only says which form of another word this is."""
    linked = (F.size(F.coalesce(sense["form_of"], sense["alt_of"])) > 0) | (F.size(sense["alt_of"]) > 0)
    return F.coalesce(linked, F.lit(False)) | F.coalesce(F.try_element_at(sense["glosses"], F.lit(1)).rlike(_POINTING), F.lit(False))


def base_of(sense: Column) -> Column:
    """The word that a sense points to: that of its link, else the last word of `... of x`."""
    linked = F.coalesce(F.try_element_at(sense["form_of"], F.lit(1))["word"], F.try_element_at(sense["alt_of"], F.lit(1))["word"])
    linked = F.trim(F.regexp_replace(linked, r"(?i)\s+combined with.*$", ""))
    prose = F.regexp_extract(F.trim(F.try_element_at(sense["glosses"], F.lit(1))), r"(?i)\bof\s+([a-záéíñóúü]+)\s*$", 1)
    return F.coalesce(F.nullif(linked, F.lit("")), F.nullif(prose, F.lit("")))
