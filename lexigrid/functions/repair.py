"""Repairs of pronunciations, each with the conditions under which it may be made; null where it may not."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrid.functions.ipa import TIE, _paired, without
from lexigrid.functions.text import ending_stem

VOWELS = dict(x.split("=") for x in "ɐ=a ɑ=a ɒ=o ɔ=o ə=e ɛ=e ɪ=i ʊ=u".split())


def changed(new: Column, old: Column) -> Column:
    """new, where it differs from old; null elsewhere."""
    return F.when(new != old, new)


def x_as_ks(word: Column, ipa: Column) -> Column:
    """Each spelt x sounds ks, at the beginning s; only if there are as many as the sounds. Made twice, it changes nothing more."""
    spelt = F.regexp_count(F.lower(word), F.lit("x+"))
    sounds = F.regexp_count(ipa, F.lit("[ɡk]s"))
    first = F.lower(word).startswith("x") & ipa.rlike("^[ˈˌ]*ɡs")
    whole = F.replace(F.when(first, F.regexp_replace(ipa, "^([ˈˌ]*)ɡs", "$1s")).otherwise(ipa), F.lit("ɡs"), F.lit("ks"))
    return F.when((spelt > 0) & (spelt == sounds) & F.contains(ipa, F.lit("ɡs")), whole)


def foreign_consonants(word: Column, ipa: Column) -> Column:
    """Sounds that Spanish lacks: z as θ or s by the spelling, ʒ as ʝ, a spelt y as ʝ between vowels and as i elsewhere."""
    z = F.when(F.contains(F.lower(word), F.lit("z")), F.replace(ipa, F.lit("z"), F.lit("θ"))).otherwise(F.replace(ipa, F.lit("z"), F.lit("s")))
    zh = F.regexp_replace(z, "d?ʒ", "ʝ")
    return changed(F.replace(F.regexp_replace(zh, "(?<=[uoiea])y(?=[uoiea])", "ʝ"), F.lit("y"), F.lit("i")), ipa)


def foreign_vowels(ipa: Column) -> Column:
    """Vowels as one of five."""
    return changed(F.translate(ipa, "".join(VOWELS), "".join(VOWELS.values())), ipa)


def narrow_marks(ipa: Column) -> Column:
    return changed(without(ipa, "".join(chr(0x300 + x) for x in (0x1F, 0x25, 0x29, 0x2A, 0x2F, 0x3A))), ipa)


def stress_only(word: Column, ipa: Column, by_rule: Column, authority: Column) -> Column:
    """The rule's form for words with an accent, where only the stress differs and no authority says what is there now."""
    bare = lambda c: without(c, "ˈˌ.")
    rule = F.regexp_replace(by_rule, "^/|/$", "")
    own = word.rlike("[áéíóú]") & ~F.coalesce(authority == ipa, F.lit(False))
    return F.when(own & (bare(rule) == bare(ipa)) & (rule != ipa), rule)


_STRESSED = "ˈ([^aeiouɛɔ]*)([eɛoɔ])"


def stressed_vowel(ipa: Column) -> Column:
    """(onset, class, open) of a stressed e or o; null for other vowels or without a mark."""
    nucleus = F.regexp_extract(ipa, _STRESSED, 2)
    onset = without(F.regexp_extract(ipa, _STRESSED, 1), f"{TIE}ː.ˌ ")
    return F.when(nucleus != "", F.struct(onset.alias("onset"), F.translate(nucleus, "ɛɔ", "eo").alias("kind"), nucleus.isin("ɛ", "ɔ").alias("open")))


def opened(ipa: Column) -> Column:
    return F.when(ipa.rlike("ˈ[^aeiouɛɔ]*e"), F.regexp_replace(ipa, "ˈ([^aeiouɛɔ]*)e", "ˈ$1ɛ")).otherwise(F.regexp_replace(ipa, "ˈ([^aeiouɛɔ]*)o", "ˈ$1ɔ"))


def inherited_opening(form: Column, form_ipa: Column, base: Column, base_ipa: Column) -> Column:
    """An Italian form's stressed vowel opened as its base's is, if they differ in the final vowels only and agree in onset and vowel.

    Only closed becomes open: the rules take open vowels for closed ones, never the other way round.
    """
    f, b = stressed_vowel(form_ipa), stressed_vowel(base_ipa)
    fits = (ending_stem(F.lower(form)) == ending_stem(F.lower(base))) & (f["onset"] == b["onset"]) & (f["kind"] == b["kind"]) & b["open"] & ~f["open"]
    return F.when(fits, opened(form_ipa))


_ACCENTS = {("a", ""): "à", ("i", ""): "ì", ("u", ""): "ù", ("e", "ɛ"): "è", ("e", "e"): "é", ("o", "ɔ"): "ò", ("o", "o"): "ó"}


def accented(word: str | None, ipa: str | None) -> str | None:
    """An Italian spelling with the accent where a pronunciation has the stress; None if their vowels don't match one to one."""
    if not word or not ipa or "ˈ" not in ipa:
        return None
    vowels = [(m.start(), m.group()) for m in re.finditer("[aeiouɛɔ]", ipa)]
    places = [i for i, c in enumerate(word.lower()) if c in "aeiou"]
    stressed = next((k for k, (at, _) in enumerate(vowels) if at > ipa.index("ˈ")), None)
    if stressed is None or len(vowels) != len(places):
        return None
    at, sound = places[stressed], vowels[stressed][1]
    letter = word[at].lower()
    sign = _ACCENTS.get((letter, sound if letter in "eo" else ""))
    return None if sign is None else word[:at] + sign + word[at + 1 :]


def with_accent(word: Column, ipa: Column) -> Column:
    return _paired(accented)(word, ipa)


_GRAMMAR = frozenset(
    "a al adjetivo con como de del e el ella en enclítico femenino futuro gerundio imperativo indicativo infinitivo la las lo los masculino nombre o para participio persona plural por presente pretérito "
    "primera pronombre que segunda singular subjuntivo sustantivo tercera tiempo tú u un una usted verbo vos y él".split()
)


def pointed_bases(gloss: str) -> list[str]:
    """The words that a Spanish gloss points to: after each `de` or `del` the first word that is no word of grammar."""
    words, out = re.findall(r"[´ˊ́’'\w-]+", gloss), []
    for i, w in enumerate(words):
        if w.lower() in ("de", "del"):
            for after in words[i + 1 :]:
                if after.lower() in ("de", "del"):
                    break
                if after.lower() not in _GRAMMAR:
                    if after not in out:
                        out.append(after)
                    break
    return out


def bases_of_gloss(gloss: Column) -> Column:
    import pyarrow as pa

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else pointed_bases(t) for t in texts.to_pylist()], pa.list_(pa.string()))

    return F.arrow_udf(run, T.ArrayType(T.StringType()))(gloss)


def dual_filled(br: Column, pt: Column, offered_br: Column, offered_pt: Column) -> tuple[Column, Column]:
    """Two regions' pronunciations, each filled by itself and only with slashed offers."""
    one = lambda own, new: F.when(F.trim(F.coalesce(own, F.lit(""))) != "", own).when(new.startswith("/"), new).otherwise(own)
    return one(br, offered_br), one(pt, offered_pt)
