"""Spelling to sound for Spanish, Italian and German.

A language is an ordered list of letter rules: (regular expression at the current place, what it sounds like). Sounds are written as
blank-separated marks: a vowel is `V:` and its sound, with `*` if its letter bears a stress mark and `~` if it is weak; a glide is `G:`.
What the letters can't tell (stress, syllables, voicing at borders) is done over the list of sounds. A word with a letter that no rule
knows has no transcription.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from itertools import pairwise

from pyspark.sql import Column

from lexigrid.functions.text import string_udf

SOFT_G = "ɡ"


@dataclass
class Sound:
    text: str
    kind: str = "C"  # C, V (nucleus), G (glide), F (falling part of a diphthong)
    marked: bool = False
    weak: bool = False
    long: bool = False
    letter: str = ""


def _sound(mark: str, letter: str) -> Sound:
    if mark[:2] in ("V:", "G:"):
        body = mark[2:]
        return Sound(body.rstrip("*~"), mark[0], "*" in body, "~" in body, letter=letter)
    return Sound(mark)


class Speller:
    """rules are tried in order at each place; an empty right side is silence."""

    def __init__(self, rules: list[tuple[str, str]]):
        self.rules = [(re.compile(p), s.split()) for p, s in rules]

    def sounds(self, word: str) -> list[Sound] | None:
        out: list[Sound] = []
        at = 0
        while at < len(word):
            for pattern, marks in self.rules:
                m = pattern.match(word, at)
                if m and m.end() > at:
                    out += [_sound(mark, m.group()) for mark in marks]
                    at = m.end()
                    break
            else:
                return None
        return out


# Spanish

_ES_V = "aeiouáéíóúü"
_ES = Speller(
    [
        *[(a, f"V:{b}*") for a, b in zip("áéíóú", "aeiou", strict=True)],
        ("i", "V:i~"),
        ("[uü]", "V:u~"),
        *[(v, f"V:{v}") for v in "aeo"],
        ("ch", "t͡ʃ"),
        ("c(?=[eiéí])", "θ"),
        ("qu(?=[eiéí])|[ckq]", "k"),
        ("g(?=[eiéí])", "x"),
        ("gu(?=[eiéí])", SOFT_G),
        ("gü(?=[eiéí])|gu(?=[aoáó])", f"{SOFT_G} G:w"),
        ("g", SOFT_G),
        (f"ll|y(?=[{_ES_V}])", "ʝ"),
        ("y", "V:i~"),
        ("rr", "r"),
        ("r", "ɾ"),
        (f"hu(?=[{_ES_V}])", f"G:w{chr(0x31D)}"),
        ("h", ""),
        ("[bv]", "b"),
        ("j", "x"),
        ("ñ", "ɲ"),
        ("z", "θ"),
        ("x", "k s"),
        *[(c, c) for c in "dflmnpstw"],
    ]
)
_ES_ONSETS = {"tɾ", "dɾ", *[p + q for q in ("ɾ", "l") for p in f"kfbp{SOFT_G}"]}


def _es_diphthongs(sounds: list[Sound]) -> None:
    """Of a run of vowels the strong and the marked ones are nuclei, or else the last; weak ones before a nucleus glide into it."""
    at = 0
    while at < len(sounds):
        if sounds[at].kind != "V":
            at += 1
            continue
        end = at
        while end < len(sounds) and sounds[end].kind == "V":
            end += 1
        run = sounds[at:end]
        nuclei = [i for i, s in enumerate(run) if s.marked or not s.weak] or [len(run) - 1]
        for i, s in enumerate(run):
            if i not in nuclei:
                if i < nuclei[-1]:
                    s.text, s.kind = {"i": "j"}.get(s.text, "w"), "G"
                else:
                    s.kind = "F"
        at = end


def _es_borders(sounds: list[Sound]) -> None:
    for s, after in zip(sounds, sounds[1:], strict=False):
        if s.kind == after.kind == "C":
            if s.text == "n" and after.text in "bmp":
                s.text = "m"
            elif s.text in "ptk" and s.text + after.text not in _ES_ONSETS:
                s.text = dict(zip("ptk", "bd" + SOFT_G, strict=True))[s.text]


def _with_stress(sounds: list[Sound], starts: list[int], stressed: int, dot: str = "") -> str:
    """The syllables that begin at starts, the one that holds the stressed sound marked."""
    out = []
    for a, b in zip(starts, [*starts[1:], len(sounds)], strict=True):
        out.append(("ˈ" if a <= stressed < b else dot if a else "") + "".join(s.text for s in sounds[a:b]))
    return "".join(out)


def spanish(word: str) -> str | None:
    word = unicodedata.normalize("NFC", word or "").lower()
    sounds = _ES.sounds(word) if word else None
    if not sounds or not any(s.kind == "V" for s in sounds):
        return None
    for i, s in enumerate(sounds):
        if s.text == "ɾ" and (i == 0 or sounds[i - 1].text in ("n", "l", "s")):
            s.text = "r"
    _es_diphthongs(sounds)
    nuclei = [i for i, s in enumerate(sounds) if s.kind == "V"]
    marked = [i for i in nuclei if sounds[i].marked]
    plain_end = unicodedata.normalize("NFD", word[-1])[0] in "aeiouns" and word[-1] != "ñ"
    stressed = marked[0] if marked else nuclei[-2] if len(nuclei) > 1 and plain_end else nuclei[-1]
    _es_borders(sounds)
    starts = [0]
    for a, b in pairwise(nuclei):
        consonants = [i for i in range(a + 1, b) if sounds[i].kind == "C"]
        start = consonants[-1] if consonants else b
        if len(consonants) > 1 and sounds[consonants[-2]].text + sounds[start].text in _ES_ONSETS:
            start = consonants[-2]
        while start - 1 > a and sounds[start - 1].kind == "G":
            start -= 1
        starts.append(start)
    return f"/{_with_stress(sounds, starts, stressed)}/"


# Italian

_IT_V = "aeiouàèéìíòóùú"
_FRONT = "eièéìí"
_IT_MARKED = [("à", "a"), ("è", "ɛ"), ("é", "e"), ("[ìí]", "i"), ("ò", "ɔ"), ("ó", "o"), ("[ùú]", "u")]
_IT = Speller(
    [
        *[(p, f"V:{s}*") for p, s in _IT_MARKED],
        *[(v, f"V:{v}") for v in "aeo"],
        ("i", "V:i~"),
        ("u", "V:u~"),
        ("ch", "k"),
        (f"c(?=c(?:[{_FRONT}]))", "t͡ʃ"),
        (f"ci(?=[{_IT_V}])|c(?=[{_FRONT}])", "t͡ʃ"),
        ("c", "k"),
        ("gh", SOFT_G),
        (f"g(?=g(?:[{_FRONT}]))", "d͡ʒ"),
        (f"gli(?=[{_IT_V}])|gl(?=i)", "ʎ"),
        ("gn", "ɲ"),
        (f"gi(?=[{_IT_V}])|g(?=[{_FRONT}])", "d͡ʒ"),
        ("g", SOFT_G),
        ("sch", "s k"),
        (f"sc[iìí](?=[{_IT_V}])", "ʃ"),
        (f"sc(?=[{_FRONT}])", "ʃ"),
        ("s(?=[bdglmnrvz])", "z"),
        ("s", "s"),
        (r"(?<!.)z", "d͡z"),
        ("z", "t͡s"),
        ("qu", "k G:w"),
        ("q", "k"),
        ("h", ""),
        ("x", "ks"),
        ("y", "i"),
        *[(c, c) for c in "bdfjklmnprtvw"],
    ]
)
_HALF = {x: x[0] for x in "d͡z d͡ʒ t͡s t͡ʃ".split()}
_LONG = "d͡z t͡s ʃ ɲ ʎ".split()


def _it_glides(word: str, sounds: list[Sound]) -> list[Sound]:
    """Unmarked i and u glide before a vowel letter and after a vowel; s between vowels is voiced; some consonants are long there."""
    for i, s in enumerate(sounds):
        if s.kind == "V" and s.weak and ((i + 1 < len(sounds) and sounds[i + 1].kind == "V") or (i and sounds[i - 1].kind == "V")):
            s.text, s.kind = "j" if s.text == "i" else "w", "G"
    return sounds


def _it_lengths(sounds: list[Sound]) -> list[Sound]:
    out: list[Sound] = []
    for i, s in enumerate(sounds):
        out.append(s)
        vowels = 0 < i < len(sounds) - 1 and sounds[i - 1].kind == "V" == sounds[i + 1].kind
        if vowels and s.text in _LONG:
            out.append(Sound(s.text))
    for s, after in zip(out, out[1:], strict=False):
        if s.text in _HALF and s.text == after.text:
            s.text = _HALF[s.text]
    return out


def italian(word: str) -> str | None:
    word = re.sub("[' -]", "", (word or "").lower())
    sounds = _IT.sounds(word) if word else None
    if not sounds or not any(s.kind == "V" for s in sounds):
        return None
    sounds = _it_glides(word, sounds)
    for i, s in enumerate(sounds):
        if s.text == "s" and 0 < i < len(sounds) - 1 and sounds[i - 1].kind in "VG" and sounds[i + 1].kind in "VG" and sounds[i + 1].letter[:1] in _IT_V:
            s.text = "z"
    sounds = _it_lengths(sounds)
    nuclei = [i for i, s in enumerate(sounds) if s.kind == "V"]
    marked = [i for i in nuclei if sounds[i].marked]
    stressed = marked[0] if marked else nuclei[-2] if len(nuclei) > 1 else nuclei[0]
    starts = [0]
    for a, b in pairwise(nuclei):
        between = b - a - 1
        whole = between == 2 and (sounds[a + 2].kind == "G" or (sounds[a + 1].text in f"bdfkpt{SOFT_G}" and sounds[a + 2].text in ("r", "l")))
        starts.append(a + 1 if between < 2 or whole else a + 2)
    return f"/{_with_stress(sounds, starts, stressed, '.')}/"


# German

_DE_V = "aeiouyäöü"
_DE_LONG_SHORT = {"a": "aːa", "e": "eːɛ", "i": "iːɪ", "o": "oːɔ", "u": "uːʊ", "y": "yːʏ", "ä": "ɛːɛ", "ö": "øːœ", "ü": "yːʏ"}
_DE_PREFIXES = "emp ent ver zer be er ge".split()
_DE_SHORT = set("ab als am an ans bin bis das den des es hab hat hin im in ins ist man mit ob um und vom von was weg wen zum zur".split())
_DE_DIPHTHONGS = [("ei|ey|ai|ay", "aɪ"), ("eu|äu", "ɔʏ"), ("au", "aʊ")]


def _de_vowels() -> list[tuple[str, str]]:
    rules = [("ig(?!.)", "V:ɪ ç"), *[(p, f"V:{s}=") for p, s in _DE_DIPHTHONGS], ("ie", "V:iː=")]
    rules += [(f"{v}{v}", f"V:{_DE_LONG_SHORT[v][:2]}=") for v in "aeou"]
    rules += [("e(?!.)", "V:ə")]
    for v, both in _DE_LONG_SHORT.items():
        # before h (which falls silent), before a vowel, at the end and before one consonant but x it is long
        rules += [(f"{v}h|{v}(?=[{_DE_V}])|{v}(?!.)|{v}(?=[^{_DE_V}x](?:[{_DE_V}]|(?!.)))", f"V:{both[:2]}="), (v, f"V:{both[2:]}")]
    return rules


_DE = Speller(
    [
        *_de_vowels(),
        ("sch", "ʃ"),
        ("tsch", "tʃ"),
        ("ch", "ç"),
        ("ck", "k"),
        ("ph", "f"),
        ("qu", "k v"),
        ("dt|th", "t"),
        ("ng", "ŋ"),
        ("nk", "ŋ k"),
        ("pf", "p f"),
        ("ss|ß", "s"),
        ("tz|z", "ts"),
        *[(c + c, {"g": SOFT_G, "r": "ʁ"}.get(c, c)) for c in "bdfgklmnprt"],
        ("st", "s+ t"),
        ("sp", "s+ p"),
        (f"s(?=[{_DE_V}])", "z"),
        ("s", "s"),
        ("v", "f"),
        ("w", "v"),
        ("r", "ʁ"),
        ("g", SOFT_G),
        ("c(?=[eiyäö])", "ts"),
        ("c", "k"),
        ("x", "k s"),
        *[(c, c) for c in "bdfhjklmnpt"],
    ]
)


def german(word: str) -> str | None:
    word = (word or "").strip().lower()
    prefix = next((len(p) for p in _DE_PREFIXES if word.startswith(p) and len(word) - len(p) > 3), 0)
    sounds = _DE.sounds(word) if word else None
    if not sounds:
        return None
    vowel = ""
    for s in sounds:
        s.long = s.text.endswith("=")
        s.text = s.text.rstrip("=")
    letters = _de_places(word)
    for s, at in zip(sounds, letters, strict=True):
        if s.text == "s+":
            s.text = "ʃ" if at in (0, prefix) else "s"
        elif s.text == "ç" and s.kind == "C" and word[at : at + 2] == "ch" and vowel in "a au o u".split():
            s.text = "x"
        if s.kind == "V":
            m = s.letter
            vowel = m if m in ("ei", "ey", "ai", "ay", "eu", "äu", "au") else m[:1]
    nuclei = [i for i, s in enumerate(sounds) if s.kind == "V"]
    stressed = None if not nuclei else nuclei[1] if prefix and len(nuclei) > 1 else nuclei[0]
    if not nuclei:
        return None
    for i in nuclei:
        s = sounds[i]
        first = s.letter[:1]
        if word in _DE_SHORT and s.long:
            diphthong = s.letter in ("ei", "ey", "ai", "ay", "eu", "äu", "au")
            s.text, s.long = (s.text if diphthong else _DE_LONG_SHORT[first][2:]), False
        if i != stressed and first == "e" and s.letter not in ("ei", "ey", "eu"):
            s.text, s.long = "ə", False
    for s in reversed(sounds):
        if s.kind == "V":
            break
        s.text = dict(zip(f"bdvz{SOFT_G}", "ptfsk", strict=True)).get(s.text, s.text)
    starts = []
    for n, (before, own) in enumerate(zip([-1, *nuclei], nuclei, strict=False)):
        between = own - before - 1
        starts.append(own if not between else before + 1 if n == 0 else own - 1)
    text = "".join(s.text for s in sounds[: starts[0]])
    for a, b, own in zip(starts, [*starts[1:], len(sounds)], nuclei, strict=True):
        text += ("ˈ" if own == stressed and text else "." if text else "") + "".join(s.text for s in sounds[a:b])
    text = text if "ˈ" in text else "ˈ" + text
    text = re.sub("əʁ(?![^.ˈ])", "ɐ", text).replace("ɐ.", "ɐ")
    return f"/{text}/"


def _de_places(word: str) -> list[int]:
    """The place of the letters that each sound came from."""
    out, at = [], 0
    while at < len(word):
        for pattern, marks in _DE.rules:
            m = pattern.match(word, at)
            if m and m.end() > at:
                out += [at] * len(marks)
                at = m.end()
                break
    return out


SPELLERS = {"es": spanish, "it": italian, "de": german}


def to_ipa(word: Column, lang: str) -> Column:
    """The transcription of a spelling, in slashes; null where the rules don't reach."""
    return string_udf(SPELLERS[lang])(word)
