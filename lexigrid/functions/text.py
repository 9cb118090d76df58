"""Text expressions: foldings, lines, patterns and the small notations that dictionary columns are written in.

Two foldings coexist: `ascii_fold` (letters of ASCII only, as look-ups compare) and `unaccent` (all marks gone, as search keys are made).
Everything is a JVM expression but the repair of JSON, and `unaccent` for the few signs that decompose into several.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HAN = r"[\u3400-\u4dbf\u4e00-\u9fff]"


def ascii_fold(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def strip_marks(text: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFD", text) if unicodedata.category(x) != "Mn").lower()


def _mapped(fn):
    def run(texts: pa.Array) -> pa.Array:
        known: dict[str, object] = {}
        return pa.array([None if t is None else known[t] if t in known else known.setdefault(t, fn(t)) for t in texts.to_pylist()], pa.string())

    return run


def string_udf(fn) -> object:
    """An Arrow UDF of a Python function from text to text or None; null stays null, repeated values of a batch are computed once."""
    return F.arrow_udf(_mapped(fn), T.StringType())


@lru_cache(1)
def _letters() -> tuple[str, str, str]:
    """The letters that lose a mark or case for one other sign, those signs, and a class of the letters that become several signs."""
    before, after, rest = [], [], []
    for code in [*range(0x80, 0xD800), *range(0xE000, 0x10000)]:
        sign = chr(code)
        new = strip_marks(sign)
        if len(new) == 1 and new != sign:
            before.append(sign)
            after.append(new)
        elif len(new) > 1:
            rest.append(code)
    spans: list[list[int]] = []
    for code in rest:
        if spans and spans[-1][1] == code - 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "".join(before), "".join(after), "[" + "".join(f"\\u{x:04X}-\\u{y:04X}" for x, y in spans) + r"\x{10000}-\x{10FFFF}]"


def unaccent(c: Column) -> Column:
    """Lower case without combining marks: letters by a table, marks by their class, both in the JVM.

    Only texts with signs that decompose into several (Korean syllables and the like) or lie beyond the basic plane go to Python.
    """
    before, after, several = _letters()
    plain = F.lower(F.regexp_replace(F.translate(c, before, after), r"\p{Mn}", ""))
    odd = c.rlike(several)
    return F.when(odd, string_udf(strip_marks)(F.when(odd, c))).otherwise(plain)


def search_key(c: Column, lang: str) -> Column:
    """The accent-free key that a language's look-ups search by; German writes its umlauts out first."""
    if lang == "de":
        for sign, letters in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"), ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue")):
            c = F.replace(c, F.lit(sign), F.lit(letters))
    return unaccent(c)


def blank(c: Column) -> Column:
    """Null, empty or only blanks."""
    return F.trim(F.coalesce(c.cast("string"), F.lit(""))) == ""


def present(c: Column) -> Column:
    return ~blank(c)


def like_prefix(c: Column, typed: str) -> Column:
    """c LIKE typed || '%' where % and _ of what was typed are live and a backslash is itself, letters of ASCII folded."""
    folded = typed.translate(str.maketrans(UPPER, LOWER))
    if not set("%_\\") & set(folded):
        return ascii_fold(c).startswith(folded)
    return ascii_fold(c).like(folded.replace("\\", "\\\\") + "%")


def key_range(c: Column, typed: str) -> Column:
    """The range that a prefix without wildcards allows for a folded key column: reaches Parquet's min and max."""
    if not typed or set("%_\\") & set(typed):
        return F.lit(True)
    return (c >= typed) & (c < typed + "\U0010ffff")


def any_like(c: Column, patterns: list[str], without: list[str] = ()) -> Column:
    """One of the LIKE patterns and none of the others."""
    hit = F.lit(False)
    for p in patterns:
        hit = hit | c.like(p.replace("\\", "\\\\"))
    for p in without:
        hit = hit & ~c.like(p.replace("\\", "\\\\"))
    return hit


def lines(c: Column, literal: bool = False) -> Column:
    """The trimmed lines that aren't empty; literal also cuts at a written backslash-n. Null has none."""
    parts = F.split(F.coalesce(c, F.lit("")), r"\\n|\n" if literal else "\n")
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def first_line(c: Column, literal: bool = False) -> Column:
    return F.try_element_at(lines(c, literal), F.lit(1))


def brief(translation: Column, definition: Column, literal: bool = False) -> Column:
    """The first line of the translation, else that of the definition, else nothing."""
    return F.coalesce(first_line(translation, literal), first_line(definition, literal), F.lit(""))


def line_count(c: Column) -> Column:
    return F.when(blank(c), 0).otherwise(F.size(F.split(c, "\n")))


def misaligned(*columns: Column) -> Column:
    """Whether those of the columns that aren't blank differ in their number of lines."""
    counts = F.filter(F.array(*[F.when(present(c), line_count(c)) for c in columns]), lambda n: n.isNotNull())
    return F.size(F.array_distinct(counts)) > 1


def base_forms(exchange: Column) -> Column:
    """The distinct bases of lines `code:base`, in order."""
    after = F.transform(lines(exchange), lambda x: F.trim(F.regexp_replace(x, r"^[^:]*:", "")))
    return F.array_distinct(F.filter(after, lambda x: x != ""))


def exchange_map(exchange: Column) -> Column:
    """`code:word/code:word` as a list of (code, word)."""
    parts = F.filter(F.split(F.coalesce(exchange, F.lit("")), "/"), lambda p: F.locate(":", p) > 1)
    return F.transform(parts, lambda p: F.struct(F.trim(F.substring_index(p, ":", 1)).alias("code"), F.trim(F.regexp_replace(p, r"^[^:]*:", "")).alias("word")))


def exchange_of(pairs: Column) -> Column:
    """The notation that `exchange_map` reads; pairs without a word are left out."""
    return F.array_join(F.transform(F.filter(pairs, lambda p: present(p["word"])), lambda p: F.concat(p["code"], F.lit(":"), p["word"])), "/")


def labelled_line(line: Column) -> Column:
    """A line `n. text` as (pos, text); without a label pos is null."""
    label = F.regexp_extract(line, r"^([a-z]{1,6}\.)\s*(.*)$", 1)
    return F.struct(F.when(label != "", label).alias("pos"), F.when(label != "", F.regexp_extract(line, r"^([a-z]{1,6}\.)\s*(.*)$", 2)).otherwise(line).alias("text"))


def collocation(line: Column) -> Column:
    """`foreign text 中文` as (text, zh), cut before the first blank that Han follows."""
    pattern = rf"^(.*?)\s+({HAN}.*)$"
    zh = F.regexp_extract(line, pattern, 2)
    return F.struct(F.when(zh != "", F.trim(F.regexp_extract(line, pattern, 1))).otherwise(F.trim(line)).alias("text"), F.when(zh != "", zh).alias("zh"))


def display_form(word: Column, spellings: Column) -> Column:
    """The lower-case form if it was met in that spelling, else the word as it is."""
    return F.when(F.array_contains(spellings, F.lower(word)), F.lower(word)).otherwise(word)


def labels_of(codes: Column, table: dict[str, str]) -> Column:
    """Codes as their labels; an unknown code is its own label."""
    known = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.transform(codes, lambda c: F.coalesce(F.element_at(known, c), c))


def clean_gloss(c: Column, artifacts: str = r"[\u200b\ufeff]|\[\d+\]") -> Column:
    """Without artefacts, runs of blanks as one, punctuation at the ends cut."""
    return F.regexp_replace(F.trim(F.regexp_replace(F.regexp_replace(c, artifacts, ""), r"\s+", " ")), r"^[;,；，。\s]+|[;,；，\s]+$", "")


def has_meaning(text: Column, noise: str) -> Column:
    """Whether Han is left in some line when what noise matches is taken away."""
    return F.exists(lines(text), lambda x: F.regexp_replace(x, noise, "").rlike(HAN))


def every_line(text: Column, pattern: str) -> Column:
    """Whether there are lines and each matches."""
    own = lines(text)
    return (F.size(own) > 0) & F.forall(own, lambda x: x.rlike(pattern))


def ending_stem(word: Column, vowels: str = "aeiouàèéìòóù") -> Column:
    """The word without its final vowels."""
    return F.regexp_replace(word, f"[{vowels}]+$", "")


def valid_form(c: Column, letters: str = r"(?U)[\p{L}'’ \-]+", longest: int = 60) -> Column:
    """A form that is letters, blanks, hyphens and apostrophes throughout; else null."""
    t = F.trim(c)
    return F.when(t.rlike(f"^{letters}$") & (F.length(t) <= longest), t)


def human_size(n: Column) -> Column:
    """Bytes as B, KB, MB or GB in steps of 1024."""
    steps = [("GB", 1 << 30), ("MB", 1 << 20), ("KB", 1 << 10)]
    out = F.concat(n.cast("string"), F.lit(" B"))
    for unit, size in reversed(steps):
        out = F.when(n >= size, F.concat(F.format_string("%.1f", n / size), F.lit(f" {unit}"))).otherwise(out)
    return out


def json_or_none(text: Column, schema: str) -> Column:
    return F.from_json(text, schema)


def meta_list(meta: Column, schema: str = "array<struct<pos:string,g:string,num:array<string>,reg:array<string>,lex:array<string>,top:array<string>,src:string,batch:string>>") -> Column:
    """A JSON list of sense notes; an empty list where it is missing or no JSON."""
    return F.coalesce(F.from_json(meta, schema), F.array().cast(schema))


def senses(definition: Column, translation: Column, meta: Column) -> Column:
    """Three lists as one of (foreign, zh, meta), as long as the longest, filled with nulls."""
    return F.transform(F.arrays_zip(F.split(definition, "\n").alias("d"), F.split(translation, "\n").alias("t"), meta_list(meta).alias("m")), lambda s: F.struct(s["d"].alias("text"), s["t"].alias("zh"), s["m"].alias("meta")))


_BRACES = {"{": "}", "[": "]"}


def repaired_json(text: str) -> str | None:
    """The first balanced JSON value in a reply, without fences and trailing commas; None if there is none."""
    start = next((i for i, c in enumerate(text) if c in _BRACES), None)
    if start is None:
        return None
    stack, quoted, skip = [], False, False
    for i in range(start, len(text)):
        c = text[i]
        if skip:
            skip = False
        elif quoted:
            skip, quoted = c == "\\", c != '"'
        elif c == '"':
            quoted = True
        elif c in _BRACES:
            stack.append(_BRACES[c])
        elif stack and c == stack[-1]:
            stack.pop()
            if not stack:
                return re.sub(r",(?=\s*[\]}])", "", text[start : i + 1])
    return None


def repair_json(c: Column) -> Column:
    return string_udf(repaired_json)(c)


def edit_neighbours(a: Column, b: Column) -> Column:
    """Whether b is a or one insertion, deletion, substitution or swap of neighbours away."""

    def swapped(x: Column, y: Column) -> Column:
        return F.exists(F.sequence(F.lit(1), F.greatest(F.length(x) - 1, F.lit(1))), lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.lit(1)), F.substring(x, i, F.lit(1)), F.substring(x, i + 2, F.length(x))) == y)

    return (F.levenshtein(a, b) <= 1) | ((F.length(a) == F.length(b)) & (F.length(a) > 1) & swapped(a, b))


def degree_stems(word: Column) -> Column:
    """Bases that a form in -er or -est may have: the rest, the rest with e, with a doubled letter halved, with i as y."""
    rest = F.regexp_replace(word, "(er|est)$", "")
    many = F.array_distinct(F.array(rest, F.concat(rest, F.lit("e")), F.regexp_replace(rest, r"(.)\1$", "$1"), F.regexp_replace(rest, "i$", "y")))
    return F.when(word.rlike("...(er|est)$"), many).otherwise(F.array().cast("array<string>"))
