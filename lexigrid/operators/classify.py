"""Classifications: ordered cases over an entry's columns. Each row gets just one class; the order of the cases is part of the meaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexigrid.functions.text import HAN, blank, present


def core(numbers: list[str] = ("collins", "oxford", "frq", "bnc"), tag: str = "tag") -> Column:
    """Whether any sign says that a word is in common use. Never null, so that core and its opposite cover all rows."""
    out = present(F.col(tag))
    for n in numbers:
        out = out | (F.coalesce(F.col(n), F.lit(0)) > 0)
    return out


_FORMS = "|".join(
    "第三人称单数一般现在时形式 第三人称单数一般现在时 过去式与过去分词形式 现在分词和动名词形式 过去式和过去分词 第三人称单数 动名词形式 替代形式 异写形式 名词复数 复数形式 变化形式 过去分词 现在分词 "
    "最高级 比较级 动名词 过去式 同义词 变形 复数".split()
) + r"|第三人称 ?-s ?形式"
_LATIN = r"(?i:[a-z])(?:\w|[- '])*"
_CLAUSE = rf"[(（]?\s*[是为]?\s*{_LATIN}\s*的(?:{_FORMS})\s*[）)]?"
_LOOSE = rf"(?:^|[\s;,/；，、])(?:{_FORMS}|一般现在时)"
_LABEL = r"(?m)^(?:\s*[a-z]{1,5}[.](?:form)?)+\s*"


def shell(body: Column) -> Column:
    """Whether a translation says no more than of which word this is a form."""
    clauses = F.regexp_replace(body, _CLAUSE, "")
    rest = F.when(clauses != body, F.regexp_replace(clauses, _LOOSE, "")).otherwise(clauses)
    return body.rlike(f"的(?:{_FORMS})") & (F.regexp_replace(F.regexp_replace(rest, _LABEL, ""), r"^[\s;；,，/()（）.·是为的\-]+|[\s;；,，/()（）.·是为的\-]+$", "") == "")


def tail_bucket(word: Column, translation: Column) -> Column:
    """A1 only a pointer; B1, B2 from the web (transliterated or not); C1 species name; C2 names; C3 abbreviation; C4 marked; C5, C6 one or more words."""
    w, body = F.trim(F.coalesce(word, F.lit(""))), F.trim(F.coalesce(translation, F.lit("")))
    tokens = F.filter(F.split(w, r"\s+"), lambda t: t != "")
    marks = F.regexp_extract_all(body, F.lit(r"[\[]([^\]]{1,8})[\]]"), F.lit(1))
    after = F.trim(F.when(F.contains(body, F.lit("]")), F.regexp_replace(body, r"(?s)^[^\]]*\]", "")).otherwise(body))
    letters = lambda t: t.rlike(r"(?U)^\p{L}+$")
    species = (F.size(tokens) == 2) & F.try_element_at(tokens, F.lit(1)).rlike(r"(?U)^\p{Lu}") & F.try_element_at(tokens, F.lit(2)).rlike(r"(?U)^\p{Ll}") & F.forall(tokens, letters)
    web = F.array_contains(marks, "网络")
    return (
        F.when(shell(body), "A1")
        .when(web & ~F.contains(body, F.lit("\n")) & after.rlike("^[一-鿿·]{1,8}$"), "B1")
        .when(web, "B2")
        .when(F.coalesce(species, F.lit(False)), "C1")
        .when(F.exists(marks, lambda m: m.isin("人名", "地名") | F.contains(m, F.lit("姓氏")) | F.contains(m, F.lit("名字"))), "C2")
        .when((letters(w) & (F.upper(w) == w) & (F.lower(w) != w) & (F.length(w) > 1)) | body.startswith("abbr."), "C3")
        .when(F.size(marks) > 0, "C4")
        .when((F.size(tokens) == 1) & ~F.contains(w, F.lit("-")), "C5")
        .otherwise("C6")
    )


GRADE = dict(x.split("=") for x in "A1=low B1=low B2=low C1=good C2=good C3=low C4=good C5=fair C6=fair".split())


def grade(bucket: Column, is_core: Column, judged: Column, fixed: Column) -> Column:
    """core before judged before fixed before the bucket's own grade."""
    own = F.element_at(F.create_map(*[F.lit(x) for pair in GRADE.items() for x in pair]), bucket)
    yes = lambda c: F.coalesce(c, F.lit(False))
    return F.when(yes(is_core), "core").when(yes(judged), "judged").when(yes(fixed), "fixed").otherwise(own)


def intake_kind(word: Column, known_key: Column) -> Column:
    """accent (only accents differ from a known word), multiword, proper, other."""
    return F.when(known_key.isNotNull(), "accent").when(F.contains(F.trim(word), F.lit(" ")), "multiword").when(word.rlike(r"(?U)^\p{Lu}"), "proper").otherwise("other")


def needs(translation: Column, gender: Column, level: Column, pos: Column) -> Column:
    """What is still to be asked for."""
    posset = F.split(F.coalesce(pos, F.lit("")), "/")
    noun = F.arrays_overlap(posset, F.array(F.lit("n"), F.lit("name")))
    return F.array_compact(F.array(F.when(blank(translation), "translation"), F.when(noun & blank(gender), "gender"), F.when(blank(level), "level")))


def fill_outcome(current: Column, abstained: Column, confidence: Column, text: Column, script: str = HAN) -> Column:
    """What becomes of an offered text: gone (no longer empty), abstain, low, blank, script (no sign of it), ok."""
    return (
        F.when(present(current), "gone")
        .when(F.coalesce(abstained, F.lit(False)), "abstain")
        .when(F.coalesce(confidence, F.lit("low")) == "low", "low")
        .when(blank(text), "blank")
        .when(~text.rlike(script), "script")
        .otherwise("ok")
    )


def anchor_outcome(bucket: Column, wanted: list[str], anchor: Column, least: int = 4, meta: str = r"(?i)^(abbreviation|alternative|initialism|acronym|plural|inflection) (form )?of\b") -> Column:
    """Whether a row can be rewritten from an anchor gloss: other bucket, no anchor, short, pointer (the anchor itself only points), ok."""
    return F.when(~bucket.isin(*wanted), "bucket").when(blank(anchor), "no anchor").when(F.length(F.trim(anchor)) < least, "short").when(anchor.rlike(meta), "pointer").otherwise("ok")


def anchor_text(senses: Column, most: int = 4, longest: int = 340) -> Column:
    """Several senses numbered, the first few, cut at a length."""
    some = F.slice(senses, 1, most)
    numbered = F.transform(some, lambda x, i: F.when(F.size(senses) > 1, F.concat((i + 1).cast("string"), F.lit(". "), x)).otherwise(x))
    return F.substring(F.array_join(numbered, " "), 1, longest)


def morphology_fits(form: Column, base: Column, label: Column) -> Column:
    """Whether form is a regular form of base of that label; true for labels without a rule."""
    f, b = F.lower(form), F.lower(base)
    short = F.regexp_replace(b, "[ey]$", "")
    ends = lambda *xs: F.startswith(f, F.substring(short, F.lit(1), F.greatest(F.length(short) - 1, F.lit(1)))) & f.rlike("(" + "|".join(xs) + ")$")
    return F.when(label == "复数", ends("s", "i", "ae", "a", "en", "x")).when(F.contains(label, F.lit("现在分词")), ends("ing")).when(F.contains(label, F.lit("第三人称")), ends("s")).when(label == "比较级", ends("er")).when(label == "最高级", ends("est")).otherwise(F.lit(True))


def guard_flags(base: Column, base_translation: Column, base_pos: Column, form: Column, label: Column) -> Column:
    """Reasons for which a form's text shouldn't be taken from its base, as letters."""
    verb = F.array_contains(F.split(F.coalesce(base_pos, F.lit("")), "/"), "v")
    verbal = F.contains(label, F.lit("分词")) | F.contains(label, F.lit("过去式")) | F.contains(label, F.lit("第三人称"))
    tests = [
        ("A", blank(base_translation)),
        ("B", shell(F.coalesce(base_translation, F.lit("")))),
        ("C", base.rlike("^[A-Z]{2,}$")),
        ("D", F.contains(base, F.lit(" "))),
        ("E", F.lower(base) == F.lower(form)),
        ("F", verbal & ~verb),
        ("G", ~morphology_fits(form, base, label)),
        ("H", F.contains(F.coalesce(base_translation, F.lit("")), F.lit("[网络]"))),
        ("I", base.rlike(r"(?U)^\p{Lu}") & ~form.rlike(r"(?U)^\p{Lu}")),
    ]
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in tests]))


def degree_defect(word: Column, translation: Column, known_stem: Column) -> Column:
    """A comparative or superlative whose translation says nothing of a degree."""
    return word.rlike("...(er|est)$") & known_stem & ~F.coalesce(translation, F.lit("")).rlike("更|最|比较级|最高级|者|人|器|机")


def asserts_more(source: Column, target: Column, source_marks: str, target_marks: str) -> Column:
    """Lines where the target has a mark (archaic, causative ...) that the source has not; both are lists of lines of one length."""
    pairs = F.zip_with(F.split(F.coalesce(source, F.lit("")), "\n"), F.split(F.coalesce(target, F.lit("")), "\n"), lambda s, t: F.coalesce(t.rlike(target_marks), F.lit(False)) & ~F.coalesce(s.rlike(source_marks), F.lit(False)))
    return F.exists(pairs, lambda x: x)
