"""Inflection labels: grammatical tags composed to one label, for five languages from one table each.

A label has segments in a fixed order; what a segment's tags name is joined by a slash. A spec says which tags there are, whether
non-finite forms end the label, and how segments are joined.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

ALWAYS_DROPPED = ("combined-form", "alt-of", "form-of")


def _table(text: str) -> dict[str, str]:
    return dict(x.split("=") for x in text.split())


_ROMANCE_MOOD = _table("indicative=陈述式 subjunctive=虚拟式 conditional=条件式 imperative=命令式")
_PERSON = _table("first-person=一 second-person=二 third-person=三")
_NUMBER = _table("singular=单数 plural=复数")
_GENDER = _table("feminine=阴性 masculine=阳性")


@dataclass(frozen=True)
class Spec:
    mood: dict[str, str]
    tense: dict[str, str]
    gerund: str = "副动词"
    historic: str = ""  # the label of the tense that the tag `historic` names
    nominal: bool = False  # whether forms that are no verb forms get gender and number
    personal: bool = False  # whether there is a personal infinitive
    marks: tuple[tuple[str, str], ...] = ()
    dropped: tuple[str, ...] = ALWAYS_DROPPED
    extra: tuple[str, ...] = field(default=())


SPECS = {
    "it": Spec(_ROMANCE_MOOD, _table("present=现在时 imperfect=未完成过去时 future=将来时"), historic="远过去时", marks=(("formal", "（尊称 Lei）"), ("negative", "（否定）"))),
    "fr": Spec(_ROMANCE_MOOD, _table("present=现在时 imperfect=未完成过去时 future=简单将来时"), gerund="副动词（gérondif）", historic="简单过去时", nominal=True, marks=(("negative", "（否定）"),)),
    "pt": Spec(_ROMANCE_MOOD, _table("present=现在时 preterite=简单过去时 imperfect=未完成过去时 pluperfect=过去完成时 future=将来时"), gerund="副动词（gerúndio）", nominal=True, personal=True, marks=(("negative", "（否定）"),)),
}


def _picked(tags: Column, table: dict[str, str]) -> Column:
    """The labels of those of the table's tags that are there, in the table's order."""
    return F.array_compact(F.array(*[F.when(F.array_contains(tags, t), F.lit(label)) for t, label in table.items()]))


def _slashed(tags: Column, table: dict[str, str], before: str = "", after: str = "") -> Column:
    """One segment, or null."""
    own = _picked(tags, table)
    return F.when(F.size(own) > 0, F.concat(F.lit(before), F.array_join(own, "/"), F.lit(after)))


def _joined(segments: list[Column], by: str) -> Column:
    return F.array_join(F.array_compact(F.array(*segments)), by)


def _spanish(tags: Column) -> Column:
    has = lambda t: F.array_contains(tags, t)
    non_finite = F.try_element_at(_picked(tags, _table("infinitive=不定式 gerund=副动词 participle=过去分词")), F.lit(1))
    when_finite = lambda c: F.when(non_finite.isNull(), c)
    objects = [(f"object-{k}", v) for k, v in _PERSON.items()]
    segments = [
        non_finite,
        when_finite(_slashed(tags, _ROMANCE_MOOD)),
        when_finite(_slashed(tags, _table("present=现在时 imperfect=未完成过去时 preterite=简单过去时 future=将来时"))),
        *[F.when(has(t), F.lit(label)) for t, label in _table("comparative=比较级 superlative=最高级 diminutive=指小形式 augmentative=增大形式").items()],
        _slashed(tags, _PERSON, "第", "人称"),
        _slashed(tags, _table("feminine=阴 masculine=阳"), after="性"),
        _slashed(tags, _table("singular=单 plural=复"), after="数"),
        *[F.when(has(t), F.lit(label)) for t, label in _table("with-voseo=（voseo） reflexive=自复 dative=与格 accusative=宾格").items()],
        _slashed(tags, dict(objects), "第", "人称宾语"),
        _slashed(tags, _table("object-feminine=阴 object-masculine=阳"), after="性"),
        _slashed(tags, _table("object-singular=单 object-plural=复"), after="数"),
    ]
    return _joined(segments, "·")


def _romance(tags: Column, spec: Spec) -> Column:
    has = lambda t: F.array_contains(tags, t)
    participle = F.concat(F.when(has("past"), "过去分词").when(has("present"), "现在分词").otherwise("分词"), F.array_join(_picked(tags, _GENDER), ""), F.array_join(_picked(tags, _NUMBER), ""))
    mood, person, number = _slashed(tags, spec.mood), _slashed(tags, _PERSON, "第", "人称"), _slashed(tags, _NUMBER)
    tense = _slashed(tags, spec.tense)
    if spec.historic:
        tense = F.when(has("historic"), F.lit(spec.historic)).otherwise(tense)
    finite = _joined([mood, tense, person, number, *[F.when(has(t), F.lit(label)) for t, label in spec.marks]], "")
    case = F.when(F.lit(False), F.lit(""))
    if spec.personal:
        case = case.when(has("infinitive") & has("personal"), _joined([F.lit("人称不定式"), person, F.array_join(_picked(tags, _NUMBER), "")], ""))
    case = case.when(has("infinitive"), "不定式").when(has("gerund"), spec.gerund).when(has("participle"), participle)
    if spec.nominal:
        case = case.when(mood.isNull() & tense.isNull() & person.isNull(), _joined([_slashed(tags, _GENDER), number], ""))
    return case.otherwise(finite)


def _german(tags: Column) -> Column:
    has = lambda t: F.array_contains(tags, t)
    first = lambda table: F.try_element_at(_picked(tags, table), F.lit(1))
    whole = lambda table: F.array_join(_picked(tags, table), "")
    mood = first(_table("indicative=陈述式 subjunctive-i=虚拟式I subjunctive-ii=虚拟式II subjunctive=虚拟式 imperative=命令式"))
    tense = first(_table("present=现在时 preterite=过去时 past=过去时"))
    case = _slashed(tags, _table("nominative=主格 genitive=属格 dative=与格 accusative=宾格"))
    person = _slashed(tags, _PERSON, "第", "人称")
    verb = _joined([mood, tense, person, _slashed(tags, _NUMBER), F.when(has("negative"), F.lit("（否定）"))], "")
    noun = _joined([whole(_table("comparative=比较级 superlative=最高级")), whole(_table("strong=强变化 weak=弱变化 mixed=混合变化")), _slashed(tags, _table("masculine=阳性 feminine=阴性 neuter=中性")), whole(_NUMBER), case], "")
    return (
        F.when(has("infinitive-zu"), "带 zu 不定式")
        .when(has("infinitive"), "不定式")
        .when(has("participle"), F.when(has("past"), "过去分词（Partizip II）").when(has("present"), "现在分词（Partizip I）").otherwise("分词"))
        .when(mood.isNotNull() | person.isNotNull() | (tense.isNotNull() & case.isNull()), verb)
        .otherwise(noun)
    )


def compose(tags: Column, lang: str) -> Column:
    """The label of a form's tags; an empty one if they say nothing. Null tags: empty."""
    tags = F.coalesce(tags, F.array().cast("array<string>"))
    if lang == "es":
        return _spanish(tags)
    if lang == "de":
        return _german(tags)
    return _romance(tags, SPECS[lang])


#: What a tag may say in English prose, longest first.
_PROSE = [
    ("third-person singular", ["third-person", "singular"]),
    ("past participle", ["past", "participle"]),
    ("present participle", ["present", "participle"]),
    *[(w, [w.replace(" ", "-")]) for w in ("first person", "second person", "third person", "imperative", "indicative", "subjunctive", "conditional", "infinitive", "superlative", "comparative", "diminutive", "preterite", "imperfect", "masculine", "feminine", "gerund", "singular", "present", "future", "plural")],
]


def tags_of_prose(gloss: Column) -> Column:
    """The tags that a gloss such as `third person singular present of x` names."""
    low = F.regexp_replace(F.lower(gloss), "(first|second|third)-person", "$1 person")
    found = [F.when(F.contains(low, F.lit(phrase.replace("-", " "))), F.array(*map(F.lit, tags))) for phrase, tags in _PROSE]
    return F.array_distinct(F.flatten(F.array_compact(F.array(*found))))


#: `plural of x` and the like: pattern, label; the first that matches counts.
_ENGLISH_FORMS = [
    (r"(?i)^(?:the )?plural of\s+(.+?)[.;,]?$", "复数"),
    (r"(?i)^(?:simple )?past tense and past participle of\s+(.+?)[.;,]?$", "过去式和过去分词"),
    (r"(?i)^(?:simple )?past(?: tense)? of\s+(.+?)[.;,]?$", "过去式"),
    (r"(?i)^past participle of\s+(.+?)[.;,]?$", "过去分词"),
    (r"(?i)^present participle(?: and gerund)? of\s+(.+?)[.;,]?$", "现在分词"),
    (r"(?i)^third-person singular simple present(?: indicative)?(?: form)? of\s+(.+?)[.;,]?$", "第三人称单数"),
    (r"(?i)^comparative form of\s+(.+?)(?::.*)?[.;,]?$", "比较级"),
    (r"(?i)^superlative form of\s+(.+?)(?::.*)?[.;,]?$", "最高级"),
    (r"(?i)^(?:alternative|obsolete|archaic) (?:form|spelling) of\s+(.+?)[.;,]?$", "异写形式"),
]


def english_form(gloss: Column) -> Column:
    """(base, label) of a gloss that only points to another word; null for others."""
    case = F.when(F.lit(False), F.struct(F.lit("").alias("base"), F.lit("").alias("label")))
    for pattern, label in _ENGLISH_FORMS:
        case = case.when(gloss.rlike(pattern), F.struct(F.trim(F.regexp_extract(gloss, pattern, 1)).alias("base"), F.lit(label).alias("label")))
    return case
