"""Pronunciations, inflection labels and grammar, over words given here, with the results that are known for them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lexigrid.functions import g2p, ipa, labels, text
from lexigrid.operators import stats

CASES: dict[str, tuple[list, dict]] = {}


def _known(name: str, rows: list[tuple], group: str, made: dict[str, object]) -> None:
    CASES[name] = (rows, made)


_known(
    "shown_ipa",
    [
        ("uk", "ˈnʌmbə(ɹ)", "ˈnʌmbə"), ("us", "ˈnʌmbɚ(ɹ)", "ˈnʌmbər"), ("uk", "ˈdɜːndl̩", "ˈdɜːndəl"), ("uk", "ˈæb.s(ə)n̩s", "ˈæbsəns"), ("us", "ˈsaɪɾɪŋ", "ˈsaɪtɪŋ"), ("uk", "ˈt͡ʃɛk", "ˈtʃek"), ("us", "n(j)uː", "nuː"), ("uk", "n(j)uː", "njuː"),
        ("uk", "kwɔːtə(r", "kwɔːtər"), ("es", "/ˈɡɾaθjas/ [ˈɡɾa.θjas]", "/ˈɡɾaθjas/"), ("es", "ˈliβ̞ɾo", "ˈlibɾo"), ("it", "/ˈpit.t͡sa/", "ˈpitːtsa"), ("it", "/faˈmiʎ.ʎa/", "faˈmiʎa"), ("it", "/ˈɡat.to/", "ˈɡatːo"), ("fr", "/mɑ̃.ʒe/", "mɑ̃ʒe"), ("fr", "/pɑt/", "pat"),
        ("pt", "/paʁˈt͡ʃi(ʁ)/", "paʁˈtʃi(ʁ)"), ("de", "[haʊ̯s]", "haʊ̯s"), ("de", "/ˈɡeː.ən/", "ˈɡeːən"),
    ],
    "Pronunciations as they are shown",
    {"uk": lambda c: ipa.english_shown(c, "uk"), "us": lambda c: ipa.english_shown(c, "us"), **ipa.SHOWN},
)

_known(
    "stored_ipa",
    [
        ("en", "ˈneɪ̯.tʃə", "ˈneɪtʃə"), ("en", "ˈkʰæt(ə)ɫ", "ˈkæt(ə)l"), ("parse", "/ˈɡɾaθjas/ [ˈɡɾa.θjas]", "ˈɡɾaθjas"), ("parse", "[ˈɡa.to]", "ˈɡa.to"), ("parse", "\\ʃa\\", "ʃa"), ("parse", "plain", None), ("latam", "ˈɡɾaθjas", "ˈɡɾasjas"), ("latam", "ˈkasa", None),
        ("glide", "ˈewɾo", "ˈeuɾo"), ("edition", "ˈgɾaθ̪jas", "ˈɡɾaθjas"),
    ],
    "Pronunciations as they are stored",
    {"en": ipa.english_stored, "parse": ipa.parse_ipa, "latam": ipa.latin_american, "glide": ipa.glide_fold, "edition": ipa.canon_edition},
)

_known(
    "spelt_ipa",
    [
        *[("es", *r.split("=")) for r in "hablar=/aˈblaɾ/ cinco=/ˈθinko/ perro=/ˈpero/ calle=/ˈkaʝe/ guerra=/ˈɡera/ queso=/ˈkeso/ jamón=/xaˈmon/ país=/paˈis/ cuidado=/kwiˈdado/ ciudad=/θjuˈdad/ pingüino=/pinˈɡwino/ muy=/ˈmwi/".split()],
        *[("it", *r.split("=")) for r in "parlàre=/parˈla.re/ pàrlano=/ˈpar.la.no/ città=/t͡ʃitˈta/ gatto=/ˈɡat.to/ piàno=/ˈpja.no/".split()],
        *[("de", *r.split("=")) for r in "mit=/ˈmɪt/ Tag=/ˈtaːk/ Vater=/ˈfaː.tɐ/ Kinder=/ˈkɪn.dɐ/ Sport=/ˈʃpɔʁt/ König=/ˈkøː.nɪç/".split()],
        ("es", "weiß", None),
    ],
    "Spelling to sound",
    {code: (lambda c, code=code: g2p.to_ipa(c, code)) for code in g2p.SPELLERS},
)

_known(
    "inflection_labels",
    [
        ("es", "form-of,indicative,present,first-person,singular", "陈述式·现在时·第一人称·单数"), ("es", "gerund", "副动词"), ("es", "imperative,second-person,singular,with-voseo", "命令式·第二人称·单数·（voseo）"), ("es", "first-person,third-person,singular,imperfect,subjunctive", "虚拟式·未完成过去时·第一/三人称·单数"),
        ("it", "historic,past,third-person,singular", "远过去时第三人称单数"), ("it", "participle,past,feminine,plural", "过去分词阴性复数"), ("fr", "feminine,plural", "阴性复数"), ("fr", "indicative,future,third-person,plural", "陈述式简单将来时第三人称复数"),
        ("pt", "infinitive,personal,first-person,plural", "人称不定式第一人称复数"), ("pt", "pluperfect,indicative,first-person,singular", "陈述式过去完成时第一人称单数"), ("de", "genitive,singular", "单数属格"), ("de", "comparative,strong,nominative,plural", "比较级强变化复数主格"),
        ("de", "participle,past", "过去分词（Partizip II）"), ("de", "subjunctive-ii,third-person,singular", "虚拟式II第三人称单数"), ("es", "", ""),
    ],
    "Labels of inflected forms",
    {code: (lambda c, code=code: labels.compose(F.split(c, ","), code)) for code in ("es", "it", "fr", "pt", "de")},
)

_STORED = [
    tuple(x.split("="))
    for x in (
        "técnico=ˈteɡniko=ˈtekniko|septiembre=sebˈtjembɾe=sepˈtjembɾe|atleta=adˈleta=atˈleta|acto=ˈaɡto=ˈakto|derecho=deˈɾet͡ʃo=deˈɾetʃo|libro=ˈliβɾo=ˈlibɾo|doctor=doɡˈtoɾ=dokˈtoɾ|"
        "gracias=ˈɡɾaθjas [ˈɡɾa.θjas]=ˈɡɾaθjas|FBI=ˌefe ˌbe ˈi=ˌefe ˌbe ˈi|euro=ˈewɾo=ˈeuɾo|extraño=e(k)sˈtɾaɲo=eksˈtɾaɲo|president=pɾesiˈden(d)=pɾesiˈdent|moyuelo=moʝˈ(ɡ)welo=moʝˈwelo"
    ).split("|")
]



@pytest.mark.parametrize("name", sorted(CASES))
def test_known_results(spark, name):
    rows, made = CASES[name]
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, kind string, given string, want string")
    case = F.lit(None).cast("string")
    for kind, fn in made.items():
        case = F.when(F.col("kind") == kind, fn(F.col("given"))).otherwise(case)
    found = d.select("i", case.alias("r")).orderBy("i").collect()
    assert [(rows[r["i"]][:2], r["r"]) for r in found] == [(r[:2], r[2]) for r in rows]


def test_spanish_stored(spark):
    """Seven steps of normal form, two of which look at the spelling."""
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(_STORED)], "i int, word string, given string, want string")
    found = d.select("i", ipa.spanish_stored(F.col("word"), F.col("given")).alias("r")).orderBy("i").collect()
    assert [r["r"] for r in found] == [r[2] for r in _STORED]


def test_differences(spark):
    d = spark.createDataFrame([("kato", "kata"), ("pero", "pera"), ("lo", "la"), ("aɡto", "akto"), ("kasa", "kasas"), ("x", "x")], "b string, a string")
    assert [tuple(r) for r in stats.difference_pairs(d, "b", "a").collect()] == [("o", "a", 3), ("", "s", 1), ("ɡ", "k", 1)]
    d = spark.createDataFrame([("abcc", "abd"), ("", "xy"), ("kk", "k")], "b string, a string")
    x = stats.added_and_dropped(F.col("b"), F.col("a"))
    assert [tuple(r) for r in d.select(x["added"], x["dropped"]).collect()] == [("d", "cc"), ("xy", ""), ("", "k")]


def test_labelled_lines(spark):
    d = spark.createDataFrame([("n. cat",), ("vt. do",), ("plain",)], "line string")
    x = text.labelled_line(F.col("line"))
    assert [tuple(r) for r in d.select(x["pos"], x["text"]).collect()] == [("n.", "cat"), ("vt.", "do"), (None, "plain")]


def test_spelt_words_are_the_spellers(spark):
    from lexigrid import catalog
    from tests.conftest import DATA

    spellers = {"es": g2p.spanish, "de": g2p.german}
    found = catalog.queries()["spelt_words"](spark, f"{DATA}/sf0.001").collect()
    assert found and all(r["sound"] == spellers[r["lang"]](r["word"]) for r in found)


def test_unaccent(spark):
    words = ["Éléphant", "ÀÉÎÕÜ ñ ç", "İstanbul", "straße", "Ångström", "e\u0301te\u0301", "ΑΒΓ Ά ώ", "Ёлка", "한글", "中文 abc", "", "plain ASCII", "ệ Ǻ ǆ ﬁ", "\U0001f600 Ĳ", None]
    d = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    found = d.select("i", text.unaccent(F.col("w")).alias("k")).orderBy("i").collect()
    assert [r["k"] for r in found] == [None if w is None else text.strip_marks(w) for w in words]
