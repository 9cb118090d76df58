"""Quality rules (operator 10): a short-circuit cascade of document rules.

Every rule is a JVM expression over the text. On a random sample of bounded size each rule's cost (seconds a document, the time of a job
without the rule taken off) and rejection rate are measured; the rules then run by falling rejections per cost, and a document leaves at
its first rejection. The order decides only the speed: a document is kept when no rule rejects it.

A rule whose signs are rare asks for them first, by a plain search, and counts words only where they are.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import fresh, quoted


@dataclass(frozen=True)
class Rule:
    """rejects: from the text's column to a condition that is true for a document to reject. sql: the same for DuckDB, on {t}."""

    name: str
    rejects: object
    sql: str


def _share(text: Column, pattern: str) -> Column:
    """Matches of pattern for each word; words are counted only where there is a match."""
    hits = F.regexp_count(text, F.lit(pattern))
    return F.when(hits == 0, 0.0).otherwise(hits / F.greatest(F.regexp_count(text, F.lit(r"[^ \n\t\r]+")), F.lit(1)))


def _share_sql(pattern: str) -> str:
    return rf"len(regexp_extract_all({{t}}, '{pattern}')) / greatest(len(regexp_extract_all({{t}}, '[^ \n\t\r]+')), 1)"


def _repeats(text: Column) -> Column:
    words = F.split(text, r"[ \n]+")
    same = F.zip_with(words, F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.when(a == b, 1).otherwise(0))
    return F.aggregate(same, F.lit(0), lambda a, b: a + b) / F.greatest(F.size(words), F.lit(1))


REPEATS_SQL = r"list_sum(list_transform(list_zip(regexp_split_to_array({t}, '[ \n]+'), regexp_split_to_array({t}, '[ \n]+')[2:]), lambda p: CASE WHEN p[1] = p[2] THEN 1 ELSE 0 END)) / greatest(len(regexp_split_to_array({t}, '[ \n]+')), 1)"


def _repeated_lines(text: Column) -> Column:
    lines = F.split(text, "\n")
    return 1 - F.size(F.array_distinct(lines)) / F.size(lines)


#: Shares are of whitespace-separated words. Texts with no letter at all are rejected; a short text isn't, for being short.
RULES = (
    Rule("no_letters", lambda t: ~t.rlike(r"[A-Za-zª-￿]"), r"NOT regexp_matches({t}, '[A-Za-z\x{00aa}-\x{ffff}]')"),
    Rule("symbol_words", lambda t: _share(t, r"[#$%&*]{3}") > 0.2, _share_sql(r"[#$%&*]{3}") + " > 0.2"),
    Rule("pipes", lambda t: F.contains(t, F.lit("|")) & (_share(t, r"\|") > 0.2), _share_sql(r"\|") + " > 0.2"),
    Rule("shouting", lambda t: F.contains(t, F.lit("!!")) & (_share(t, r"[A-Z]{2,}[^ \n]*!!") > 0.2), _share_sql(r"[A-Z]{2,}[^ \n]*!!") + " > 0.2"),
    Rule("repeated_words", lambda t: _repeats(t) > 0.2, REPEATS_SQL + " > 0.2"),
    Rule("repeated_lines", lambda t: _repeated_lines(t) > 0.5, r"1 - len(list_distinct(string_split({t}, chr(10)))) / len(string_split({t}, chr(10))) > 0.5"),
)


@dataclass(frozen=True)
class Measured:
    name: str
    seconds: float
    rejected: float

    @property
    def value(self) -> float:
        return self.rejected / max(self.seconds, 1e-9)


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample_rows: int = 2000, seed: int = 7, rounds: int = 3, repeats: int = 4) -> list[Measured]:
    """Cost and selectivity of each rule on a uniform sample of about sample_rows rows (the bound is this parameter).

    A rule judges each row of the sample `repeats` times, in `rounds` jobs of which the fastest counts, less the fastest of as many jobs that
    judge nothing: what is left is the rule's own work, not that of planning and starting a job.
    """
    n = docs.count()
    sample = docs.select(quoted(text).alias("t")).where(F.col("t").isNotNull())
    if n > sample_rows:
        sample = sample.sample(fraction=sample_rows / n, seed=seed)
    sample = sample.coalesce(4).persist()
    try:
        rows = sample.agg(F.count("*")).first()[0]
        many = sample.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(repeats)))).where("again > 0")

        def fastest(condition: Column) -> tuple[float, int]:
            query, times = many.agg(F.count(F.when(condition, 1))), []
            for _ in range(rounds):
                began = time.perf_counter()
                hit = query.first()[0]
                times.append(time.perf_counter() - began)
            return min(times), hit

        idle, _ = fastest(F.col("t").isNull())
        out = []
        for rule in rules:
            took, hit = fastest(rule.rejects(F.col("t")))
            out.append(Measured(rule.name, max(took - idle, 1e-4) / max(rows * repeats, 1), hit / max(rows * repeats, 1)))
        return out
    finally:
        sample.unpersist()


def ordered(rules: tuple[Rule, ...], measured: list[Measured]) -> tuple[Rule, ...]:
    """Most rejections per second first; the name settles ties."""
    by = {m.name: m for m in measured}
    return tuple(sorted(rules, key=lambda r: (-by[r.name].value, r.name)))


def keep_condition(rules: tuple[Rule, ...], text: Column) -> Column:
    """A CASE over the rules in turn: the first that rejects ends it. A null text is kept from the rules and rejected as such."""
    case = F.when(text.isNull(), False)
    for rule in rules:
        case = case.when(rule.rejects(text), False)
    return case.otherwise(True)


def quality_filter(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", sample_rows: int = 2000) -> DataFrame:
    """The rows of docs that no rule rejects, with all their columns.

    Null text: rejected. Empty text: rejected by no_letters. Null in any other column: of no effect. Very long texts: judged whole.
    Repeated rows: each is judged alike and stays as often as it came. Empty table: empty result. Extra columns: kept as they are.
    """
    rules = ordered(rules, measure(docs, rules, text, sample_rows))
    return docs.where(keep_condition(rules, quoted(text)))


def rejections(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """docs with the rules that reject each row, in the order given: a report, in which no rule is skipped."""
    (out,) = fresh(docs, "rejected_by")
    t = quoted(text)
    hits = F.array_compact(F.array(*[F.when(rule.rejects(t), F.lit(rule.name)) for rule in rules]))
    return docs.withColumn(out, F.when(t.isNull(), F.array(F.lit("null_text"))).otherwise(hits)).withColumnRenamed(out, "rejected_by")
