"""Secret scans (operator 3) over a trigram inverted index.

Each rule's regular expression yields a Boolean query over trigrams that any match must contain (letters folded to lower case). Texts
are indexed in segments, one for each Arrow batch: the postings of a trigram are the texts of the segment that have it, as a bitmap; only
trigrams that a query asks for are kept. Intersecting and uniting postings gives a rule's candidates, which its expression verifies.
Rules whose query is empty scan every text. Segments need no shuffle.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from re import _constants as sre
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrid.llm.common import blocks, quoted, utf8_parts

MAX_EXACT = 64


@dataclass(frozen=True)
class Rule:
    """pattern: a regular expression over ASCII that Python and RE2 read alike."""

    name: str
    pattern: str


RULES = (
    Rule("aws_access_key", r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b"),
    Rule("github_token", r"\bgh[pousr]_[A-Za-z0-9]{36}\b"),
    Rule("slack_token", r"\bxox[abpr]-[A-Za-z0-9-]{10,}"),
    Rule("google_api_key", r"\bAIza[0-9A-Za-z_-]{35}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("json_web_token", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("assigned_secret", r"(?i)\b(?:api_?key|secret|token|passwd|password)[ \t]{0,3}[:=][ \t]{0,3}[\x22'][A-Za-z0-9_+/=-]{16,}[\x22']"),
    Rule("url_credentials", r"\b[a-z]{3,10}://[^/ \t\r\n:@]{1,64}:[^/ \t\r\n:@]{3,64}@"),
    Rule("hex_secret", r"\b[0-9a-f]{40}\b"),
)


def trigrams(text: str) -> set[int]:
    b = text.encode()
    return {b[i] | b[i + 1] << 8 | b[i + 2] << 16 for i in range(len(b) - 2)}


def _and(parts: list) -> object:
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _or(parts: list) -> object:
    parts = list(dict.fromkeys(parts))
    return True if True in parts or not parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _needs(strings: set[str]) -> object:
    return _or([_and(sorted(trigrams(s))) for s in sorted(strings)])


def _parse(items: object) -> tuple[set[str] | None, object]:
    """The strings that items match, if they are few, and what any text that items match must contain."""
    exact: set[str] | None = {""}
    run, needs, whole = {""}, [], True
    for op, arg in items:
        own, query = _one(op, arg)
        joined = {a + b for a, b in itertools.product(run, own)} if own is not None and len(run) * len(own) <= MAX_EXACT else None
        if joined is not None:
            run = joined
            continue
        needs.append(_needs(run))
        whole = False
        if own is None:
            needs.append(query)
            run = {""}
        else:
            run = own
    exact = run if whole else None
    return exact, _and([*needs, _needs(run)])


def _one(op: object, arg: object) -> tuple[set[str] | None, object]:
    if op is sre.LITERAL:
        return {chr(arg).lower()}, True
    if op is sre.AT or op in (sre.ASSERT, sre.ASSERT_NOT):
        return {""}, True
    if op is sre.IN:
        chars: set[str] = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                chars.add(chr(value).lower())
            elif kind is sre.RANGE and value[1] - value[0] < MAX_EXACT:
                chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None, True
        return (chars, True) if len(chars) <= 8 else (None, True)
    if op is sre.SUBPATTERN:
        return _parse(arg[3])
    if op is sre.BRANCH:
        found = [_parse(x) for x in arg[1]]
        if all(e is not None for e, _ in found):
            union = set().union(*[e for e, _ in found])
            if len(union) <= MAX_EXACT:
                return union, _needs(union)
        return None, _or([q if e is None else _needs(e) for e, q in found])
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        low, high, body = arg
        exact, query = _parse(body)
        if exact is not None and high <= 3 and sum(len(exact) ** n for n in range(low, high + 1)) <= MAX_EXACT:
            union = {"".join(x) for n in range(low, high + 1) for x in itertools.product(exact, repeat=n)}
            return union, _needs(union)
        if low == 0:
            return None, True
        if exact is not None and len(exact) ** min(low, 8) <= MAX_EXACT:
            return None, _needs({"".join(x) for x in itertools.product(exact, repeat=min(low, 8))})
        return None, query
    return None, True


def trigram_query(pattern: str) -> object:
    """True (any text may match), a trigram, or ("and" | "or", queries...). Non-ASCII literals ask for nothing."""
    if not pattern.isascii():
        return True
    return _parse(_parser.parse(pattern))[1]


def _asked(query: object) -> set[int]:
    if query is True:
        return set()
    return {query} if isinstance(query, int) else set().union(*map(_asked, query[1:]))


class Index:
    """The rules compiled, and the segments' postings."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r.name, re.compile(r.pattern.encode()), trigram_query(r.pattern)) for r in rules]
        self.codes = np.array(sorted(set().union(*[_asked(q) for _, _, q in self.rules])), np.int64)
        self.wanted = np.zeros(1 << 24, bool)
        self.wanted[self.codes] = True
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """bool [trigram of codes, text]"""
        n = len(offsets) - 1
        out = np.zeros((len(self.codes), n), bool)
        for a, b in blocks(offsets):
            d = self.lower[data[offsets[a] : offsets[b]]].astype(np.uint32)
            if len(d) < 3:
                continue
            tri = d[:-2] | d[1:-1] << np.uint32(8) | d[2:] << np.uint32(16)
            at = np.flatnonzero(self.wanted[tri])
            row = np.searchsorted(offsets[a : b + 1] - offsets[a], at, "right") - 1 + a
            inside = at + 3 <= offsets[row + 1] - offsets[a]
            out[np.searchsorted(self.codes, tri[at[inside]].astype(np.int64)), row[inside]] = True
        return out

    def candidates(self, query: object, postings: np.ndarray) -> np.ndarray:
        if query is True:
            return np.ones(postings.shape[1], bool)
        if isinstance(query, int):
            return postings[int(np.searchsorted(self.codes, query))]
        parts = [self.candidates(q, postings) for q in query[1:]]
        return (np.logical_and if query[0] == "and" else np.logical_or).reduce(parts)

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, str, int, int, int]]:
        """(text, rule, number within text and rule, start byte, end byte)"""
        postings, whole = self.postings(data, offsets), data.tobytes()
        for name, pattern, query in self.rules:
            for row in np.flatnonzero(self.candidates(query, postings)).tolist():
                start, end = int(offsets[row]), int(offsets[row + 1])
                for i, m in enumerate(pattern.finditer(whole[start:end]), 1):
                    yield row, name, i, m.start(), m.end()


@lru_cache(8)
def _index(rules: tuple[Rule, ...]) -> Index:
    return Index(rules)


def _scan(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_parts(batch.column("text"))
            found = list(_index(rules).matches(data, offsets))
            rows = np.array([m[0] for m in found], np.int64)
            parts = [data[offsets[r] + s : offsets[r] + e].tobytes() for r, _, _, s, e in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows)), pa.array([m[1] for m in found], pa.string()), pa.array([m[2] for m in found], pa.int32()), pa.array([len(p.decode(errors="replace")) for p in parts], pa.int32()), pa.array([hashlib.md5(p).hexdigest() for p in parts], pa.string())],
                ["doc_id", "rule", "match_no", "n_chars", "digest"],
            )

    return run


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row (doc_id, rule, match_no, n_chars, digest) for each match; the secret itself is given by its MD5 only.

    Null or empty texts match nothing. Very long texts are scanned whole. Repeated rows give their matches once each. Null doc_id: stays
    null. Empty table: empty result. Other columns: unread. A stretch that several rules match has a row for each.
    """
    base = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    kind = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(_scan(tuple(rules)), f"doc_id {kind}, rule string, match_no int, n_chars int, digest string")


def redact(texts: pa.Array, rules: tuple[Rule, ...], mark: str) -> pa.Array:
    data, offsets = utf8_parts(texts)
    spans: dict[int, list[tuple[int, int]]] = {}
    for row, _, _, start, end in _index(rules).matches(data, offsets):
        spans.setdefault(row, []).append((start, end))
    if not spans:
        return texts
    out = texts.to_pylist()
    for row, own in spans.items():
        whole, parts, at = data[offsets[row] : offsets[row + 1]].tobytes(), [], 0
        for start, end in sorted(own):
            if start >= at:
                parts += [whole[at:start], mark.encode()]
            at = max(at, end)
        out[row] = b"".join([*parts, whole[at:]]).decode()
    return pa.array(out, texts.type)


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", n_chars: str = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """docs with each stretch that rules match replaced by mark (overlapping ones by a single mark); all rows and columns stay.

    n_chars, if there, becomes the length of the new text where it changed. Nulls, empty texts and other columns: as they were.
    """
    rules = tuple(rules)

    def new_text(texts: pa.Array) -> pa.Array:
        return redact(texts, rules, mark)

    new = F.arrow_udf(new_text, T.StringType())(quoted(text))
    out = docs.withColumn(text, new)
    for field in docs.schema.fields:
        if field.name == n_chars and isinstance(field.dataType, (T.LongType, T.IntegerType)):
            out = out.withColumn(n_chars, F.when(quoted(text).isNull(), quoted(n_chars)).otherwise(F.length(quoted(text)).cast(field.dataType)))
    return out
