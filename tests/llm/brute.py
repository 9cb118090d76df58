"""Plain versions of the operators, one row after the other."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from functools import lru_cache
from statistics import NormalDist

import numpy as np

from lexigrid.llm import secret_scan
from lexigrid.llm.common import utf8_parts  # noqa: F401

MASK = (1 << 64) - 1


def hashes_of(spark, texts: list[str]) -> dict[str, int]:
    """Spark's xxhash64 of each text."""
    from pyspark.sql import functions as F

    own = sorted(set(texts))
    if not own:
        return {}
    return {r["t"]: r["h"] for r in spark.createDataFrame([(t,) for t in own], "t string").select("t", F.xxhash64("t").alias("h")).collect()}


def chunk_borders(hashes: list[int], window: int, divisor: int) -> list[tuple[int, int]]:
    cuts = [0]
    for i in range(window, len(hashes)):
        roll = 0
        for back in range(window):
            h = hashes[i - back - 1] & MASK
            roll ^= (h << back | h >> (64 - back)) & MASK if back else h
        signed = roll - (1 << 64) if roll >> 63 else roll
        if signed % divisor == 0:
            cuts.append(i)
    return list(zip(cuts, [*cuts[1:], len(hashes)], strict=True))


def line_dedup(spark, rows: list[tuple], window: int = 2, divisor: int = 3, min_lines: int = 2) -> dict[tuple, str]:
    """(doc_id, text) to the new text."""
    docs = {(i, t) for i, t in rows if t is not None}
    known = hashes_of(spark, [x for _, t in docs for x in t.split("\n")])
    whole = hashes_of(spark, [t for _, t in docs])
    at: dict[str, list] = defaultdict(list)
    for i, t in docs:
        lines = t.split("\n")
        for a, b in chunk_borders([known[x] for x in lines], window, divisor):
            if b - a >= min_lines:
                at["\n".join(lines[a:b])].append(((i is not None, i if i is not None else 0, whole[t], a), (i, t), range(a, b)))
    gone: dict[tuple, set[int]] = defaultdict(set)
    for places in at.values():
        for _, doc, lines in sorted(places, key=lambda p: p[0])[1:]:
            gone[doc].update(lines)
    return {d: "\n".join(x for k, x in enumerate(d[1].split("\n")) if k not in gone[d]) for d in docs}


def _mixed(h: int) -> int:
    h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & MASK
    h = (h ^ h >> 27) * 0x94D049BB133111EB & MASK
    return h ^ h >> 31


def _hashed(raw: bytes) -> int:
    odd = 0x9E3779B97F4A7C15
    return _mixed(sum((c + 1) * pow(odd, k, 1 << 64) for k, c in enumerate(raw)) + len(raw) * 0xD6E8FEB86659FD93 & MASK)


def fingerprint(text: str) -> int:
    """The 256-bit SimHash of a text, bit after bit: the operator's definition once more, in plain Python."""
    raw = "".join(c.lower() if c.isascii() or "\xc0" <= c <= "\xde" and c != "\xd7" else c for c in text).encode()
    words = re.findall(rb"[0-9A-Za-z\x80-\xff]+", raw)
    words = {w for w in words if len(w) >= 4} or set(words)
    features = {_hashed(w) for w in words} or {_hashed(text.encode()) if text else 0x1234567}
    out = 0
    for bit in range(256):
        part = 0x9E3779B97F4A7C15 * (bit // 64 + 1)
        if sum(1 if _mixed(f + part & MASK) >> bit % 64 & 1 else -1 for f in features) > 0:
            out |= 1 << bit
    return out


def prints(texts: list[str]) -> np.ndarray:
    """uint16 [texts, 16]"""
    known: dict[str, bytes] = {}
    for t in texts:
        if t not in known:
            known[t] = fast_fingerprint(t)
    return np.frombuffer(b"".join(known[t] for t in texts), np.uint16).reshape(-1, 16)


def fast_fingerprint(text: str) -> bytes:
    """As fingerprint, with a table of the features' bits (held against it by a test)."""
    raw = "".join(c.lower() if c.isascii() or "\xc0" <= c <= "\xde" and c != "\xd7" else c for c in text).encode()
    words = re.findall(rb"[0-9A-Za-z\x80-\xff]+", raw)
    words = {w for w in words if len(w) >= 4} or set(words)
    features = [_bits(w) for w in words] or [_bits_of(_hashed(text.encode()) if text else 0x1234567)]
    return np.packbits(2 * np.sum(features, axis=0, dtype=np.int64) > len(features), bitorder="little").tobytes()


@lru_cache(1 << 18)
def _bits(word: bytes) -> np.ndarray:
    return _bits_of(_hashed(word))


def _bits_of(f: int) -> np.ndarray:
    raw = b"".join(_mixed(f + 0x9E3779B97F4A7C15 * (w + 1) & MASK).to_bytes(8, "little") for w in range(4))
    return np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")


def near_groups(texts: list[str], tau: int) -> list[int]:
    """For each text the first text of its group; all pairs are compared."""
    fps = prints(texts)
    root = list(range(len(texts)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(texts)):
        far = np.bitwise_count(fps[i + 1 :] ^ fps[i]).sum(axis=1)
        for j in np.flatnonzero(far <= tau):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def near_pairs_count(texts: list[str], tau: int) -> set[tuple[int, int]]:
    fps = prints(texts)
    return {(i, i + 1 + int(j)) for i in range(len(texts)) for j in np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]).sum(axis=1) <= tau)}


def repeated_intervals(spark, rows: list[tuple], window: int) -> Counter:
    """(doc_id, start, end, kept) of the tokens in windows that occur at least twice, by whether a first occurrence covers them."""
    known = hashes_of(spark, [t for _, t in rows if t is not None])
    at: dict[tuple, list] = defaultdict(list)
    own = []
    copy: Counter = Counter()
    for i, t in rows:
        if t is None:
            continue
        words = [w for w in re.split(r"[ \t\n\v\f\r]+", t) if w]
        rank = (i is not None, i or 0, known[t], copy[i, t])
        copy[i, t] += 1
        grams = [tuple(words[k : k + window]) for k in range(len(words) - window + 1)]
        for k, g in enumerate(grams):
            at[g].append((rank[:3], k, rank[3]))
        own.append((i, rank, grams))
    first = {g: min(places) for g, places in at.items() if len(places) > 1}
    out: Counter = Counter()
    for i, rank, grams in own:
        kind: dict[int, bool] = {}
        for k, g in enumerate(grams):
            if g in first:
                mine = first[g] == (rank[:3], k, rank[3])
                for token in range(k, k + window):
                    kind[token] = kind.get(token, False) or mine
        start = None
        for token in sorted(kind):
            if start is None or token - 1 not in kind or kind[token] != kind[token - 1]:
                start = token
            if kind.get(token + 1) != kind[token]:
                out[i, start, token + 1, kind[token]] += 1
    return out


def redacted(text: str, mark: str = "[SECRET]") -> str:
    raw = text.encode()
    spans = sorted(m.span() for r in secret_scan.RULES for m in re.finditer(r.pattern.encode(), raw))
    out, at = b"", 0
    for a, b in spans:
        if a >= at:
            out += raw[at:a] + mark.encode()
        at = max(at, b)
    return (out + raw[at:]).decode()


def classes(x: np.ndarray, ids: list[int], threshold: float) -> list[tuple[int, int, int]]:
    """(id, least id of the connected component, other rows at or above threshold) of each row; all pairs are compared."""
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    close = unit @ unit.T >= threshold
    out = []
    for k in range(len(x)):
        met, todo = {k}, [k]
        while todo:
            for j in np.flatnonzero(close[todo.pop()]).tolist():
                if j not in met:
                    met.add(j)
                    todo.append(j)
        out.append((ids[k], min(ids[j] for j in met), int(close[k].sum()) - 1))
    return out


def folded_words(text: str) -> list[bytes]:
    raw = "".join(c.lower() if c.isascii() or "\xc0" <= c <= "\xde" and c != "\xd7" else c for c in text).encode()
    return re.findall(rb"[0-9A-Za-z\x80-\xff]+", raw)


def g_squared(bad: int, good: int, n_bad: int, n_good: int) -> float:
    total, n = 0.0, n_bad + n_good
    for seen, group in ((bad, n_bad), (good, n_good)):
        for x, of in ((seen, bad + good), (group - seen, n - bad - good)):
            if x:
                total += x * math.log(x / (of * group / n))
    return 2 * total


def toxicity(rows: list[tuple[int, str]], labels: dict[int, int], floor: float) -> tuple[dict[int, float], dict[int, float]]:
    """Term hash to polarity, and doc_id to score, by the definitions in the operator's docstring; one text after the other."""
    from lexigrid.llm import toxicity as op

    texts = {i: folded_words(t) for i, t in rows}
    seen, bad, good = Counter(), Counter(), Counter()
    for i, words in texts.items():
        for w in set(words):
            seen[w] += 1
            bad[w] += labels.get(i) == 1
            good[w] += labels.get(i) == 0
    n, n_bad, n_good = len(rows), sum(labels.get(i) == 1 for i in texts), sum(labels.get(i) == 0 for i in texts)
    tests = sum(b > 0 for b in bad.values())
    lean, seed = (NormalDist().inv_cdf(1 - min(0.5, f / tests)) ** 2 if f / tests < 0.5 else 0.0 for f in (op.LEAN_FALSE, op.SEED_ERROR))
    g = {w: g_squared(bad[w], good[w], n_bad, n_good) for w in seen}
    odds = {w: math.log((bad[w] + 0.5) / (n_bad - bad[w] + 0.5)) - math.log((good[w] + 0.5) / (n_good - good[w] + 0.5)) for w in seen}
    nodes = sorted(w for w in seen if odds[w] > 0 and g[w] >= lean or op.NODE_SHARE <= seen[w] / n <= op.NODE_MAX)
    pairs: Counter = Counter()
    known = set(nodes)
    own = {i: [w for w in words if w in known] for i, words in texts.items()}
    for words in own.values():
        for k, a in enumerate(words):
            for b in words[k + 1 : k + 1 + op.WINDOW]:
                if a != b:
                    pairs[min(a, b), max(a, b)] += 1
    margin: Counter = Counter()
    for (a, b), c in pairs.items():
        margin[a] += c
        margin[b] += c
    total = sum(margin.values())
    edges = {p: math.log(c * total / (margin[p[0]] * margin[p[1]])) for p, c in pairs.items() if c >= op.MIN_COUNT}
    edges = {p: w for p, w in edges.items() if w > 0}
    out: Counter = Counter()
    for (a, b), w in edges.items():
        out[a] += w
        out[b] += w
    visits = []
    for start in ({w: g[w] for w in nodes if g[w] >= seed and odds[w] >= op.SEED_ODDS}, {w: 1.0 for w in nodes if odds[w] <= 0}):
        whole = sum(start.values()) or 1
        start = {w: x / whole for w, x in start.items()}
        p = dict(start)
        for _ in range(op.STEPS):
            moved: dict = defaultdict(float)
            for (a, b), w in edges.items():
                moved[b] += p.get(a, 0) / out[a] * w
                moved[a] += p.get(b, 0) / out[b] * w
            stuck = sum(x for w, x in p.items() if not out[w])
            p = {w: op.RESTART * start.get(w, 0) + (1 - op.RESTART) * (moved[w] + stuck * start.get(w, 0)) for w in nodes}
        visits.append(p)
    polarity = {w: (visits[0][w] - visits[1][w]) / (visits[0][w] + visits[1][w] + 1 / len(nodes)) for w in nodes}
    clear = {w: x for w, x in polarity.items() if abs(x) >= floor}
    sums = {i: sum(clear.get(w, 0) for w in words) for i, words in texts.items()}
    mass = {i: sum(clear.get(w, 0) ** 2 for w in words) for i, words in texts.items()}
    clean = [i for i in texts if labels.get(i) == 0]
    words = sum(len(texts[i]) for i in clean) or 1
    mean, spread = sum(sums[i] for i in clean) / words, sum(mass[i] for i in clean) / words
    scores = {i: (sums[i] - len(t) * mean) / math.sqrt(1 + len(t) * spread) for i, t in texts.items()}
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    return {signed(_hashed(w)): x for w, x in polarity.items()}, scores
