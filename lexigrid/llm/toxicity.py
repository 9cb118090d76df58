"""Toxicity (operator 8): a lexicon induced by random walks, and texts scored with it.

Terms are words, case folded. One pass counts, exactly and distributedly, the texts that have each term: all, those labelled toxic, those
labelled clean. A term that labelled toxic texts have more often than clean ones, by a likelihood ratio test, is a toxic seed if chance
would make one such term in the whole vocabulary with a probability of SEED_ERROR at most, and leans to toxic texts if chance would make
LEAN_FALSE of them at most: the bars follow the number of terms tested, so that a small table isn't held to a large one's, nor the reverse.
Nodes of the graph are all terms, however rare or common (NODE_SHARE and NODE_MAX leave none out); clean seeds are those that labelled
clean texts have at least as often as toxic ones. Terms within WINDOW nodes of each other are counted as pairs over all texts;
pairs that occur at least MIN_COUNT times and more often than by chance are edges, weighted by pointwise mutual information. Pairs are
counted in SLICES turns, each with a share of the terms, so that the disk holds the shuffle of one turn only; terms are numbered from the
commonest on, so that sorted pairs lie close together and pack into a byte or two. Two random walks, that restart at the toxic and at the clean seeds, give a term the polarity (toxic - clean) / (toxic + clean); the edges stay
distributed, each step is a pass over them whose sums the executors make. A text's score is the sum of its terms' polarities, on
either side, from a floor on, set against what clean texts of its length have. The floor and the threshold that give the best F1 on all
labelled texts decide. How high polarities are depends on the graph: the more texts tell of a word's company, the closer to 1 are toxic words
and many others. So the floors to choose from are FLOORS and, above these, cuts between the terms of the highest polarities (`floors_of`).

On the driver are the nodes, so the vocabulary with some numbers for each term: it grows with the texts. Nothing depends on how the table
is cut into files or partitions.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrid.llm.common import WORD, blocks, fold, mix, quoted, runs, size_in_bytes, token_hashes, utf8_parts, written

MIN_SHARE, MAX_SHARE, NODE_SHARE, NODE_MAX = 0.0, 1.0, 0.0, 1.0
WINDOW, MIN_COUNT, RESTART, STEPS = 5, 5, 0.3, 10
#: Polarities from which terms count in scores; the labels choose among these and higher ones, of which each leaves FEWER times as many terms.
FLOORS, FEWER = (0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9), 0.5**0.5
SEED_ERROR, SEED_ODDS, LEAN_FALSE = 0.01, 1.5, 20.0
HELD, HELD_PAIRS, BROADCAST_BYTES = 1 << 20, 1 << 22, 16 << 20
#: Turns in which pairs are counted. Blocks of the pairs' commoner terms: of FINE for the COMMON commonest terms, of COARSE for the rest.
SLICES, COMMON, FINE, COARSE = 4, 1 << 12, 16, 1 << 12
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The files of a query's shuffles go when the query ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


@contextmanager
def _shared(spark: SparkSession, value: object) -> Iterator[Broadcast]:
    """value on the executors; its copies go at the end."""
    held = spark.sparkContext.broadcast(value)
    try:
        yield held
    finally:
        held.destroy()


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, and starts, ends, rows and hashes of the terms."""
    folded = fold(data)
    starts, ends, rows = runs(WORD[data], offsets)
    return folded, starts, ends, rows, token_hashes(folded, starts, ends)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, rising, and the sums of their counts."""
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k)
    k = k[order]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.empty(0, np.int64)
    return k[first], np.add.reduceat(c[order], first) if len(k) else c


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each term the texts of the partition that have it: all, labelled toxic, labelled clean."""
    keys, counts = [np.empty(0, np.uint64)], [np.empty((0, 3), np.int64)]
    for batch in batches:
        data, offsets = utf8_parts(batch.column("text"))
        label = batch.column("toxic").fill_null(-1).to_numpy(zero_copy_only=False)
        for a, b in blocks(offsets):
            *_, rows, hashes = terms(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            _, once = np.unique(hashes ^ mix(rows.astype(np.uint64)), return_index=True)
            u, at = np.unique(hashes[once], return_inverse=True)
            own = label[a:b][rows[once]]
            keys.append(u)
            counts.append(np.stack([np.bincount(at[x], minlength=len(u)) for x in (own >= -1, own > 0, own == 0)], axis=1))
            if len(keys) > 8:
                k, c = _summed(keys, counts)
                keys, counts = [k], [c]
                if len(k) > HELD:
                    yield _counted(k, c)
                    keys, counts = [k[:0]], [c[:0]]
    yield _counted(*_summed(keys, counts))


def _counted(u: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), *[pa.array(x) for x in c.T.copy()]], ["hash", "n", "bad", "good"])


def significance(tests: int, false: float) -> float:
    """The G squared (one degree of freedom, one side) that so many tests reach by chance `false` times."""
    share = min(0.5, false / max(tests, 1))
    return NormalDist().inv_cdf(1 - share) ** 2 if share < 0.5 else 0.0


def _leaning(ratio: np.ndarray, odds: np.ndarray, bar: float) -> np.ndarray:
    return (odds > 0) & (ratio >= bar)


def _nodes(n: int, n_bad: int, n_good: int, bar: float, min_share: float, max_share: float):
    """The rows of counts that are nodes of the graph."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, bad, good = (batch.column(c).to_numpy() for c in ("n", "bad", "good"))
            share = seen / max(n, 1)
            leans = _leaning(*likelihood_ratio(bad, good, n_bad, n_good), bar) & (share >= min_share) & (share <= max_share)
            yield batch.filter(pa.array(leans | ((share >= NODE_SHARE) & (share <= NODE_MAX))))

    return run


def _encoded(held: Broadcast):
    """Texts as the numbers (int32) of their terms that are among the hashes, and their number of terms. held: hashes, sorted, and their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, numbers = held.value
        for batch in batches:
            data, offsets = utf8_parts(batch.column("text"))
            for i, j in blocks(offsets, 1 << 24):
                own, rows = [], []
                for a, b in blocks(offsets[i : j + 1]):
                    *_, r, h = terms(data[offsets[i + a] : offsets[i + b]], offsets[i + a : i + b + 1] - offsets[i + a])
                    own.append(h)
                    rows.append(r + a)
                seen, rows = pa.array(np.concatenate(own)).dictionary_encode(), np.concatenate(rows)
                words, number = seen.dictionary.to_numpy(), np.full(len(seen.dictionary), -1, np.int32)
                if len(hashes):
                    at = np.minimum(np.searchsorted(hashes, words), len(hashes) - 1)
                    number = np.where(hashes[at] == words, numbers[at], number)
                number = number[seen.indices.to_numpy()]
                hit = number >= 0
                ends = np.append(0, 4 * np.cumsum(np.bincount(rows[hit], minlength=j - i))).astype(np.int32)
                seq = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(ends), pa.py_buffer(number[hit])])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), seq, pa.array(np.bincount(rows, minlength=j - i).astype(np.int32))], ["doc_id", "seq", "size"])

    return run


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' numbers and their rows."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.empty(0, np.int32), np.empty(0, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    return data.view(np.int32), np.repeat(np.arange(len(column)), np.diff(offsets) // 4)


def _near(values: np.ndarray, rows: np.ndarray, d: int) -> np.ndarray:
    """Which terms have another one d places on in their text."""
    return (rows[:-d] == rows[d:]) & (values[:-d] != values[d:])


def _margins(size: int, window: int):
    """Of each node the pairs that it is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            values, rows = _flat(batch.column("seq"))
            pairs = np.zeros(len(values), np.int64)
            for d in range(1, window + 1):
                ok = _near(values, rows, d)
                pairs[:-d] += ok
                pairs[d:] += ok
            np.add.at(total, values, pairs)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["node", "n"])

    return run


def _planes(x: np.ndarray) -> tuple[int, bytes]:
    """Whole numbers as their lowest bytes, then their second ones, as far as the greatest needs; and how many these are."""
    k = max(1, -(-int(x.max()).bit_length() // 8))
    return k, x.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :k].T.tobytes()


def _from_planes(raw: np.ndarray) -> np.ndarray:
    out = np.zeros(raw.shape[1], np.int64)
    for k, plane in enumerate(raw):
        out |= plane.astype(np.int64) << 8 * k
    return out


def _pressed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """The steps between rising keys, and their counts."""
    (k, steps), (c, n) = _planes(np.diff(keys, prepend=keys[0])), _planes(counts)
    z = zlib.compressobj(1, strategy=zlib.Z_RLE)
    return bytes([k, c]) + z.compress(steps + n) + z.flush()


def _unpressed(first: int, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zlib.decompress(data[2:]), np.uint8).reshape(data[0] + data[1], -1)
    return np.cumsum(_from_planes(raw[: data[0]])) + first, _from_planes(raw[data[0] :])


def _packed(keys: list[np.ndarray], size: int) -> pa.RecordBatch:
    """The distinct keys (pairs) and how often they are there, compressed by blocks of their first terms."""
    k = np.concatenate(keys)
    k.sort()
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    u, c = k[first], np.diff(first, append=len(k))
    low = u // size
    block = np.where(low < COMMON, low // FINE, COMMON // FINE + (low - COMMON) // COARSE)
    cuts = np.append(np.flatnonzero(np.diff(block, prepend=-1)), len(u))
    rows = [(int(block[i]), int(u[i]), _pressed(u[i:j], c[i:j])) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], ["block", "first", "data"])


def _pairs(size: int, window: int, turn: int):
    """Counts of pairs of nodes near each other whose commoner one is of this turn. At most about HELD_PAIRS pairs are held at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held = [], 0
        for batch in batches:
            for part in range(0, batch.num_rows, 500):
                values, rows = _flat(batch.column("seq").slice(part, 500))
                for d in range(1, window + 1):
                    low = np.minimum(values[:-d], values[d:])
                    ok = np.flatnonzero(_near(values, rows, d) & (low % SLICES == turn))
                    keys.append(low[ok].astype(np.int64) * size + np.maximum(values[ok], values[ok + d]))
                    held += len(ok)
                if held > HELD_PAIRS:
                    yield _packed(keys, size)
                    keys, held = [], 0
        if held:
            yield _packed(keys, size)

    return run


def _merged(size: int, min_count: int):
    """Of sorted blocks the pairs that occur often enough."""

    def ended(keys: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        k, c = _summed(keys, counts)
        k, c = k[c >= min_count], c[c >= min_count]
        return pa.RecordBatch.from_arrays([pa.array((k // size).astype(np.int32)), pa.array((k % size).astype(np.int32)), pa.array(c)], ["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, counts, held, most = None, [], [], 0, HELD
        for batch in batches:
            for block, first, data in zip(*(batch.column(c).to_pylist() for c in ("block", "first", "data")), strict=True):
                if now is not None and block != now:
                    yield ended(keys, counts)
                    keys, counts, held, most = [], [], 0, HELD
                now = block
                k, c = _unpressed(first, data)
                keys.append(k)
                counts.append(c)
                held += len(k)
                if held > most:
                    u, n = _summed(keys, counts)
                    keys, counts, held, most = [u], [n], len(u), max(HELD, 2 * len(u))
        if now is not None:
            yield ended(keys, counts)

    return run


def _weighed(held: Broadcast):
    """The edges among pairs (a, b, n), between places among the linked nodes, many to a row. held: these, their totals of pairs, and that of all nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        linked, margin, whole = held.value
        for batch in batches:
            a, b = (np.searchsorted(linked, batch.column(c).to_numpy()) for c in ("a", "b"))
            w = np.log(batch.column("n").to_numpy() * whole / (margin[a] * margin[b]))
            some = w > 0
            yield pa.RecordBatch.from_arrays([pa.array([x[some].tobytes()], pa.binary()) for x in (a.astype(np.int32), b.astype(np.int32), w)], ["a", "b", "w"])

    return run


def likelihood_ratio(bad: np.ndarray, good: np.ndarray, n_bad: int, n_good: int) -> tuple[np.ndarray, np.ndarray]:
    """G squared of each term's counts in toxic and clean texts, and the logarithm of the odds ratio."""
    n = max(1, n_bad + n_good)
    total = np.zeros(len(bad))
    for seen, group in ((bad, n_bad), (good, n_good)):
        for x, share in ((seen, (bad + good) / n), (group - seen, 1 - (bad + good) / n)):
            expected = share * group
            total += np.where(x > 0, x * np.log(np.maximum(x, 1e-9) / np.maximum(expected, 1e-9)), 0)
    odds = np.log((bad + 0.5) / (n_bad - bad + 0.5)) - np.log((good + 0.5) / (n_good - good + 0.5))
    return 2 * total, odds


def _spread(held: Broadcast):
    """One step: what each term gets over its edges, summed in a partition. held: the state, a column for each walk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = [x.copy() for x in held.value.T]
        moved = [np.zeros_like(x) for x in state]
        for a, b, w in (x for batch in batches for x in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "w")), strict=True)):
            a, b, w = np.frombuffer(a, np.int32).astype(np.intp), np.frombuffer(b, np.int32).astype(np.intp), np.frombuffer(w)
            for own, to in zip(state, moved, strict=True):
                np.add.at(to, b, own[a] * w)
                np.add.at(to, a, own[b] * w)
        some = np.flatnonzero((moved[0] != 0) | (moved[1] != 0))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *[pa.array(x[some]) for x in moved]], ["node", "m0", "m1"])

    return run


def walks(edges: DataFrame, linked: np.ndarray, starts: list[np.ndarray], restart: float = RESTART, steps: int = STEPS) -> np.ndarray:
    """Visits [terms, 2] of two random walks over the weighted edges (a, b, w) that restart at each term in proportion to their start.

    A row has many edges, as int32, int32 and float64; a and b are places in linked, the terms that edges may have; visits of all others stay in proportion to their start. A step is one
    job; the partitions' sums are added by the executors, and the driver gets one row for each linked term.
    """
    start = np.stack([x / max(x.sum(), 1e-300) for x in starts], axis=1)
    own = start[linked]
    start[linked] = 0
    alone = start.sum(axis=0)

    def passed(state: np.ndarray) -> np.ndarray:
        out = np.zeros_like(state)
        with _shared(edges.sparkSession, state) as held:
            rows = edges.mapInArrow(_spread(held), "node int, m0 double, m1 double").groupBy("node").agg(F.sum("m0"), F.sum("m1")).toArrow()
        out[rows.column(0).to_numpy()] = np.stack([rows.column(k).to_numpy() for k in (1, 2)], axis=1)
        return out

    out = passed(np.ones_like(own))[:, :1]  # the weight of each term's edges
    p, others = own.copy(), np.ones(2)
    for _ in range(steps):
        moved = passed(np.divide(p, out, out=np.zeros_like(p), where=out > 0))
        stuck = np.where(out > 0, 0, p).sum(axis=0) + others * alone
        p = restart * own + (1 - restart) * (moved + stuck * own)
        others = restart + (1 - restart) * stuck
    start *= others
    start[linked] = p
    return start


class Lexicon:
    """hashes of the terms, the commonest first, and their weights in [-1, 1]."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray):
        self.hashes, self.weights = hashes, weights


def lexicon_terms(docs: DataFrame, lexicon: Lexicon, least: float = 0.8) -> DataFrame:
    """(term, weight) of the terms of at least this weight, as docs spell them: a pass over the texts, for reports."""
    own = np.flatnonzero(lexicon.weights >= least)
    own = own[np.argsort(lexicon.hashes[own])]
    hashes, weights = lexicon.hashes[own], lexicon.weights[own]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_parts(batch.column("text"))
            for a, b in blocks(offsets):
                folded, starts, ends, _, found = terms(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                u, first = np.unique(found, return_index=True)
                hit = np.flatnonzero(np.isin(u, hashes))
                names = [folded[starts[first[i]] : ends[first[i]]].tobytes().decode(errors="replace") for i in hit]
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(weights[np.searchsorted(hashes, u[hit])])], ["term", "weight"])

    return docs.where(F.col("text").isNotNull()).select("text").mapInArrow(run, "term string, weight double").distinct()


def _told(labels: DataFrame) -> DataFrame:
    told = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    return F.broadcast(told) if size_in_bytes(labels.select("doc_id", "toxic")) <= BROADCAST_BYTES else told


def induce(docs: DataFrame, labels: DataFrame, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> tuple[DataFrame, Lexicon]:
    """The encoded texts (doc_id, seq, size), whose numbers index the lexicon's polarities, and the lexicon.

    With too few labels for any term to be a toxic seed all polarities are 0.
    """
    with _shuffles_dropped(docs.sparkSession):
        return _induced(docs, labels, min_share, max_share)


def _induced(docs: DataFrame, labels: DataFrame, min_share: float, max_share: float) -> tuple[DataFrame, Lexicon]:
    spark, texts = docs.sparkSession, docs.where(F.col("text").isNotNull())
    told = texts.join(_told(labels), "doc_id", "left")
    n, *totals = told.agg(F.count("*"), F.count(F.when(F.col("toxic") > 0, 1)), F.count(F.when(F.col("toxic") == 0, 1))).first()
    counts = told.select("text", "toxic").mapInArrow(_term_counts, "hash long, n long, bad long, good long").groupBy("hash").agg(*[F.sum(c).alias(c) for c in ("n", "bad", "good")])
    counts = written(counts.where((F.col("bad") > 0) | (F.col("n") >= F.lit(NODE_SHARE * n))), "terms")
    tests = counts.where("bad > 0").count()
    lean_bar, seed_bar = significance(tests, LEAN_FALSE), significance(tests, SEED_ERROR)
    nodes = counts.mapInArrow(_nodes(n, *totals, lean_bar, min_share, max_share), counts.schema)
    nodes = nodes.select("hash", *[F.col(c).cast("int") for c in ("n", "bad", "good")]).toArrow()  # the vocabulary: see above
    hashes = nodes.column("hash").to_numpy().view(np.uint64)
    order = np.lexsort((hashes, -nodes.column("n").to_numpy()))
    hashes = hashes[order]
    bad, good = (nodes.column(c).to_numpy()[order] for c in ("bad", "good"))
    del nodes, order
    v = len(hashes)
    kind = docs.schema["doc_id"].dataType.simpleString()
    numbers = np.argsort(hashes).astype(np.int32)
    with _shared(spark, (hashes[numbers], numbers)) as held:
        encoded = written(texts.mapInArrow(_encoded(held), f"doc_id {kind}, seq binary, size int"), "encoded", "zstd")
    del numbers, held  # the driver has no room for copies of the vocabulary

    parts = [likelihood_ratio(bad[i : i + HELD], good[i : i + HELD], *totals) for i in range(0, v, HELD)]
    ratio, odds = (np.concatenate([np.empty(0), *x]) for x in (zip(*parts, strict=True) if parts else ((), ())))
    del parts, bad, good
    seeds = np.flatnonzero((ratio >= seed_bar) & (odds >= SEED_ODDS))
    weights = np.zeros(v)
    if len(seeds):
        toxic_start = np.zeros(v)
        toxic_start[seeds] = ratio[seeds]  # surer seeds count more
        starts = [toxic_start, (odds <= 0).astype(float)]
        del ratio, odds, toxic_start
        p = walks(*_edges(encoded, v), starts)
        both = p.sum(axis=1) + 1 / v  # what is hardly visited at all leans to neither side
        weights = np.divide(p[:, 0] - p[:, 1], both, out=np.zeros(v), where=both > 0)
    return encoded, Lexicon(hashes, weights)


def _edges(encoded: DataFrame, v: int) -> tuple[DataFrame, np.ndarray]:
    """The graph's edges (a, b, w), a and b being places in the terms that are returned too."""
    spark = encoded.sparkSession
    totals = encoded.select("seq").mapInArrow(_margins(v, WINDOW), "node int, n long").groupBy("node").agg(F.sum("n").alias("n")).toArrow()  # one row for each node
    margin = np.zeros(v)
    margin[totals.column("node").to_numpy()] = totals.column("n").to_numpy()
    del totals
    counted = []
    for turn in range(SLICES):
        packed = encoded.select("seq").mapInArrow(_pairs(v, WINDOW, turn), "block int, first long, data binary")
        packed = packed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").sortWithinPartitions("block")
        counted.append(written(packed.mapInArrow(_merged(v, MIN_COUNT), "a int, b int, n long"), "pairs"))
    counted = reduce(DataFrame.unionByName, counted)
    linked = np.sort(counted.select(F.explode(F.array("a", "b")).alias("a")).distinct().toArrow().column(0).to_numpy())
    with _shared(spark, (linked, margin[linked], margin.sum())) as held:
        return written(counted.mapInArrow(_weighed(held), "a binary, b binary, w binary"), "edges", "zstd"), linked


def floors_of(weights: np.ndarray, floors: tuple[float, ...] = FLOORS) -> tuple[float, ...]:
    """These floors, rising, after those above them: cuts halfway between two terms, from the highest down, at numbers of terms that grow by 1 / FEWER.

    Of floors that are as good the last one is taken, so the highest of FLOORS or else the lowest of the others.
    """
    top = np.sort(weights[weights >= floors[-1]])[::-1]
    n, cuts = 1.0, []
    while round(n) < len(top):
        cuts.append(round(float(top[round(n) - 1] + top[round(n)]) / 2, 6))  # rounded, so that the last bits of sums part no terms
        n /= FEWER
    return (*sorted({x for x in cuts if x > floors[-1]}, reverse=True), *floors)


def scored(encoded: DataFrame, lexicon: Lexicon, labels: DataFrame, floors: tuple[float, ...] | None = None) -> tuple[DataFrame, float, float]:
    """(doc_id, size, score), the threshold and the floor, of floors_of unless floors are named. A score is the sum of weights, less what
    labelled clean texts have of it for so many terms, in its standard deviation."""
    floors = floors_of(lexicon.weights) if floors is None else floors
    with _shared(encoded.sparkSession, lexicon.weights) as held:

        def sums(power: int):
            def run(seq: pa.Array) -> pa.Array:
                values, rows = _flat(seq)
                own = held.value[values]
                some = np.flatnonzero(np.abs(own) >= min(floors))
                own, rows = own[some], rows[some]
                out = np.zeros((len(seq), len(floors)))
                for i in np.argsort(floors):  # rising, so that each passes fewer terms on
                    some = np.flatnonzero(np.abs(own) >= floors[i])
                    own, rows = own[some], rows[some]
                    out[:, i] = np.bincount(rows, weights=own**power, minlength=len(seq))
                return pa.ListArray.from_arrays(pa.array(np.arange(len(seq) + 1, dtype=np.int32) * len(floors)), pa.array(out.ravel()))

            return F.arrow_udf(run, T.ArrayType(T.DoubleType()))("seq")

        known = written(encoded.select("doc_id", "size", sums(1).alias("total"), sums(2).alias("mass")), "sums", "zstd")
    told = known.join(_told(labels), "doc_id")
    clean = told.where("toxic = 0").agg(F.sum("size").alias("n"), *[F.sum(F.element_at(c, i + 1)).alias(f"{c}{i}") for c in ("total", "mass") for i in range(len(floors))]).first()
    words = max(clean["n"] or 0, 1)

    def score(i: int) -> Column:
        mean, spread = float(clean[f"total{i}"] or 0) / words, float(clean[f"mass{i}"] or 0) / words
        return F.round((F.element_at("total", i + 1) - F.col("size") * mean) / F.sqrt(1 + F.col("size") * spread), 4)

    each = told.select("toxic", F.posexplode(F.array(*[score(i) for i in range(len(floors))])).alias("floor", "score"))
    best, (threshold, _) = max(best_thresholds(each).items(), key=lambda x: (x[1][1], x[0]), default=(0, (float("inf"), 0.0)))
    return known.select("doc_id", "size", score(best).alias("score")), threshold, floors[best]


def best_thresholds(scores: DataFrame, step: float = 0.005) -> dict[int, tuple[float, float]]:
    """For each floor the score of the best F1 over all labelled texts (floor, score, toxic), and that F1; (inf, 0) if none is labelled toxic."""
    bins = scores.groupBy("floor", F.least(F.floor(F.col("score") / step), F.lit(10000)).cast("int").alias("bin")).agg(F.sum(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("bad"), F.count("*").alias("n"))
    rows = sorted(bins.where("bin > 0").collect(), reverse=True)  # at most 10,000 for each floor
    totals = {r["floor"]: r["bad"] for r in bins.groupBy("floor").agg(F.sum("bad").alias("bad")).collect()}
    best = dict.fromkeys(totals, (float("inf"), 0.0))
    hit, said = dict.fromkeys(totals, 0), dict.fromkeys(totals, 0)
    for r in rows:
        k = r["floor"]
        hit[k], said[k] = hit[k] + r["bad"], said[k] + r["n"]
        f1 = 2 * hit[k] / (totals[k] + said[k])
        if f1 > best[k][1]:
            best[k] = (r["bin"] * step, f1)
    return best


def toxic_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> DataFrame:
    """A row (doc_id, n_terms, score) for each text whose score reaches the threshold.

    Null texts: left out. Empty texts: score 0, not toxic. Very long texts: scored whole. Repeated rows: a row each, of equal scores;
    repeated labels: toxic if one says so. Null doc_id: scored, never labelled. No labels, none toxic, or too few of them for any word to
    stand out: empty result. Empty table: empty result. Other columns: unread.
    """
    base = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    encoded, lexicon = induce(base, labels, min_share, max_share)
    scores, threshold, _ = scored(encoded, lexicon, labels)
    return scores.where(F.col("score") >= F.lit(threshold)).select("doc_id", F.col("size").alias("n_terms"), "score")
