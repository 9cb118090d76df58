"""Best-fit packing (operator 5): a configuration linear program over the length histogram.

Texts longer than the capacity are cut into full pieces and a rest. The pieces' lengths, in classes of `unit` (rounded up), make a
histogram of bounded size; over it the driver solves, approximately, "fewest bins such that the configurations used hold all pieces" by
multiplicative weights: a class's price falls exponentially with how far it is covered, the best configuration at these prices is a
knapsack found by dynamic programming, and gets a step's worth of bins. The fractional solution is rounded down; what is left goes
best-fit, longest first. Pieces are then dealt to the bins' places by their rank within their class, in a distributed way.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrid.llm.common import SPACE, blocks, quoted, runs, utf8_parts, written

#: PART_ROWS: pieces of one class that one task ranks, about; MOST: rows of a table that is broadcast.
CAPACITY, CLASSES, STEPS, EPSILON, PART_ROWS, MOST = 2048, 512, 2000, 0.05, 1 << 16, 1 << 20

Pattern = tuple[tuple[int, int], ...]


def best_configuration(prices: np.ndarray, capacity: int) -> Pattern:
    """The multiset of classes (sizes 1 .. capacity, prices[size]) of the largest total price that fits: ((size, count), ...)."""
    best, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    sizes = np.flatnonzero(prices > 0)
    cost = prices[sizes]
    upto = np.searchsorted(sizes, np.arange(capacity + 1), "right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        n = upto[room]
        if n:
            value = cost[:n] + best[room - sizes[:n]]
            k = int(value.argmax())
            if value[k] > best[room]:
                best[room], choice[room] = value[k], sizes[k]
    room, used = capacity, Counter()
    while room > 0:
        if choice[room]:
            used[int(choice[room])] += 1
            room -= int(choice[room])
        else:
            room -= 1
    return tuple(sorted(used.items()))


def fractional(histogram: dict[int, int], capacity: int, steps: int = STEPS, epsilon: float = EPSILON) -> dict[Pattern, float]:
    """Bins for each configuration, of which about (1 + epsilon) times the fewest cover the histogram."""
    need = np.zeros(capacity + 1)
    for size, n in histogram.items():
        need[size] = n
    live = need > 0
    if not live.any():
        return {}
    share = np.where(live, 1 / np.where(live, need, 1), 0)
    step = (1 + epsilon) * max(1.0, float((need * np.arange(capacity + 1)).sum()) / capacity) / steps
    rate = math.log(max(2, int(live.sum()))) / epsilon
    covered, out = np.zeros(capacity + 1), Counter()
    for _ in range(2 * steps):
        open_ = live & (covered < 1)
        if not open_.any():
            break
        weight = np.where(open_, np.exp(-rate * (covered - covered[open_].min())), 0)
        pattern = best_configuration(weight * share, capacity)
        bins = max(step, 1.0) if all(need[s] < n * step for s, n in pattern) else step
        for size, n in pattern:
            covered[size] += n * bins * share[size]
        out[pattern] += bins
    return dict(out)


def best_fit(left: dict[int, int], capacity: int) -> Counter:
    """Best fit decreasing: configurations and how often."""
    by_room: dict[int, list[Counter]] = {}
    for size in sorted(left, reverse=True):
        for _ in range(left[size]):
            room = next((r for r in range(size, capacity + 1) if by_room.get(r)), None)
            used = by_room[room].pop() if room is not None else Counter()
            used[size] += 1
            by_room.setdefault((capacity if room is None else room) - size, []).append(used)
    return Counter(tuple(sorted(c.items())) for each in by_room.values() for c in each)


def plan(histogram: dict[int, int], capacity: int, steps: int = STEPS, epsilon: float = EPSILON) -> list[tuple[Pattern, int]]:
    """Configurations and whole numbers of bins that hold just the histogram's pieces."""
    left = Counter({s: n for s, n in histogram.items() if n > 0})
    out: Counter = Counter()
    if left[capacity]:
        out[((capacity, 1),)] = left.pop(capacity)
    for pattern, bins in sorted(fractional(left, capacity, steps, epsilon).items(), key=lambda x: (-x[1], x[0])):
        whole = min([int(bins), *(left[s] // n for s, n in pattern)])
        if whole:
            out[pattern] += whole
            left.subtract({s: n * whole for s, n in pattern})
    for pattern, bins in best_fit(+left, capacity).items():
        out[pattern] += bins
    return sorted(out.items())


def _bin_of(patterns: list[tuple[Pattern, int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each class: the first rank, items in a bin and first bin of each configuration that holds it."""
    at: Counter = Counter()
    rows: dict[int, list[tuple[int, int, int]]] = {}
    first = 0
    for pattern, bins in patterns:
        for size, n in pattern:
            rows.setdefault(size, []).append((at[size], n, first))
            at[size] += n * bins
        first += bins
    return {size: tuple(np.array(c, np.int64) for c in zip(*r, strict=True)) for size, r in rows.items()}


def words(text: Column) -> Column:
    """White-space separated words, counted a block of texts at a time."""

    def run(texts: pa.Array) -> pa.Array:
        data, offsets = utf8_parts(texts)
        out = [np.empty(0, np.int64)]
        for a, b in blocks(offsets):
            *_, rows = runs(~SPACE[data[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a])
            out.append(np.bincount(rows, minlength=b - a))
        return pa.array(np.concatenate(out), mask=texts.is_null().to_numpy(zero_copy_only=False))

    return F.arrow_udf(run, T.LongType())(text)


def pack(docs: DataFrame, capacity: int = CAPACITY, doc_id: str = "doc_id", length: Column | None = None, text: str = "text", classes: int = CLASSES, part_rows: int = PART_ROWS) -> DataFrame:
    """A row (bin_id, doc_id, piece, start, length) for each piece of each text; a bin's lengths sum to capacity at most.

    length is the text's length in tokens, words by default; the texts are read once, for it. Texts of null or of length 0 have no piece.
    Very long texts: as many full pieces as they hold, and the rest. Repeated rows: packed as often as they come. Null doc_id: packed, stays
    null. Ties in length: dealt by doc_id, so that the result is the same whatever the partitions. Empty table: empty result. Other
    columns: unread. A class with many pieces is ranked in parts, as many as the number of pieces asks for.
    """
    unit = max(1, capacity // classes)
    room = capacity // unit
    size = F.coalesce(words(quoted(text)) if length is None else length, F.lit(0)).cast("long")
    base = written(docs.select(quoted(doc_id).alias("doc_id"), size.alias("n")).where("n > 0"), "lengths")
    pieces = base.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {capacity}"))).alias("piece"))
    pieces = pieces.select("doc_id", F.col("piece").cast("int").alias("piece"), (F.col("piece") * capacity).alias("start"), F.least(F.lit(capacity).cast("long"), F.col("n") - F.col("piece") * capacity).cast("int").alias("length"))
    # a full piece fills its bin even if the classes don't divide the capacity
    pieces = pieces.withColumn("size", F.when(F.col("length") > (room - 1) * unit, room).otherwise(F.expr(f"cast((length + {unit - 1}) div {unit} as int)")))
    salt = max(1, math.ceil((base.agg(F.sum(F.expr(f"(n - 1) div {capacity} + 1"))).first()[0] or 0) / part_rows))
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salt)).cast("int"))
    counts = written(pieces.groupBy("size", "part").agg(F.count("*").alias("n")), "histogram")
    histogram = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect()}  # a row for each class
    tables = _bin_of(plan(histogram, room))
    before = counts.select("size", "part", F.expr("coalesce(sum(n) OVER (PARTITION BY size ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("before"))

    def bins(size: pa.Array, rank: pa.Array) -> pa.Array:
        s, overall = (x.to_numpy(zero_copy_only=False) for x in (size, rank))
        out = np.empty(len(s), np.int64)
        order = np.argsort(s, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(s[order])) + 1) if len(s) else []:
            first, n, at = tables[int(s[own[0]])]
            k = np.searchsorted(first, overall[own], "right") - 1
            out[own] = at[k] + (overall[own] - first[k]) // n[k]
        return pa.array(out)

    ranked = pieces.withColumn("rank", F.expr("row_number() OVER (PARTITION BY size, part ORDER BY doc_id, piece, length)").cast("long"))
    small = len(histogram) * salt <= MOST
    placed = ranked.join(F.broadcast(before) if small else before, ["size", "part"])
    return placed.select(F.arrow_udf(bins, T.LongType())("size", F.col("before") + F.col("rank") - 1).alias("bin_id"), "doc_id", "piece", "start", "length")
