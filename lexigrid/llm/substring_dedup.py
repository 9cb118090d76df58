"""Substring dedup (operator 4): windows of `window` tokens that occur at least twice, merged into maximal intervals.

Tokens are maximal runs of non-white-space bytes. Every window of every text gets a Rabin-Karp hash (a polynomial modulo 2^64 over its
tokens' hashes, rolled by prefix sums). It travels with its anchor, the least hash of the runs of window // 2 tokens in it, which equal
windows share; adjacent windows of one anchor travel as one row, so the rows are about as many as the tokens / 13, and windows that are
repeated agree in both hashes, of 64 bits each. Spark counts: rows whose anchor comes once are left out, the others' windows are counted
by anchor and hash, and a window's first place, by doc_id, is found. A text's repeated windows become intervals.

Hot anchors, those of over 1 / HOT_SHARE of all, are found by a count beforehand, so they are fewer than HOT_SHARE. Their windows travel
one by one, under their own hash, and of equal ones in a block of texts only the first, with their number: a passage that a third of all
texts have sends a row for each block, not for each text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexigrid.llm.common import SPACE, blocks, inverse_powers, mix, powers, quoted, runs, token_hashes, utf8_parts, written

WINDOW = 50
#: Anchors for each task behind the shuffle; windows in a row at most; an anchor is hot beyond this share and number.
PART_ANCHORS, RUN, HOT_SHARE, HOT_LEAST = 70_000, 30, 100_000, 50_000
_NOT_SPACE = ~SPACE


def _grams(prefix: np.ndarray, inverse: np.ndarray, at: np.ndarray | slice, n: int) -> np.ndarray:
    """Hashes of the n tokens from each place, whatever text they are of."""
    return mix((prefix[n:][at] - prefix[: len(prefix) - n][at]) * inverse[: len(prefix) - n][at])


def windows_of(data: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows, text by text: text, place in it, hash, anchor, and the anchor's place among all tokens."""
    starts, ends, rows = runs(_NOT_SPACE[data], offsets)
    tokens = token_hashes(data, starts, ends)
    n = len(tokens)
    count = np.bincount(rows, minlength=len(offsets) - 1)
    inside = np.maximum(count - window + 1, 0)
    text = np.repeat(np.arange(len(inside)), inside)
    place = np.arange(len(text)) - np.repeat(np.cumsum(inside) - inside, inside)
    at = np.repeat(np.cumsum(count) - count, inside) + place
    if not len(at):
        z = np.empty(0, np.uint64)
        return text, place, z, z, at
    prefix = np.concatenate([[np.uint64(0)], np.cumsum(tokens * powers(n)[:n], dtype=np.uint64)])
    inverse = inverse_powers(n + 1)
    k = max(1, window // 2)
    gram = _grams(prefix, inverse, slice(None), k)
    # the leftmost least gram of the window - k + 1 in a window, by doubling
    least, span, wanted = np.arange(len(gram)), 1, window - k + 1
    better = lambda i, j: np.where(gram[i] <= gram[j], i, j)
    while 2 * span <= wanted:
        least = better(least[: len(least) - span], least[span:])
        span *= 2
    anchor = better(least[at], least[at + wanted - span])
    return text, place, _grams(prefix, inverse, at, window), gram[anchor], anchor


def _blocks(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple]:
    for batch in batches:
        data, offsets = utf8_parts(batch.column("text"))
        for a, b in blocks(offsets):
            yield batch, a, windows_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], window)


def _anchors(window: int):
    """The anchors of texts, each place once, counted in blocks; under null their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, (text, _, _, anchor, place) in _blocks(batches, window):
            new = np.ones(len(text), bool)
            new[1:] = place[1:] != place[:-1]
            u, n = np.unique(anchor[new], return_counts=True)
            mask = np.arange(len(u) + 1) == len(u)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(u.view(np.int64), 0), mask=mask), pa.array(np.append(n, n.sum()))], ["a", "n"])

    return run


_ROW = "key long, doc_id long, k long, place int, hashes array<long>, c int"


def _rows(window: int, hot: np.ndarray):
    """Runs of windows with one anchor; windows of hot anchors one by one, the first of equal ones in a block for all (c), the others, which
    are repeated for certain and nowhere first, as rows without a hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, a, (text, place, hashes, anchor, at) in _blocks(batches, window):
            n = len(text)
            if not n:
                continue
            is_hot = np.isin(anchor, hot) if len(hot) else np.zeros(n, bool)
            # runs: of one text, one anchor place, not hot, at most RUN windows
            cold = np.flatnonzero(~is_hot)
            new = np.ones(len(cold), bool)
            new[1:] = (at[cold][1:] != at[cold][:-1]) | (text[cold][1:] != text[cold][:-1]) | (np.diff(cold) != 1)
            begin = np.flatnonzero(new)
            step = np.arange(len(cold)) - np.repeat(begin, np.diff(np.append(begin, len(cold))))
            begin = np.flatnonzero(step % RUN == 0)
            first, ends = cold[begin], np.append(begin, len(cold))
            # hot windows: by doc_id, text hash, place within equal hashes
            own = np.flatnonzero(is_hot)
            ids = batch.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy()[a:][text[own]]
            ks = batch.column("k").to_numpy()[a:][text[own]]
            own = own[np.lexsort((place[own], ks, ids, hashes[own]))]
            lead = np.ones(len(own), bool)
            lead[1:] = hashes[own][1:] != hashes[own][:-1]
            times = np.diff(np.append(np.flatnonzero(lead), len(own)))
            leaders, others = own[lead], own[~lead]
            rows = np.concatenate([first, leaders, others])
            key = np.concatenate([anchor[first], hashes[leaders], mix(at[others].astype(np.uint64) + np.uint64(a))]).view(np.int64)
            flat = np.concatenate([hashes[cold], hashes[leaders]]).view(np.int64)
            cuts = np.concatenate([ends, len(cold) + np.arange(1, len(leaders) + 1), np.full(len(others), len(flat))])
            none = np.arange(len(rows)) >= len(first) + len(leaders)
            lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(flat), mask=pa.array(none))
            take = pa.array(text[rows] + a)
            c = np.concatenate([np.ones(len(first), np.int32), times, np.zeros(len(others), np.int32)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(key), batch.column("doc_id").take(take), batch.column("k").take(take), pa.array(place[rows].astype(np.int32)), lists, pa.array(c)], ["key", "doc_id", "k", "place", "hashes", "c"])

    return run


def merged(places: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A text's repeated windows, rising, and which are first occurrences, as maximal intervals of tokens (starts, ends, kept)."""
    size = int(places[-1]) + window
    cover = np.zeros((2, size + 1), np.int64)
    for row, some in ((0, places), (1, places[first])):
        np.add.at(cover[row], some, 1)
        np.add.at(cover[row], some + window, -1)
    covered, kept = np.cumsum(cover, axis=1)[:, :size] > 0
    kind = np.where(covered, 1 + kept, 0)
    start = np.flatnonzero(np.diff(kind, prepend=0))
    end = np.append(start[1:], size)
    some = kind[start] > 0
    return start[some], end[some], kind[start][some] == 2


def _intervals(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            if not batch.num_rows:
                continue
            lists = zip(*(batch.column(c) for c in ("places", "masks", "kept")), batch.column("copies").to_pylist(), strict=True)
            for i, (places, masks, kept, copies) in enumerate(lists):
                p, m, f = (x.values.to_numpy(zero_copy_only=False) for x in (places, masks, kept))
                bit = np.arange(int(m.max()).bit_length())
                hit = (m[:, None] >> bit & 1).astype(bool)
                at, own = (p[:, None] + bit)[hit], (f[:, None] >> bit & 1).astype(bool)[hit]
                order = np.argsort(at, kind="stable")
                at, own = at[order], own[order]
                u, start = np.unique(at, return_index=True)
                for first, many in ((np.maximum.reduceat(own, start), 1), (np.zeros(len(u), bool), copies - 1)):
                    found = merged(u, first, window) if many else ()
                    for column, values in zip(out, (np.full(len(found[0]), i), *found) if many else (), strict=False):
                        column.append(np.tile(values, many))
            row, start, end, kept = (np.concatenate([np.empty(0, kind), *c]) for c, kind in zip(out, (np.int64, np.int64, np.int64, bool), strict=True))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(end), pa.array(kept)], ["doc_id", "start_token", "end_token", "kept"])

    return run


def repeated_intervals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, hot_least: int = HOT_LEAST) -> DataFrame:
    """A row (doc_id, start_token, end_token, kept) for each maximal interval of a text's tokens in windows that occur at least twice.

    kept: the tokens of windows that occur here first (by doc_id, then the text's hash, then place); they stay. All other intervals are for
    removal: what they hold is kept elsewhere. end_token is exclusive; windows that overlap or touch are one interval, if both are kept or
    both not. Null texts and texts of fewer than `window` tokens have none. Very long texts: whole. Repeated rows (same doc_id and text):
    texts of their own, of which one counts as the first, and rows come out for each. Null doc_id: before all others, stays null. Empty
    table: empty result. Other columns of docs: unread. Windows count as equal if their hashes and anchors (for hot anchors: hashes) are.
    """
    base = docs.select(quoted(doc_id).cast("long").alias("doc_id"), F.xxhash64(quoted(text)).alias("k"), quoted(text).alias("text")).where(F.col("text").isNotNull())
    counts = base.select("text").mapInArrow(_anchors(window), "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))
    counts = written(counts.where((F.col("n") > hot_least) | F.col("a").isNull()), "anchors")
    total = counts.where("a IS NULL").agg(F.sum("n")).first()[0] or 0
    many = counts.where("a IS NOT NULL").where(F.col("n") * HOT_SHARE > total).select("a").toArrow()  # fewer than HOT_SHARE
    hot = many.column("a").to_numpy().astype(np.int64).view(np.uint64)
    parts = int(max(4, total // PART_ANCHORS))
    rows = base.mapInArrow(_rows(window, hot), _ROW).repartition(parts, "key")
    met = rows.withColumn("m", F.sum("c").over(Window.partitionBy("key"))).where("m > 1 OR hashes IS NULL").drop("m")
    each = met.select("key", "doc_id", "k", "place", "c", F.posexplode_outer("hashes").alias("i", "h"))
    same = Window.partitionBy("key", "h")
    at = F.struct("doc_id", "k", F.col("place") + F.col("i"))
    each = each.select("key", "doc_id", "k", "place", "i", "h", F.sum("c").over(same).alias("n"), (at == F.min(at).over(same)).alias("first"))
    bit = F.expr("shiftleft(1, i)")
    each = each.where("h IS NULL OR n > 1").select("key", "doc_id", "k", "place", F.when(F.col("h").isNull(), 1).otherwise(bit).alias("mask"), F.when(F.col("h").isNotNull() & F.col("first"), bit).otherwise(0).alias("kept"))
    packed = each.groupBy("key", "doc_id", "k", "place").agg(F.bit_or("mask").alias("mask"), F.bit_or("kept").alias("kept"))
    texts = packed.groupBy("doc_id", "k").agg(F.collect_list(F.struct("place", "mask", "kept")).alias("l"))
    copies = base.groupBy("doc_id", "k").count().where("count > 1").select(F.col("doc_id").alias("_d"), F.col("k").alias("_k"), F.col("count").cast("int").alias("copies"))
    joined = texts.join(copies, (F.col("k") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_d")), "left")
    lists = joined.select("doc_id", F.col("l.place").alias("places"), F.col("l.mask").alias("masks"), F.col("l.kept").alias("kept"), F.coalesce("copies", F.lit(1)).alias("copies"))
    return lists.mapInArrow(_intervals(window), "doc_id long, start_token long, end_token long, kept boolean")


def drop_repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, text) of docs without the tokens of the intervals for removal; what is left keeps its white space. Texts that lose nothing are
    as they were; rows equal in doc_id lose what either is to lose, so ids should be unique."""
    gone = repeated_intervals(docs, doc_id, text, window).where("NOT kept").groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start_token", "end_token"))).alias("gone"))
    base = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text")).join(gone, "doc_id", "left")

    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = texts.to_pylist()
        for i, own in enumerate(spans.to_pylist()):
            if own and out[i] is not None:
                raw = np.frombuffer(out[i].encode(), np.uint8)
                starts, ends, _ = runs(_NOT_SPACE[raw], np.array([0, len(raw)]))
                keep = np.ones(len(raw), bool)
                for s in own:
                    keep[starts[s["start_token"]] : ends[min(s["end_token"], len(ends)) - 1]] = False
                out[i] = raw[keep].tobytes().decode()
        return pa.array(out, pa.string())

    return base.select("doc_id", F.arrow_udf(cut, "string")("text", "gone").alias("text"))
