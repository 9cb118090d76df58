"""SimHash near-dedup (operator 6) with pigeonring filtering.

A text's features are its distinct words (case folded) of at least MIN_LETTERS bytes; SimHash makes BITS bits of them, seen as a
ring of SEGMENTS segments. Two texts are near duplicates when their fingerprints differ in at most `tau` bits. The pigeonring
principle, for whole numbers: if segments have radii r_i with a sum of tau - SEGMENTS + 1, such a pair has a segment from which each
chain of segments differs in less than the sum of its r_i + 1 bits (were there none, all bits that differ would be tau + 1 at least).
So a pair is met in the buckets of that segment's values that are at most r_i bits apart, its chains of 2 .. CHAIN segments are held to
their budgets, and only then is the full distance counted. All pairs within tau bits are found, none only probably.

Distinct fingerprints are dealt into tiles, and each pair of tiles is compared by one task that probes all values within the radii. A
share of 1,352 in 65,536 of the pairs is looked at for tau = 40, so the work is a small part of all pairs, but grows as their number does.

Groups are the connected components; of each the row with the smallest doc_id stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import WORD, blocks, components, fresh, joined, mix, quoted, token_hashes, utf8_parts, utf8_tokens, written

BITS, SEGMENTS, CHAIN, TAU, MIN_LETTERS = 256, 16, 4, 40, 4
_SIGNS = np.where(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little") > 0, 1.0, -1.0).astype(np.float32)


def margins(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text and bit: features with a 1 there less those with a 0.

    Texts without long words use all words; texts without words, all their bytes as one feature, so that equal texts agree.
    """
    n = len(offsets) - 1
    starts, ends, rows, hashes = utf8_tokens(data, offsets, WORD, True)
    long = ends - starts >= MIN_LETTERS
    without = np.bincount(rows[long], minlength=n) == 0
    use = long | without[rows]
    rows, hashes = rows[use], hashes[use]
    bare = np.flatnonzero(np.bincount(rows, minlength=n) == 0)
    if len(bare):
        full = bare[offsets[bare + 1] > offsets[bare]]
        own = np.full(len(bare), np.uint64(0x1234567))
        own[np.isin(bare, full)] = token_hashes(data, offsets[full], offsets[full + 1])
        rows, hashes = np.concatenate([rows, bare]), np.concatenate([hashes, own])
    _, first = np.unique(hashes ^ mix(rows.astype(np.uint64)), return_index=True)
    rows, hashes = rows[first] * 256, hashes[first]
    out = np.empty((n, BITS), np.float32)
    for word in range(BITS // 64):
        parts = mix(hashes + np.uint64(0x9E3779B97F4A7C15 * (word + 1) % 2**64)).view(np.uint8).reshape(-1, 8)
        for byte in range(8):
            counts = np.bincount(rows + parts[:, byte], minlength=n * 256).reshape(n, 256).astype(np.float32)
            at = word * 64 + byte * 8
            out[:, at : at + 8] = counts @ _SIGNS
    return out


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """uint16 [texts, SEGMENTS] fingerprints and int32 [texts, 2 * SEGMENTS] bucket keys, of which only group_edges makes use; near_edges needs none."""
    n = len(offsets) - 1
    fps, keys = np.empty((n, SEGMENTS), np.uint16), np.empty((n, 2 * SEGMENTS), np.int32)
    width = BITS // SEGMENTS
    for a, b in blocks(offsets):
        m = margins(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        fps[a:b] = np.packbits(m > 0, axis=1, bitorder="little").view(np.uint16)
        unsure = np.abs(m).reshape(b - a, SEGMENTS, width).argmin(axis=2)
        base = np.arange(SEGMENTS, dtype=np.int32) << 16
        keys[a:b, :SEGMENTS] = base | fps[a:b]
        keys[a:b, SEGMENTS:] = base | (fps[a:b] ^ (1 << unsure).astype(np.uint16))
    return fps, keys


def _near(a: np.ndarray, b: np.ndarray, segment: np.ndarray | int, tau: int) -> np.ndarray:
    """Which pairs pass the chains from their segment and then the full distance."""
    alive = np.arange(len(a))
    seg = np.broadcast_to(segment, len(a))
    total = np.bitwise_count(a[alive, seg] ^ b[alive, seg]).astype(np.int16)
    for length in range(2, CHAIN + 1):
        s = (seg[alive] + length - 1) % SEGMENTS
        total = total + np.bitwise_count(a[alive, s] ^ b[alive, s])
        ok = total * SEGMENTS <= length * tau
        alive, total = alive[ok], total[ok]
    full = np.bitwise_count(a[alive] ^ b[alive]).sum(axis=1)
    out = np.zeros(len(a), bool)
    out[alive[full <= tau]] = True
    return out


#: Tiles hold TILE_ROWS fingerprints at most, and there are TILES of them at least; EXHAUSTIVE pairs are compared without probing. In buckets of over TOLD_APART what is connected is left out.
PAIRS_AT_ONCE, LARGE_GROUP, TOLD_APART, TILE_ROWS, TILES, EXHAUSTIVE, MOST_PROBES = 1 << 18, 512, 32, 1 << 18, 8, 1 << 22, 1 << 13
_ONES = np.bitwise_count(np.arange(1 << 16, dtype=np.uint16))


def _large_group(fps: np.ndarray, segment: int, tau: int) -> Iterator[tuple[int, np.ndarray]]:
    """A spanning forest of the group's near pairs, as texts and those reached from them: each meets only what isn't reached yet."""
    rest = np.arange(len(fps))
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            hit = _near(np.broadcast_to(fps[x], (len(rest), SEGMENTS)), fps[rest], segment, tau)
            found = rest[hit]
            if len(found):
                yield x, found
            queue += list(found)
            rest = rest[~hit]


def group_edges(keys: np.ndarray, nodes: np.ndarray, fps: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges between nodes that meet under a key; keys come sorted. A spanning forest of the near pairs of equal keys only: no part of near_edges."""
    own, place = np.unique(nodes, return_inverse=True)
    label = np.arange(len(own))
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    sizes = np.diff(np.append(starts, len(keys)))
    large = sizes > LARGE_GROUP
    for s, g in zip(starts[large], sizes[large], strict=True):
        for x, found in _large_group(fps[s : s + g], int(keys[s] >> 16) % SEGMENTS, tau):
            joined(label, np.full(len(found), place[s + x]), place[s + found])
    ends = np.repeat(starts + sizes, sizes)
    later = np.where(np.repeat(large, sizes), 0, ends - np.arange(len(keys)) - 1)
    cum = np.concatenate([[0], np.cumsum(later)])
    i = 0
    while i < len(keys):
        j = max(i + 1, int(np.searchsorted(cum, cum[i] + PAIRS_AT_ONCE, "right")) - 1)
        j = min(j, len(keys))
        count = later[i:j]
        left = np.repeat(np.arange(i, j), count)
        right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
        apart = label[place[left]] != label[place[right]]  # those that are connected already needn't be compared
        left, right = left[apart], right[apart]
        if len(left):
            ok = _near(fps[left], fps[right], (keys[left] >> 16) % SEGMENTS, tau)
            joined(label, place[left[ok]], place[right[ok]])
        i = j
    some = np.flatnonzero(label != np.arange(len(own)))
    return own[some], own[label[some]]


def radii(tau: int) -> list[int]:
    """For each segment how many bits may differ where a pair within tau bits is met; -1: it needn't be met there."""
    total = tau - SEGMENTS + 1
    return [(s + 1) * total // SEGMENTS - s * total // SEGMENTS for s in range(SEGMENTS)]


def _full(a: np.ndarray, b: np.ndarray, tau: int) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1) <= tau


def _all_near(x: np.ndarray, y: np.ndarray, tau: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of rows of x and y within tau bits, each compared."""
    wx, wy = x.view(np.uint64), y.view(np.uint64)
    step = max(1, PAIRS_AT_ONCE // max(1, len(y)))
    for k in range(0, len(x), step):
        i, j = np.nonzero(_full(wx[k : k + step, None], wy[None], tau))
        yield i + k, j


def _probed(x: np.ndarray, y: np.ndarray, lx: np.ndarray, ly: np.ndarray, segment: int, tau: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of rows of x and y within tau bits that are to be met in this segment; in large buckets only those of unequal labels.

    same: y is x, and a pair is met from one side only.
    """
    radius, at = radii(tau), [(segment + k) % SEGMENTS for k in range(CHAIN)]
    budget = np.cumsum([radius[s] + 1 for s in at]) - 1
    order, other = np.argsort(x[:, segment], kind="stable"), np.lexsort((ly, y[:, segment]))
    own, values = x[order, segment], y[other, segment]
    size = np.bincount(values, minlength=1 << 16)
    start = np.cumsum(size) - size
    chain_x, chain_y = [np.ascontiguousarray(x[order, s]) for s in at[1:]], [np.ascontiguousarray(y[other, s]) for s in at[1:]]
    wx, wy = x.view(np.uint64), y.view(np.uint64)
    hot = size.max(initial=0) > TOLD_APART
    if hot:
        label = lx[order]
        keyed = values.astype(np.int64) << 32 | ly[other]
    for flip in np.flatnonzero(radius[segment] >= _ONES).astype(np.uint16):
        value = own ^ flip
        rows = np.flatnonzero((size[value] > 0) & (value >= own) if same else size[value] > 0)
        value = value[rows]
        low, count = start[value], size[value]
        if hot and (large := np.flatnonzero(count > TOLD_APART)).size:
            asked = value[large].astype(np.int64) << 32 | label[rows[large]]
            before, after = np.searchsorted(keyed, asked, "left"), np.searchsorted(keyed, asked, "right")
            rows, low, count = np.append(rows, rows[large]), np.append(low, after), np.append(count, low[large] + count[large] - after)
            count[large] = before - low[large]
        ends = np.cumsum(count)
        k = 0
        while k < len(rows):
            done = int(ends[k - 1]) if k else 0
            to = max(k + 1, int(np.searchsorted(ends, done + (PAIRS_AT_ONCE << 2), "right")))
            n = count[k:to]
            place = np.repeat(low[k:to] - (ends[k:to] - n - done), n)
            place += np.arange(len(place))
            near = np.flatnonzero(np.bitwise_count(np.repeat(chain_x[0][rows[k:to]], n) ^ chain_y[0][place]) <= budget[1] - int(_ONES[flip]))
            i, j = rows[k + np.searchsorted(ends[k:to] - done, near, "right")], place[near]
            total = np.full(len(i), _ONES[flip], np.int16)
            for length in range(2, CHAIN + 1):
                total = total + np.bitwise_count(chain_x[length - 2][i] ^ chain_y[length - 2][j])
                ok = total <= budget[length - 1]
                i, j, total = i[ok], j[ok], total[ok]
            i, j = order[i], other[j]
            ok = _full(wx[i], wy[j], tau)
            yield i[ok], j[ok]
            k = to


def tile_edges(nodes: np.ndarray, fps: np.ndarray, second: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the near pairs of fingerprints of the first and the second tile, or of one tile's own if none is of the second."""
    label = np.arange(len(nodes))
    x, y = np.flatnonzero(~second), np.flatnonzero(second)
    same = not len(x) or not len(y)
    if same:
        x = y = np.arange(len(nodes))
    fx, fy = np.ascontiguousarray(fps[x]), np.ascontiguousarray(fps[y])
    radius = radii(tau)
    if len(x) * len(y) <= EXHAUSTIVE or sum((_ONES <= r).sum() for r in radius) > MOST_PROBES:
        for i, j in _all_near(fx, fy, tau):
            joined(label, x[i], y[j])
    else:
        for s in range(SEGMENTS):  # what is in large buckets is connected first, so that it isn't compared pair by pair
            order = np.argsort(fps[:, s], kind="stable")
            size = np.bincount(fps[:, s], minlength=1 << 16)
            for v in np.flatnonzero(size > LARGE_GROUP):
                group = order[size[:v].sum() :][: size[v]]
                for a, found in _large_group(fps[group], s, tau):
                    joined(label, np.full(len(found), group[a]), group[found])
        for s in np.flatnonzero(np.array(radius) >= 0):
            lx, ly = label[x], label[y]
            for i, j in _probed(fx, fy, lx, ly, int(s), tau, same):
                joined(label, x[i], y[j])
    some = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[some], nodes[label[some]]


def _fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps, keys = fingerprints(*utf8_parts(batch.column("text")))
        n = len(fps)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("k"), pa.array([fps[i].tobytes() for i in range(n)], pa.binary()), pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * 2 * SEGMENTS), pa.array(keys.ravel()))],
            ["doc_id", "k", "fp", "keys"],
        )


def _edges_of(tau: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ended(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            fps = np.frombuffer(b"".join(x for b in held for x in b.column("fp").to_pylist()), np.uint16).reshape(-1, SEGMENTS)
            nodes, second = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]) for c in ("node", "second"))
            a, b = tile_edges(nodes, fps, second, tau)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        now, held = None, []
        for batch in batches:
            keys = batch.column("key").to_numpy()
            cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else []
            for i, j in zip(cuts, np.append(cuts[1:], len(keys)), strict=True):
                if held and keys[i] != now:
                    yield ended(held)
                    held = []
                now = keys[i]
                held.append(batch.slice(i, j - i))
        if held:
            yield ended(held)

    return run


def near_edges(prints: DataFrame, tau: int = TAU, block_rows: int = TILE_ROWS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints, by their 64-bit hashes, from a table with fp: forests of all pairs within tau bits.

    Fingerprints are dealt into tiles of about block_rows at most, and each pair of tiles is a group of its own.
    """
    nodes = written(prints.select("fp").distinct().select(F.xxhash64("fp").alias("node"), "fp"), "nodes")
    tiles = max(TILES, -(-nodes.count() // block_rows))
    groups = tiles * (tiles + 1) // 2
    dealt = nodes.withColumn("t", F.pmod(F.xxhash64("node"), F.lit(tiles))).withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))))
    low = F.least("t", "o")
    dealt = dealt.select((F.expr("bigint(greatest(t, o) * (greatest(t, o) + 1) div 2)") + low).alias("key"), (F.col("t") > low).alias("second"), "node", "fp")
    parts = min(groups, int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return dealt.repartitionById(parts, F.pmod("key", F.lit(parts)).cast("int")).sortWithinPartitions("key").mapInArrow(_edges_of(tau), "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tau: int = TAU) -> DataFrame:
    """A row (doc_id, k, n, kept_id, kept_k) for each distinct (doc_id, text) of a group of at least two rows; k is the text's hash.

    n counts the rows that are equal in doc_id and text. Null texts belong to no group; empty ones are equal to each other. Rows
    of null doc_id come last in the choice of the one that stays; among equal doc_ids the smaller text hash comes first.
    """
    base = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text")).where(F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("k"), "text")
    id_type = base.schema["doc_id"].dataType.simpleString()
    prints = written(base.mapInArrow(_fingerprint_rows, f"doc_id {id_type}, k long, fp binary, keys array<int>").select("doc_id", "k", "fp"), "fingerprints")
    rows = prints.groupBy("doc_id", "k", "fp").agg(F.count("*").alias("n")).withColumn("node", F.xxhash64("fp")).drop("fp")
    roots = components(near_edges(prints, tau))
    rows = written(rows.join(roots, "node", "left").select("doc_id", "k", "n", F.coalesce("root", "node").alias("root")), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k")).alias("first")
    groups = rows.groupBy("root").agg(first, F.sum("n").alias("size")).where("size > 1")
    return rows.join(groups, "root").select("doc_id", "k", "n", F.col("first.doc_id").alias("kept_id"), F.col("first.k").alias("kept_k"))


def removed_pairs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tau: int = TAU) -> DataFrame:
    """A row (doc_id, kept_doc_id) for each row to remove. Rows equal in doc_id and text are copies of each other, too."""
    d = near_duplicates(docs, doc_id, text, tau)
    is_kept = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("k") == F.col("kept_k"))
    copies = F.when(is_kept, F.col("n") - 1).otherwise(F.col("n"))
    return d.select("doc_id", F.col("kept_id").alias("kept_doc_id"), F.explode(F.array_repeat(F.lit(0), copies.cast("int"))).alias("i")).drop("i")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tau: int = TAU) -> DataFrame:
    """docs with one row of each group, all columns kept.

    Null text: stays. Empty texts: one stays. Very long texts: fingerprinted whole. Repeated rows and ties: one row stays, the first by
    doc_id, then text hash. Null doc_id: as above. Empty table: empty result. Extra columns: kept, whatever their names.
    """
    k, sid, sk, many = fresh(docs, "k", "sid", "sk", "many")
    d = written(near_duplicates(docs, doc_id, text, tau), "near-duplicates")
    is_kept = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("k") == F.col("kept_k"))
    verdict = d.where(~is_kept | (F.col("n") > 1)).select(F.col("doc_id").alias(sid), F.col("k").alias(sk), is_kept.alias(many))
    joined = docs.withColumn(k, F.xxhash64(quoted(text))).join(verdict, (F.col(k) == F.col(sk)) & quoted(doc_id).eqNullSafe(F.col(sid)) & quoted(text).isNotNull(), "left")
    names = [quoted(c) for c in docs.columns]
    out = joined.where(F.col(many).isNull()).select(*names)
    if d.where(is_kept & (F.col("n") > 1)).isEmpty():
        return out
    once = joined.where(F.col(many)).dropDuplicates([sk, sid]).select(*names)
    return out.unionByName(once)
