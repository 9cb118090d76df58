"""Embedding near-dedup (operator 2): vectors above a cosine similarity, by int8 tile products with rigorous error bounds.

The vectors are dealt into tiles; each pair of tiles is a task. There the unit vectors are quantised to int8 with a scale of their own,
x = s q + e with a known |e|, and the tiles' integer product (exact: in floats of enough bits) gives s s' q.q'. It is off by at most
|s q| |e'| + |s' q'| |e| + |e| |e'|: pairs whose upper bound misses the threshold are out, pairs whose lower bound reaches it are in, and
only those between are computed again in double precision.

`near_classes`, which the query op2_embedding_dedup runs, gives each row its class (the connected component) and its number of links. Equal
vectors are compared once, with how often they come as a weight; a tile pair reports its vectors' links as counts, and of its pairs only a
spanning forest, so that what leaves a task is bounded by the tile, however many pairs a group of copies has.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import components, joined, quoted, written

THRESHOLD, TILE, ROWS_AT_ONCE = 0.95, 8192, 256


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scales, |s q| and |e| (both rounded up) of unit vectors in double precision."""
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    up = 1 + 1e-12
    return q, scale, np.linalg.norm(back, axis=1) * up, np.linalg.norm(unit - back, axis=1) * up + 1e-15


def _close(x: np.ndarray, y: np.ndarray | None, threshold: float, values: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Block by block rows of x, rows of y (of x again, each pair once, if y is None) and cosines of the pairs at or above threshold.

    Without values pairs that are surely above it keep their approximate cosine.
    """
    same, y = y is None, x if y is None else y
    xu, yu = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    (xq, xs, xn, xe), (yq, ys, yn, ye) = quantised(xu), quantised(yu)
    exact = np.float32 if 127 * 127 * x.shape[1] < 1 << 24 else np.float64
    yt = np.ascontiguousarray(yq.T.astype(exact))
    for a in range(0, len(x), ROWS_AT_ONCE):
        b = min(len(x), a + ROWS_AT_ONCE)
        lo = a if same else 0
        dots = xq[a:b].astype(exact) @ yt[:, lo:]
        # s s' q.q' + slack >= threshold, with the slack's largest values first: a cheap test that passes more
        slack = xn[a:b].max() * ye.max() + yn.max() * xe[a:b].max() + xe[a:b].max() * ye.max()
        bar = ((threshold - slack - 1e-6) / (xs[a:b].max() * ys[lo:].max())) if threshold > slack else -np.inf
        i, j = np.nonzero(dots >= bar)
        value = dots[i, j]
        i, j = i + a, j + lo
        if same:
            keep = i < j
            i, j, value = i[keep], j[keep], value[keep]
        cos = xs[i] * ys[j] * value
        error = xn[i] * ye[j] + yn[j] * xe[i] + xe[i] * ye[j]
        ok = cos + error >= threshold - 1e-9
        again = np.flatnonzero(ok if values else ok & (cos - error < threshold + 1e-9))
        for c in range(0, len(again), 1 << 16):
            own = again[c : c + (1 << 16)]
            cos[own] = np.einsum("ij,ij->i", xu[i[own]], yu[j[own]])
        ok[again] = cos[again] >= threshold
        yield i[ok], j[ok], cos[ok]


def close_pairs(x: np.ndarray, y: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of x, rows of y (of x again, each pair once, if y is None) and cosines of the pairs at or above threshold."""
    z = np.empty(0, np.int64)
    return tuple(np.concatenate(c) for c in zip((z, z, np.empty(0)), *_close(x, y, threshold, True), strict=True))


def close_links(x: np.ndarray, y: np.ndarray | None, n: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the rows of x, then y, that come n times each: the links to the other tile's (or their own tile's other) rows, and a label that
    rows share that close pairs connect."""
    links, label = np.zeros(len(n)), np.arange(len(n))
    ahead = 0 if y is None else len(x)
    for i, j, _ in _close(x, y, threshold, False):
        j = j + ahead
        links += np.bincount(i, weights=n[j], minlength=len(n)) + np.bincount(j, weights=n[i], minlength=len(n))
        joined(label, i, j)
    return links.astype(np.int64), label


def _vectors(table: pa.Table, dims: int) -> tuple[np.ndarray, np.ndarray]:
    own = table.filter(pa.compute.equal(pa.compute.list_value_length(table.column("v")), dims)).combine_chunks()
    ids = own.column("id").to_numpy()
    flat = pa.compute.list_flatten(own.column("v")).to_numpy().astype(np.float64)
    return ids, flat.reshape(len(ids), dims)


def _tile_pair(threshold: float):
    def run(_: tuple, group: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        left, right = (group.filter(pc.equal(group.column("side"), s)) for s in (0, 1))
        a_out, b_out, c_out = [], [], []
        for dims in sorted(set(pc.unique(pc.list_value_length(left.column("v"))).to_pylist())):
            ids, x = _vectors(left, dims)
            if right.num_rows:
                other, y = _vectors(right, dims)
                if not len(other):
                    continue
                i, j, cos = close_pairs(x, y, threshold)
            else:
                other = ids
                i, j, cos = close_pairs(x, None, threshold)
            a_out.append(ids[i])
            b_out.append(other[j])
            c_out.append(cos)
        a, b = (np.concatenate([np.empty(0, np.int64), *x]) for x in (a_out, b_out))
        return pa.table({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b)), "similarity": pa.array(np.concatenate([np.empty(0), *c_out]))})

    return run


def _tile_links(threshold: float):
    def run(_: tuple, group: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        out: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in range(3)]
        left, right = (group.filter(pc.equal(group.column("side"), s)) for s in (0, 1))
        for dims in sorted(set(pc.unique(pc.list_value_length(left.column("v"))).to_pylist())):
            ids, x = _vectors(left, dims)
            n, y = _counts(left, dims), None
            if right.num_rows:
                other, y = _vectors(right, dims)
                if not len(other):
                    continue
                ids, n = np.concatenate([ids, other]), np.concatenate([n, _counts(right, dims)])
            links, label = close_links(x, y, n, threshold)
            some = np.flatnonzero(links)
            for column, values in zip(out, (ids[some], ids[label[some]], links[some]), strict=True):
                column.append(values)
        return pa.table({name: pa.array(np.concatenate(c)) for name, c in zip(("node", "root", "links"), out, strict=True)})

    return run


def _counts(table: pa.Table, dims: int) -> np.ndarray:
    return table.filter(pa.compute.equal(pa.compute.list_value_length(table.column("v")), dims)).column("n").to_numpy()


def _valid(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    v = quoted(embedding).cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(quoted(vec_id).cast("long").alias("id"), quoted(embedding).cast("array<float>").alias("v"), good.alias("good")).where("id IS NOT NULL AND v IS NOT NULL AND good").drop("good")


def _dealt(base: DataFrame, tile: int) -> DataFrame:
    """base's rows for each pair of tiles (i, j) that they are in, and the side that they are on."""
    tiles = max(1, math.ceil(base.count() / tile))
    own = F.pmod(F.xxhash64("id"), F.lit(tiles)).cast("int")
    dealt = base.withColumn("t", own).withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    return dealt.withColumns({"i": F.least("t", "o"), "j": F.greatest("t", "o"), "side": (F.col("t") > F.col("o")).cast("int")}).drop("t", "o")


def near_classes(vectors: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", embedding: str = "embedding", tile: int = TILE) -> DataFrame:
    """A row (vec_id, class_id, n_links) for each row with a valid vector: n_links other rows have at least this cosine similarity with
    it; class_id is the least id of the rows that such links connect with it. A row stays if its id is its class_id.

    Left out: as in near_pairs. Only vectors of one length are compared. Rows that repeat an id: rows of their own, linked like others; of
    those with a class_id as id all stay, so ids should be unique. Copies and ties: linked all, whatever their number. Very long vectors: as
    any. Empty table: empty result. Other columns: unread.
    """
    base = _valid(vectors, vec_id, embedding)
    # written, so that the numbers are the same whoever reads them
    nodes = written(base.groupBy("v").agg(F.count("*").alias("n"), F.min("id").alias("least")).withColumn("node", F.monotonically_increasing_id()), "vectors")
    found = written(_dealt(nodes.select(F.col("node").alias("id"), "n", "v"), tile).groupBy("i", "j").applyInArrow(_tile_links(threshold), "node long, root long, links long"), "links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = nodes.select("node", "v", "n", "least").join(links, "node", "left").join(roots, "node", "left")
    known = known.select("v", "n", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"))
    known = known.join(known.groupBy("root").agg(F.min("least").alias("class_id")), "root").select("v", "class_id", (F.col("links") + F.col("n") - 1).alias("n_links"))
    return base.join(known, "v").select(F.col("id").alias("vec_id"), "class_id", "n_links")


def near_pairs(vectors: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", embedding: str = "embedding", tile: int = TILE) -> DataFrame:
    """A row (a, b, similarity) for each two ids a < b of vectors with at least this cosine similarity.

    Left out: rows of null id; null or empty vectors; vectors with a null, NaN or infinite element; zero vectors (no direction).
    Only vectors of one length are compared. Rows that repeat an id are variants of one item: its similarity is the largest.
    Ties and copies: every pair is listed, there is no cap. Very long vectors: as any. Empty table: empty result. Other columns: unread.
    """
    dealt = _dealt(_valid(vectors, vec_id, embedding), tile)
    found = dealt.groupBy("i", "j").applyInArrow(_tile_pair(threshold), "a long, b long, similarity double")
    return found.where("a < b").groupBy("a", "b").agg(F.max("similarity").alias("similarity"))
