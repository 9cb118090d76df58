"""Shared helpers: tables, shared scratch folder, name hygiene, vectorised tokens."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Letters and digits of ASCII; every byte of a longer UTF-8 sequence counts as a letter.
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that clash with none of df's, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        name = f"_lx_{name}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> Column:
    """The column of just this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the folder that all executors share: that of spark.checkpoint.dir.

    Only where the session names none and runs in local mode (tests) is a folder of this machine used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="lexigrid-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage and outlives executors. codec: the session's, unless it is named."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Makes label, the least number of each one's component, hold the links i - j too."""
    while len(i):
        a, b = label[i], label[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        if not len(i):
            return
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of edges (a, b): root is the smallest node of the connected component.

    Alternating large and small stars; each round is written to the shared folder.
    """
    edges = written(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u != v").distinct()
        edges = written(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        seen = now


def size_in_bytes(df: DataFrame) -> int:
    """What the optimiser knows of df's size, without a job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def utf8_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n+1 offsets of a string column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about limit bytes each; a longer row is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True that cross no row border: starts, ends and rows."""
    n = len(mask)
    if not n:
        z = np.empty(0, np.int64)
        return z, z, z
    first = np.zeros(n + 1, bool)
    first[offsets[offsets < n]] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = mask[:-1]
    starts = np.flatnonzero(mask & (~before | first[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = mask[1:]
    ends = np.flatnonzero(mask & (~after | np.append(first[1:n], True))) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def fold(data: np.ndarray) -> np.ndarray:
    """Lower case for the letters of ASCII and Latin-1 in UTF-8 bytes."""
    out = _LOWER[data]
    if len(data) > 1:
        upper = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        out[upper] += 32
    return out


_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """1, b, b^2 ... modulo 2^64, for at least n terms."""
    global _powers
    if len(_powers) < n:
        b = np.full(max(n, 1024), _ODD, np.uint64)
        b[0] = 1
        _powers = np.multiply.accumulate(b)
    return _powers


_inverse = np.ones(1, np.uint64)


def inverse_powers(n: int) -> np.ndarray:
    global _inverse
    if len(_inverse) < n:
        b = np.full(max(n, 1024), np.uint64(pow(int(_ODD), -1, 1 << 64)), np.uint64)
        b[0] = 1
        _inverse = np.multiply.accumulate(b)
    return _inverse


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: all output bits depend on all input bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def token_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash modulo 2^64 of each token's bytes, mixed."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lens = ends - starts
    ahead = np.cumsum(lens) - lens
    at = np.arange(int(lens.sum()))
    off = at - np.repeat(ahead, lens)
    values = (data[off + np.repeat(starts, lens)].astype(np.uint64) + np.uint64(1)) * powers(int(lens.max()))[off]
    return mix(np.add.reduceat(values, ahead) + lens.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def utf8_tokens(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, folded: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens are maximal runs of bytes of this kind: starts, ends, rows and hashes."""
    starts, ends, rows = runs(kind[data], offsets)
    return starts, ends, rows, token_hashes(fold(data) if folded else data, starts, ends)


def spark_arrow_schema(df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)
