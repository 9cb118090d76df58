"""Line dedup (operator 1): runs of lines that earlier text has are removed.

`run_dedup`, which the query op1_line_dedup runs, finds all of them: every window of `min_lines` adjacent lines is hashed, those whose hash
occurs twice are fetched and compared byte by byte, and the lines of all equal windows but the first (by doc_id, then text hash, then
position) go. A line goes just if it lies in a run of at least `min_lines` lines that occurs before; the first place of each line stays.

`line_dedup` is the coarser way, by content-defined chunks, which loses most short runs: a cyclic-polynomial (buzhash) rolling hash over the hashes of `window` adjacent lines says after which lines a chunk ends, so an
insertion moves only the borders beside it. Chunks of at least `min_lines` lines are compared in the same way. All of it is JVM expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrid.llm.common import fresh, quoted, written

WINDOW, DIVISOR, MIN_LINES = 2, 3, 2


def _rotated(h: Column, by: int) -> Column:
    return F.shiftleft(h, by).bitwiseOR(F.shiftrightunsigned(h, 64 - by)) if by else h


def _chunks(text: Column, window: int, divisor: int, min_lines: int) -> Column:
    """An array of (first line, lines, hash) of the chunks with at least min_lines lines; lines count from 0."""

    def cut(hashes: Column) -> Column:
        n = F.size(hashes)

        def ends(i: Column) -> Column:
            roll = F.lit(0).cast("long")
            for back in range(window):
                roll = roll.bitwiseXOR(_rotated(F.element_at(hashes, (i - back).cast("int")), back))
            return F.pmod(roll, F.lit(divisor)) == 0

        inner = F.when(n > window, F.filter(F.sequence(F.lit(window), n - 1), ends)).otherwise(F.array().cast("array<int>"))
        return F.zip_with(F.concat(F.array(F.lit(0)), inner), F.concat(inner, F.array(n)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    hashes = F.transform(F.split(text, "\n"), lambda line: F.xxhash64(line))
    # transform over a one-element array binds the hashes once
    both = F.transform(F.array(hashes), lambda h: F.transform(F.filter(cut(h), lambda c: c["b"] - c["a"] >= min_lines), lambda c: F.struct(c["a"].alias("first"), (c["b"] - c["a"]).alias("lines"), F.xxhash64(F.slice(h, c["a"] + 1, c["b"] - c["a"])).alias("hash"))))
    return F.element_at(both, 1)


def _windows(text: Column, min_lines: int) -> Column:
    """An array of (first line, lines, hash) of all windows of min_lines adjacent lines; lines count from 0."""
    hashes = F.transform(F.split(text, "\n"), lambda line: F.xxhash64(line))

    def windows(h: Column) -> Column:
        firsts = F.when(F.size(h) >= min_lines, F.sequence(F.lit(0), F.size(h) - min_lines)).otherwise(F.array().cast("array<int>"))
        return F.transform(firsts, lambda i: F.struct(i.alias("first"), F.lit(min_lines).alias("lines"), F.xxhash64(*[F.element_at(h, i + k) for k in range(1, min_lines + 1)]).alias("hash")))

    return F.element_at(F.transform(F.array(hashes), windows), 1)


def duplicate_chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, divisor: int = DIVISOR, min_lines: int = MIN_LINES) -> DataFrame:
    """A row (doc_id, k, first, lines) for each chunk to remove; k is the text's hash, which tells rows of one doc_id apart.

    Rows equal in doc_id and text are one document here: they lose the same lines, and what only they share isn't repeated.
    Null text or none: no chunk. A null doc_id comes before all others in the order.
    """
    return _repeated(docs, doc_id, text, _chunks(F.col("text"), window, divisor, min_lines))


def duplicate_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES) -> DataFrame:
    """As duplicate_chunks, for all windows of min_lines adjacent lines; windows may overlap, so the rows may share lines."""
    return _repeated(docs, doc_id, text, _windows(F.col("text"), min_lines))


def _repeated(docs: DataFrame, doc_id: str, text: str, pieces: Column) -> DataFrame:
    """The pieces, an array of (first, lines, hash) made from the column text, that equal an earlier one byte by byte."""
    base = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text")).where(F.col("text").isNotNull())
    keyed = base.select("doc_id", F.xxhash64("text").alias("k"), F.explode(pieces).alias("c")).select("doc_id", "k", "c.first", "c.lines", "c.hash")
    keyed = written(keyed, "chunks")
    at = F.struct("doc_id", "k", "first")
    repeated = keyed.groupBy("hash").agg(F.min(at).alias("a"), F.max(at).alias("b")).where(F.col("a") != F.col("b")).select("hash")
    suspects = keyed.join(repeated, "hash").groupBy("doc_id", "k").agg(F.collect_set(F.struct("first", "lines", "hash")).alias("cs"))
    d, s = base.withColumn("k", F.xxhash64("text")).alias("d"), suspects.withColumnRenamed("doc_id", "sid").alias("s")
    texts = d.join(s, (F.col("d.k") == F.col("s.k")) & F.col("doc_id").eqNullSafe(F.col("sid"))).select("doc_id", F.col("d.k").alias("k"), "cs", F.split("text", "\n").alias("all"))
    # the lines are split once a text, not once a piece
    cut = F.transform(F.array("all"), lambda ls: F.transform("cs", lambda c: F.struct(c["first"].alias("first"), c["lines"].alias("lines"), c["hash"].alias("hash"), F.array_join(F.slice(ls, c["first"] + 1, c["lines"]), "\n").alias("chunk"))))
    texts = texts.select("doc_id", "k", F.explode(F.element_at(cut, 1)).alias("c")).select("doc_id", "k", "c.first", "c.lines", "c.hash", "c.chunk")
    texts = written(texts, "chunk-texts")
    kept = texts.groupBy("hash", "chunk").agg(F.min(at).alias("kept"))
    return texts.join(kept, ["hash", "chunk"]).where(at != F.col("kept")).select("doc_id", "k", "first", "lines").distinct()


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars", window: int = WINDOW, divisor: int = DIVISOR, min_lines: int = MIN_LINES) -> DataFrame:
    """docs with the repeated chunks' lines cut from the text, all columns and all rows kept; n_chars, if there, follows the text.

    Null or empty text: unchanged. Texts of fewer than min_lines lines: unchanged. A text all of whose chunks go becomes empty.
    Very long texts: cut like any. Repeated rows (same doc_id and text): all get the same result. Null doc_id: a document like
    others, told apart by its text. Empty table: empty result. Extra columns: kept, whatever their names.
    """
    return _without(docs, duplicate_chunks(docs, doc_id, text, window, divisor, min_lines), doc_id, text, n_chars)


def run_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars", min_lines: int = MIN_LINES) -> DataFrame:
    """docs without the lines of all runs of at least min_lines lines that earlier text has, the same document's included.

    Columns, rows, nulls, empty texts, repeated rows and empty tables: as line_dedup. An exact copy of a text of min_lines lines or more
    becomes empty. Blank lines are lines like others. A run may overlap the place that it repeats: of a line written three times running,
    one stays.
    """
    return _without(docs, duplicate_windows(docs, doc_id, text, min_lines), doc_id, text, n_chars)


def _without(docs: DataFrame, cuts: DataFrame, doc_id: str, text: str, n_chars: str) -> DataFrame:
    """docs without the lines that cuts (doc_id, k, first, lines) name."""
    k, gone, sid, sk = fresh(docs, "k", "gone", "sid", "sk")
    cuts = cuts.groupBy(F.col("doc_id").alias(sid), F.col("k").alias(sk)).agg(F.flatten(F.collect_list(F.sequence(F.col("first"), F.col("first") + F.col("lines") - 1))).alias(gone))
    joined = docs.withColumn(k, F.xxhash64(quoted(text))).join(cuts, (F.col(k) == F.col(sk)) & quoted(doc_id).eqNullSafe(F.col(sid)), "left")
    # split once; the numbers that stay by hashing, not by a search for each line
    left = F.element_at(F.transform(F.array(F.split(quoted(text), "\n")), lambda ls: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col(gone)), lambda i: F.element_at(ls, i + 1)), "\n")), 1)
    new = F.when(F.col(gone).isNull(), quoted(text)).otherwise(left)
    out = []
    for field in docs.schema.fields:
        if field.name == text:
            out.append(new.alias(text))
        elif field.name == n_chars and isinstance(field.dataType, (T.LongType, T.IntegerType)):
            out.append(F.when(F.col(gone).isNull(), quoted(n_chars)).otherwise(F.length(new).cast(field.dataType)).alias(n_chars))
        else:
            out.append(quoted(field.name))
    return joined.select(*out)
