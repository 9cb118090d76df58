"""Readers: nested JSON lines, gzip editions, response chunks, logs, ledgers, archives, inventories.

Readers keep the source's order where it has a meaning: `seq` is (file, place in the file), so that `first wins` folds give the same
result however the input is split.
"""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LINK = "array<struct<word:string>>"
ENTRY = (
    "word string, lang_code string, pos string, pos_title string, tags array<string>, categories array<string>, "
    "sounds array<struct<ipa:string,tags:array<string>,raw_tags:array<string>,audio:string,mp3_url:string,ogg_url:string,wav_url:string>>, "
    f"senses array<struct<glosses:array<string>,tags:array<string>,topics:array<string>,categories:array<struct<name:string>>,form_of:{_LINK},alt_of:{_LINK}>>, "
    "forms array<struct<form:string,ipa:string,tags:array<string>>>, head_templates array<struct<name:string,expansion:string,args:map<string,string>>>, "
    f"form_of {_LINK}"
)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value, seq) of the lines of text files, plain or compressed; seq orders them as the files have them.

    A line's place is its block's start and its number within the block, so a file may be split. Compressed files are one block each.
    """
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    return text.select("value", F.struct("file", "block", "at").alias("seq"))


def read_entries(spark: SparkSession, path: str | list[str], lang: str | None = None, schema: str = ENTRY, prefilter: str | None = None) -> DataFrame:
    """Entries of JSON lines with `seq` and `bad` (the line is no JSON object or has no word); of one language if lang says so.

    Only the schema's fields are parsed. prefilter, a text that wanted lines contain, skips others before parsing; it never decides.
    Bad lines are kept and marked, so that they can be counted: `good_entries` leaves them out.
    """
    lines = read_lines(spark, path).where(F.trim("value") != "")
    if prefilter:
        lines = lines.where(F.contains("value", F.lit(prefilter)))
    # a line that is no JSON object parses to nulls; each line is parsed once
    parsed = lines.select("seq", F.from_json("value", schema).alias("e"))
    out = parsed.select("seq", "e.*", (F.col("e.word").isNull() | (F.trim("e.word") == "")).alias("bad"))
    return out if lang is None else out.where(F.col("bad") | (F.col("lang_code") == lang))


def good_entries(entries: DataFrame) -> DataFrame:
    return entries.where(~F.col("bad")).drop("bad").withColumn("word", F.trim("word"))


def only_words(entries: DataFrame, words: DataFrame, key: str = "word", fold: bool = True) -> DataFrame:
    """Entries whose word is among words: a semi join, which Spark broadcasts or shuffles by size."""
    k = (lambda c: F.lower(c)) if fold else (lambda c: c)
    return entries.join(words.select(k(F.col(key)).alias("_wanted")).distinct(), k(F.col("word")) == F.col("_wanted"), "left_semi")


def read_response_chunks(spark: SparkSession, path: str, value_schema: str, pattern: str = "chunk_*.json") -> DataFrame:
    """(rid, o) of files that each hold one JSON object {rid: o}."""
    whole = spark.read.option("wholetext", True).option("pathGlobFilter", pattern).text(path)
    return whole.select(F.explode(F.from_json("value", f"map<string,{value_schema}>")).alias("rid", "o")).withColumn("rid", F.expr("try_cast(rid as bigint)")).where("rid IS NOT NULL")


def read_log(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """An append-only JSON log: of each key the last record."""
    lines = read_lines(spark, path).select("seq", F.from_json("value", schema).alias("r")).where(F.col(f"r.{key}").isNotNull())
    return last_per_key(lines.select("seq", "r.*"), [key])


def last_per_key(df: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """Of each key the last row; an aggregate with partial aggregation, not a window."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_last")).select(*keys, "_last.*")


def first_per_key(df: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_first")).select(*keys, "_first.*")


def read_ledger(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A ledger of tab-separated values with a heading; short rows get nulls, rows without a first value are left out."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(path, sep="\t", header=True, schema=schema, mode="PERMISSIVE", quote="").where(F.col(columns[0]).isNotNull())


def read_archive(spark: SparkSession, path: str, suffix: str = ".jsonl") -> DataFrame:
    """(archive, member, line_no, value) of the lines of the members of tar archives, compressed or not; a task for each archive."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                with tarfile.open(fileobj=io.BytesIO(content)) as archive:
                    for member in archive:
                        if member.isfile() and member.name.endswith(suffix):
                            lines = [x.decode(errors="replace").rstrip("\n") for x in archive.extractfile(member)]
                            yield pa.RecordBatch.from_arrays([pa.array([name] * len(lines)), pa.array([member.name] * len(lines)), pa.array(range(1, len(lines) + 1), pa.int64()), pa.array(lines, pa.string())], ["archive", "member", "line_no", "value"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(members, "archive string, member string, line_no long, value string")


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """(folder, files, bytes, largest) of the files below path; their contents stay unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    return files.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max("length").alias("largest"))


def index_page(html: Column) -> Column:
    """(href, name, senses) of the rows of an extract site's index, the most senses first; the total of all languages is left out."""
    row = r'<a\s[^>]*?href="([^"]+)/index[.]html"[^>]*>\s*([^<]+?)\s*[(](\d+)\s+senses[)]'
    parts = [F.regexp_extract_all(html, F.lit("(?i)" + row), F.lit(i)) for i in (1, 2, 3)]
    each = F.transform(F.arrays_zip(*[p.alias(n) for p, n in zip(parts, "hns", strict=True)]), lambda r: F.struct((-r["s"].cast("long")).alias("order"), r["h"].alias("href"), F.trim(r["n"]).alias("name"), r["s"].cast("long").alias("senses")))
    return F.transform(F.array_sort(F.filter(each, lambda r: ~F.lower(r["name"]).startswith("all languages"))), lambda r: F.struct(r["href"].alias("href"), r["name"].alias("name"), r["senses"].alias("senses")))


def slice_url(site: str, edition: Column, href: Column, stem: str = "dictionary-") -> Column:
    """Where an edition's slice for a language lies. English is at /dictionary, the others at /xxwiktionary; file names have no blanks."""
    base = F.when(edition == "en", F.lit(f"{site}/dictionary")).otherwise(F.concat(F.lit(f"{site}/"), edition, F.lit("wiktionary")))
    return F.concat(base, F.lit("/"), href, F.lit("/"), F.lit(stem), F.regexp_replace(href, r"%20|\+", ""), F.lit(".jsonl.gz"))
