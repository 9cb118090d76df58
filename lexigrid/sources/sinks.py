"""Sinks: snapshots of tables, published by pointer; ledgers; subsets; the English translation merge.

Tables are immutable folders of Parquet. An update writes a new version and moves the pointer; the versions before stay as backups.
"""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.functions.text import ascii_fold, blank, present


def with_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """df with those of the columns (name to type) that it lacks, null."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that all executors share, spark.checkpoint.dir; one of this machine only in local mode without that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="lexigrid-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def dense_ids(df: DataFrame, order: list[Column | str], name: str = "id", first: int = 1) -> DataFrame:
    """Numbers first, first + 1, ... in this order. Ranges are sorted in parallel; only each range's count goes to the driver.

    The sorted ranges are written once to the shared folder, each row with its range and its place there: a range shuffle that ran again,
    for the counts or after a loss, could draw other borders.
    """
    spark = df.sparkSession
    part, at, start = (_free(df, n) for n in ("_part", "_at", "_start"))
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(part, F.spark_partition_id()).withColumn(at, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    path = shared_path(spark, "ranges")
    ranged.write.parquet(path)
    kept = spark.read.schema(ranged.schema).parquet(path)
    counts = sorted((r[part], r["count"]) for r in kept.groupBy(part).count().collect())  # a row for each range
    starts, total = [], first
    for number, n in counts:
        starts.append((number, total))
        total += n
    offsets = spark.createDataFrame(starts, f"{part} int, {start} long")
    return kept.join(F.broadcast(offsets), part).withColumn(name, F.col(start) + F.col(at)).select(*df.columns, name)


def _free(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def clustered(df: DataFrame, key: Column, path: str, files: int | None = None) -> None:
    """Written in ranges of the folded key, sorted, so that a look-up reads the few row groups whose minimum and maximum admit it."""
    keyed = df.withColumn("word_key", ascii_fold(key))
    ranged = keyed.repartitionByRange(files, "word_key") if files else keyed.repartitionByRange("word_key")
    ranged.sortWithinPartitions("word_key").write.mode("overwrite").parquet(path)


class Store:
    """Versions of a table in one folder, and a pointer to the current one, moved after the version is written whole."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self) -> list[str]:
        """Names of the pointers' targets, the oldest first."""
        pointers = self._path(f"{self.root}/_pointers")
        if not self._fs.exists(pointers):
            return []
        names = sorted(s.getPath().getName() for s in self._fs.listStatus(pointers) if not s.getPath().getName().startswith("."))
        return [self._read(f"{self.root}/_pointers/{n}")["version"] for n in names]

    def _read(self, path: str) -> dict:
        stream = self._fs.open(self._path(path))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def current(self) -> DataFrame | None:
        known = self.versions()
        return self.spark.read.parquet(f"{self.root}/{known[-1]}") if known else None

    def stage(self, df: DataFrame) -> str:
        """A version written but not published."""
        version = f"v-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.root}/{version}")
        return version

    def publish(self, version: str) -> None:
        """The pointer's file is made under another name and renamed: readers see the old version or the new one."""
        pointers = f"{self.root}/_pointers"
        self._fs.mkdirs(self._path(pointers))
        number = len([s for s in self._fs.listStatus(self._path(pointers)) if not s.getPath().getName().startswith(".")])
        temporary = self._path(f"{pointers}/.{version}")
        out = self._fs.create(temporary, True)
        out.write(bytearray(json.dumps({"version": version}).encode()))
        out.close()
        if not self._fs.rename(temporary, self._path(f"{pointers}/{number:08d}")):
            raise RuntimeError("another writer published in between")

    def discard(self, version: str) -> None:
        """Removes a version that was never published."""
        if version in self.versions():
            raise ValueError(f"{version} was published")
        self._fs.delete(self._path(f"{self.root}/{version}"), True)

    def restore(self, version: str) -> None:
        """An older version becomes the current one again."""
        if version not in self.versions():
            raise ValueError(f"no version {version}")
        self.publish(version)


def updated_by_id(df: DataFrame, updates: DataFrame, key: str = "id", columns: list[str] | None = None) -> DataFrame:
    """df with the columns of the rows that updates has; a null in updates is written too. Keys must be unique in updates."""
    columns = columns or [c for c in updates.columns if c != key]
    new = updates.select(F.col(key), F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = df.join(new, key, "left")
    values = {c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}
    return joined.select(*[values.get(c, F.col(c)).alias(c) for c in df.columns])


def inserted(df: DataFrame, rows: DataFrame) -> DataFrame:
    """df with rows added; columns that rows lacks are null."""
    return df.unionByName(rows, allowMissingColumns=True).select(*df.columns)


def filled_where_blank(df: DataFrame, source: DataFrame, key: str, column: str) -> DataFrame:
    """df with source's values where its own are blank; of several rows of source for a key the least value that isn't blank counts."""
    best = source.where(present(F.col(column))).groupBy(key).agg(F.min(column).alias("_fill"))
    return df.join(best, key, "left").withColumn(column, F.when(blank(F.col(column)), F.coalesce("_fill", column)).otherwise(F.col(column))).select(*df.columns)


def append_ledger(ledger: DataFrame, path: str) -> None:
    ledger.write.mode("append").parquet(path)


def subset(entries: DataFrame, lang: str, path: str) -> None:
    """An edition's entries for one language, reshaped, as JSON lines."""
    own = entries.where(F.col("lang_code") == lang)
    senses = F.transform("senses", lambda s: F.struct(s["glosses"].alias("g"), s["tags"].alias("tags"), s["topics"].alias("topics")))
    ipa = F.filter(F.transform("sounds", lambda s: s["ipa"]), lambda x: x.isNotNull())
    audio = F.filter(F.transform("sounds", lambda s: F.coalesce(s["mp3_url"], s["ogg_url"], s["wav_url"])), lambda x: x.isNotNull())
    own.select("word", "pos", senses.alias("senses"), ipa.alias("ipa"), audio.alias("audio")).write.mode("overwrite").json(path)
