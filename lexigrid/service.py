"""Look-up services over dictionary tables: statistics, search, entries, and the registry of languages."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexigrid.functions import ipa
from lexigrid.functions.text import base_forms, brief, collocation, exchange_map, lines, senses
from lexigrid.operators import lookup, stats

CODES = ("en", "es", "it", "fr", "pt", "de")


class Service:
    """One language's table of Parquet, written by `sources.sinks.clustered` or with the columns of `plans.build.table`."""

    def __init__(self, spark: SparkSession, code: str, path: str):
        self.code, self.path = code, path
        self.df = spark.read.parquet(path)
        self.sorted_by = "word_key" if "word_key" in self.df.columns else None

    @property
    def english(self) -> bool:
        return self.code == "en"

    def get_stats(self) -> DataFrame:
        if self.english:
            return stats.english_stats(self.df)
        return stats.dictionary_stats(self.df, {"es": "phonetic", "pt": "ipa_br"}.get(self.code, "ipa"))

    def search(self, typed: str, limit: object = 20) -> DataFrame:
        """(id, word, pos, brief), ranked; none for blanks."""
        typed, n = typed.strip(), lookup.clamp(limit)
        if self.english:
            hits = lookup.search(self.df, typed, n, key=None, order=lookup.by_frequency(typed), sorted_by=self.sorted_by)
        else:
            hits = lookup.search(self.df, typed, n, sorted_by=self.sorted_by)
        return hits.select("id", "word", "pos", brief(F.col("translation"), F.col("definition"), self.english).alias("brief"))

    def shown(self, df: DataFrame) -> DataFrame:
        """Entries as they are shown: pronunciations in normal form, lists as arrays."""
        if self.english:
            uk, us, other = F.col("phonetic_uk"), F.col("phonetic_us"), F.col("phonetic")
            extra: dict[str, Column] = {"phoneticUk": ipa.english_shown(uk, "uk"), "phoneticUs": ipa.english_shown(us, "us"), "phoneticDisplay": ipa.english_display(uk, us, other), "forms": exchange_map(F.col("exchange"))}
            return df.withColumns({**extra, "lang": F.lit("en")})
        columns = [c for c in ("phonetic", "ipa", "ipa_br", "ipa_pt") if c in df.columns]
        extra = {c: ipa.SHOWN[self.code](F.col(c)) for c in columns}
        if self.code == "es":
            extra["phonetic_latam"] = ipa.latin_american(ipa.spanish_shown(F.col("phonetic")))
        extra |= {
            "senses": senses(F.col("definition"), F.col("translation"), F.col("meta")),
            "collocations": F.transform(lines(F.col("collocation")), collocation),
            "base_forms": base_forms(F.col("exchange")),
            "infl_notes": lines(F.col("infl")),
            "lang": F.lit(self.code),
        }
        return df.withColumns(extra)

    def get_entry(self, word: str) -> DataFrame:
        """The best row for a word with its bases, as it is shown; none for blanks and unknown words."""
        order = [F.col("id").asc()] if self.english else lookup.best_first()
        hit = lookup.exact(self.df, word, order=order, sorted_by=self.sorted_by)
        if self.english:
            return self.shown(hit)
        return self.shown(lookup.bases(self.df, hit, columns=["word", "pos", "definition", "translation", "meta"]))

    def get_entries(self, keys: DataFrame, key: str) -> DataFrame:
        """Entries for a whole table of words."""
        return self.shown(lookup.exact_many(self.df, keys, key, lemma=None if self.english else "is_lemma"))


class Registry:
    """Languages whose tables are there. DATABASE_PATH_<CODE> says where one is; else it is below root."""

    def __init__(self, spark: SparkSession, root: str, exists: Callable[[str], bool] | None = None):
        self.spark, self.root, self._made = spark, root, {}
        self._exists = exists or self._is_there

    def _is_there(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def path(self, code: str) -> str:
        return os.environ.get(f"DATABASE_PATH_{code.upper()}", f"{self.root}/{code}")

    def available(self) -> list[str]:
        return [c for c in CODES if self._exists(self.path(c))]

    def service(self, code: str) -> Service:
        """The language's service, made once. An unknown code, or one without a table, gives the first available language."""
        there = self.available()
        if not there:
            raise FileNotFoundError(f"no dictionary below {self.root}")
        code = code if code in there else there[0]
        if code not in self._made:
            self._made[code] = Service(self.spark, code, self.path(code))
        return self._made[code]

    def close(self) -> None:
        self._made.clear()
