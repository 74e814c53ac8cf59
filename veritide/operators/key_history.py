"""Uniqueness over many days: how often each key has come, kept as a bucketed table that each day is merged into.

A day's rows are counted by key and dealt like the stored table, so only the day is shuffled; the stored side is read
bucket by bucket, sorted, and joined where it lies. No row of an earlier day is read again, only one number for each key.
Every merge writes a new version beside the old one, and its manifest last: a merge that dies leaves the version before
it in force, and a day that was merged already changes nothing.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritide.functions.names import exact
from veritide.functions.text import is_present
from veritide.sources.tables import exists

MANIFEST = "version bigint, day string, keys bigint"


@dataclass(frozen=True)
class KeyHistory:
    """Key counts below ``folder``, which all executors reach, in ``buckets`` that stay as they were first chosen."""

    spark: SparkSession
    folder: str
    buckets: int = 64

    def manifest(self) -> DataFrame:
        """A row for each version that is whole: ``version``, ``day`` and its number of ``keys``."""
        path = f"{self.folder}/manifest"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).json(f"{path}/*/part-*")

    def _version(self) -> int:
        return self.manifest().agg(F.max("version")).first()[0] or 0

    def _name(self, version: int) -> str:
        return f"veritide_keys_{hashlib.sha256(self.folder.encode()).hexdigest()[:16]}_{version}"

    def counts(self, version: int | None = None) -> DataFrame:
        """``key_text`` and ``n`` of the last version, or of the one named."""
        version = self._version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], "key_text string, n bigint")
        name = self._name(version)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (key_text STRING, n BIGINT) USING parquet"
            f" CLUSTERED BY (key_text) SORTED BY (key_text) INTO {self.buckets} BUCKETS LOCATION '{self.folder}/v{version}'"
        )
        return self.spark.table(name)

    def merged(self, day: DataFrame, key: str, version: int | None = None) -> DataFrame:
        """The counts after a day's rows; blank keys are exempt."""
        text = exact(key)
        today = day.where(is_present(text)).groupBy(text.alias("key_text")).agg(F.count("*").alias("today"))
        both = self.counts(version).join(today.hint("merge"), "key_text", "full")
        total = F.coalesce("n", F.lit(0)) + F.coalesce("today", F.lit(0))
        return both.select("key_text", total.alias("n"))

    def add(self, name: str, day: DataFrame, key: str) -> bool:
        """Merges a day in and publishes the new version; False if a day of that name is in already."""
        if self.manifest().where(F.col("day") == name).count():
            return False
        version = self._version()
        table = self._name(version + 1)
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")  # what a merge that died has left
        path = f"{self.folder}/v{version + 1}"
        writer = self.merged(day, key, version).write.bucketBy(self.buckets, "key_text").sortBy("key_text")
        writer.mode("overwrite").option("path", path).saveAsTable(table)
        keys = self.spark.table(table).count()
        record = self.spark.createDataFrame([(version + 1, name, keys)], MANIFEST).coalesce(1)
        record.write.mode("overwrite").json(f"{self.folder}/manifest/v{version + 1}")
        return True

    def repeated(self) -> DataFrame:
        """``key_text`` and ``row_count`` of the keys that came more than once, on one day or on several."""
        return self.counts().where("n > 1").select("key_text", F.col("n").alias("row_count"))
