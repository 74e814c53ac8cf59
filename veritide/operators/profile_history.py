"""Completeness and distinct values over many days, from what was kept of each day.

A day is read once. What is kept of it is a row for each column: counts and a sketch of the distinct values, 16 KB at
most whatever the day's size. Counts add up and sketches merge, so any range of days is profiled without reading a day
again. A day's one file gets its name when it is whole; a day that is there is not added twice.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritide.functions.numbers import percent
from veritide.operators.profile import data_columns, is_missing
from veritide.operators.reshape import long_form
from veritide.sources.tables import exists

SKETCH_BITS = 14
#: Three standard deviations of merged sketches with 2^14 registers; below some thousand values they are closer.
ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)
KEPT = "column string, row_count bigint, missing_count bigint, sketch binary, part string"


def kept_of(table: DataFrame) -> DataFrame:
    """``column, row_count, missing_count, sketch`` of a table in one pass; null and NaN are missing."""
    columns = data_columns(table)
    measured = table.agg(
        F.count("*").alias("row_count"),
        *[F.count_if(is_missing(table, c)).alias(f"missing__{i}") for i, c in enumerate(columns)],
        *[_sketch(table, c).alias(f"sketch__{i}") for i, c in enumerate(columns)],
    )
    rows = [
        [F.lit(c), F.col("row_count"), F.col(f"missing__{i}"), F.col(f"sketch__{i}")]
        for i, c in enumerate(columns)
    ]
    return long_form(measured, ["column", "row_count", "missing_count", "sketch"], rows)


def _sketch(table: DataFrame, column: str) -> Column:
    return F.hll_sketch_agg(F.when(~is_missing(table, column), F.col(column).cast("string")), SKETCH_BITS)


@dataclass(frozen=True)
class ProfileHistory:
    """Profiles of days, or other parts that sort by their names, below ``folder``, which all executors reach."""

    spark: SparkSession
    folder: str

    def add(self, part: str, table: DataFrame) -> bool:
        """Keeps the profile of a part; False if a part of that name is in already."""
        if not re.fullmatch(r"[\w-]+", part):
            raise ValueError("a part's name has letters, digits, _ and - only")
        path = f"{self.folder}/{part}"
        if exists(self.spark, f"{path}/_SUCCESS"):
            return False
        kept_of(table).withColumn("part", F.lit(part)).coalesce(1).write.mode("overwrite").parquet(path)
        return True

    def parts(self) -> DataFrame:
        if not exists(self.spark, self.folder):
            return self.spark.createDataFrame([], KEPT)
        return self.spark.read.schema(KEPT).parquet(f"{self.folder}/*/part-*")

    def merged(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """``column, row_count, missing_count, missing_pct, distinct_estimate`` of the parts from ``first`` to ``last``.

        The estimate is within ``ERROR`` of the exact number of distinct values, but for one time in some hundred. A
        column that some parts lack is profiled over those that have it.
        """
        wanted: Column = F.lit(True)
        if first is not None:
            wanted &= F.col("part") >= first
        if last is not None:
            wanted &= F.col("part") <= last
        total = self.parts().where(wanted).groupBy("column").agg(
            F.sum("row_count").alias("row_count"),
            F.sum("missing_count").alias("missing_count"),
            F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("distinct_estimate"),
        )
        share = percent(F.col("missing_count"), F.col("row_count")).alias("missing_pct")
        return total.select("column", "row_count", "missing_count", share, "distinct_estimate")
