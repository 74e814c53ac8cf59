"""Key uniqueness at any skew."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritide.contract import ROW_ID
from veritide.functions.names import exact
from veritide.functions.text import is_present

# Parts of a key for each shuffle partition; more parts spread a hot key more evenly.
PARTS_PER_PARTITION = 16
PART = "__veritide_part"


def repeated_keys(keyed: DataFrame, key: list[str]) -> DataFrame:
    """The rows of ``keyed`` (with row numbers) whose ``key``, of one or more columns, occurs more than once.

    The rows of every key, hot or not, are cut into parts by a hash of their row number. Parts are
    counted and added up by key, a few numbers for each key, and the rows meet the verdict by key and
    part. So a key that all rows share is spread over all tasks, and no constant decides which keys are.
    """
    partitions = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64(ROW_ID), F.lit(PARTS_PER_PARTITION * partitions)).alias(PART)
    dealt = keyed.select("*", part)
    counts = dealt.groupBy(*key, PART).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*key))
    repeated = counts.select(*key, PART, total.alias("n")).filter("n > 1")
    return dealt.join(repeated.drop("n"), [*key, PART], "left_semi").drop(PART)


def repeated_rows(table: DataFrame, *keys: str) -> DataFrame:
    """``(row_id, column, key_text)`` of every row whose text in one of the key columns occurs more than once there;
    blank texts are exempt. All key columns travel in one exchange, and no other column moves."""
    cells = [F.struct(F.lit(k).alias("column"), exact(k).alias("key_text")) for k in keys]
    stacked = table.select(ROW_ID, F.explode(F.array(*cells)).alias("cell")).select(ROW_ID, "cell.*")
    return repeated_keys(stacked.filter(is_present(F.col("key_text"))), ["column", "key_text"])
