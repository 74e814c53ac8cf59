"""Dense numbers from 0 in the order of the row numbers, without a window over the whole table.

Rows fall into buckets between approximate quantiles of their row numbers. The few counts of the buckets are added up in
order, and a row's number is what comes before its bucket and its place inside. The quantiles only decide how even the
buckets are; the numbers are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritide.contract import ROW_ID

#: Buckets for each shuffle partition, and how exact their bounds are.
BUCKETS_PER_PARTITION = 4
ACCURACY = 10_000


def bucket_of(value: Column, bounds: list[int]) -> Column:
    """How many of the ascending ``bounds`` are below a value, found by halving: 0 for null."""
    held = F.lit(bounds).cast("array<bigint>")
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    # Beyond the last bound there is null, which is below nothing.
    halve = lambda at, step: F.when(F.get(held, at + step - 1) < value, at + step).otherwise(at)
    return F.aggregate(F.lit(steps).cast("array<int>"), F.lit(0), halve) if bounds else F.lit(0)


def dense_numbers(table: DataFrame, into: str = "position") -> DataFrame:
    """The table with ``into``: 0 to n - 1 without gaps, in the order of the row numbers, which may not repeat."""
    buckets = BUCKETS_PER_PARTITION * int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = [i / buckets for i in range(1, buckets)]
    bounds = table.agg(F.percentile_approx(ROW_ID, parts, ACCURACY)).first()[0] or []
    dealt = table.withColumn("__veritide_bucket", bucket_of(F.col(ROW_ID), sorted(set(bounds))))
    counts = dealt.groupBy("__veritide_bucket").agg(F.count("*").alias("__veritide_n"))
    so_far = Window.orderBy("__veritide_bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row for each bucket
    before = F.coalesce(F.sum("__veritide_n").over(so_far), F.lit(0)).alias("__veritide_before")
    offsets = F.broadcast(counts.select("__veritide_bucket", before))
    place = F.row_number().over(Window.partitionBy("__veritide_bucket").orderBy(ROW_ID))
    ranked = dealt.withColumn("__veritide_place", place).join(offsets, "__veritide_bucket")
    number = (F.col("__veritide_before") + F.col("__veritide_place") - 1).cast("bigint")
    return ranked.select(*table.columns, number.alias(into))
