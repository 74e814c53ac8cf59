"""Connected components of a graph given as pairs, by alternating large and small stars.

Each round groups edges by a node, takes the smallest neighbour and joins it back (Kiveris and
others 2014); the number of rounds grows with the logarithm of the number of nodes. The edges of a
node are dealt into parts, one for each shuffle partition at most: minima are taken by part, then over
the few parts, and joined back by part, so a hub's edges never meet in one task. Each round is
checkpointed, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritide.llm.common import settled


def _state(pairs: DataFrame):
    return pairs.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("mix")
    ).first()


def with_least(frame: DataFrame, key: str, spread: str, value: str, into: str) -> DataFrame:
    """The frame with ``into``, the least ``value`` of its ``key``; rows of a key are dealt into parts by ``spread``.

    Null keys are left out, and nulls among the values are passed over.
    """
    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = frame.withColumn("__part", F.pmod(F.xxhash64(spread), F.lit(parts)).cast("int"))
    by_part = dealt.groupBy(key, "__part").agg(F.min(value).alias(into))
    least = by_part.withColumn(into, F.min(into).over(Window.partitionBy(key)))  # a row for each part
    return dealt.join(least, [key, "__part"]).drop("__part")


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``root`` for each node of an edge that isn't its component's smallest node.

    Pairs with a null or with equal ends are left out. Empty edges give no rows.
    """
    pairs = settled(
        edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .where(F.col(left) != F.col(right))
        .distinct()
    )
    state = _state(pairs)
    while state["n"]:
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            with_least(both, "u", "v", "v", "m")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        small = (
            with_least(large, "u", "v", "v", "m")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        pairs = settled(small)
        before, state = state, _state(pairs)
        if state == before:
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
