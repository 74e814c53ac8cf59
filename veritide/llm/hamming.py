"""Exact top-k search in binary codes by incremental multi-index hashing.

A code of 64 bits is cut into segments, as many as promise the least work for that number of codes. If two
codes differ in at most r = m * s + a bits (m segments, 0 <= a < m), then one of the first a + 1
segments differs in at most s bits or another one in at most s - 1. So the search grows segment by
segment: each step probes one segment at exactly s flipped bits, and everything within r is known
after it. A query is done when its k-th verified distance is at most r; the rest go on.

Equal codes are one entry with its smallest ids; k + 1 of them are all a result can hold. A pair that
several probes would find is kept by the first only, which its segment distances tell, so no pair is
made distinct. Candidates farther than the k-th distance known so far are left out before the shuffle.

Edge cases: null codes and ids take no part; of several codes of one id the smallest counts; ties go
to the smaller id; with fewer than k other codes all are returned.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritide.llm.common import settled

BITS = 64
#: Segment radii whose probes of all segments are one step each; few variants differ in so few bits.
WHOLE_RADIUS = 2
#: The first step takes as many radii as it needs to compare about so many codes for each result.
FIRST_CODES = 10


def sign_code(vector: Column, bits: int = BITS) -> Column:
    """64 bits of a vector of any length, each the sign of a sum of components; null if the vector is empty or
    a component is missing or not finite.

    Bit i is set if component i plus the components i + 64, i + 128 and so on, each with a sign drawn by a hash of its
    place, are above 0: of a vector of 64 components it is the sign of component i, and no component is left out.
    """
    place = F.sequence(F.lit(0), F.lit(bits - 1))
    drawn = lambda j: F.when((j < bits) | (F.crc32(j.cast("string").cast("binary")) % 2 == 0), 1.0).otherwise(-1.0)

    def positive(i: Column) -> Column:
        own = F.sequence(i, F.greatest(i, F.size(vector) - 1), F.lit(bits))
        total = F.aggregate(own, F.lit(0.0), lambda a, j: a + drawn(j) * F.coalesce(F.get(vector, j).cast("double"), F.lit(0.0)))
        return total > 0

    one = F.lit(1).cast("long")
    code = F.aggregate(
        place, F.lit(0).cast("long"), lambda c, i: c.bitwiseOR(F.when(positive(i), F.call_function("shiftleft", one, i)).otherwise(F.lit(0).cast("long")))
    )
    whole = F.forall(vector, lambda v: v.isNotNull() & (F.abs(v) < float("inf")))
    return F.when(whole & (F.size(vector) > 0), code)


def _cuts(count: int) -> list[tuple[int, int]]:
    """(shift, width) of each of ``count`` segments."""
    edges = [round(i * BITS / count) for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _expected_radius(entries: int, k: int) -> int:
    """The distance within which k of so many random codes lie."""
    within, radius = 1, 0
    while entries * within < k << BITS and radius < BITS:
        radius += 1
        within += math.comb(BITS, radius)
    return radius


def _segments(entries: int, k: int) -> list[tuple[int, int]]:
    """The cut with the least work for a query: its probes and the codes that they meet, one unit each.

    Reckoned for random codes; results do not depend on it.
    """
    radius = _expected_radius(entries, k)

    def work(count: int) -> float:
        last, over = divmod(radius, count)
        total = 0.0
        for j, (_, width) in enumerate(_cuts(count)):
            probes = sum(math.comb(width, s) for s in range(last + (j <= over)))
            total += probes * (1 + entries / (1 << width))
        return total

    return _cuts(min(range(3, 9), key=work))


def _first_radius(cuts: list[tuple[int, int]], entries: int, k: int) -> int:
    met, radius = 0.0, -1
    while met < FIRST_CODES * k and radius < WHOLE_RADIUS:
        radius += 1
        met += sum(math.comb(width, radius) * entries / (1 << width) for _, width in cuts)
    return radius


def _segment(code: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(code, shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _flips(width: int, radius: int) -> list[int]:
    return [sum(1 << i for i in c) for c in itertools.combinations(range(width), radius)]


def top_k(codes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``id`` and ``distance`` of the k nearest codes.

    Both frames hold ``id`` and ``code``; a code with the id of the query is left out.
    """
    known = codes.where("id IS NOT NULL AND code IS NOT NULL").groupBy("id").agg(F.min("code").alias("code"))
    asked = queries.where("id IS NOT NULL AND code IS NOT NULL").groupBy("id").agg(F.min("code").alias("code"))
    by_code = Window.partitionBy("code").orderBy("id")
    first = known.withColumn("n", F.row_number().over(by_code)).where(F.col("n") <= k + 1)
    entries = settled(first.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    everything = entries.agg(F.count("*").alias("codes"), F.sum(F.size("ids")).alias("ids")).first()
    cuts = _segments(everything["codes"], k)
    first_radius = _first_radius(cuts, everything["codes"], k)
    limit = BITS + 1
    own = known.select("id", F.lit(1).alias("own"))
    others = F.lit(everything["ids"]) - F.coalesce("own", F.lit(0))
    waiting = settled(
        asked.join(own, "id", "left").select(
            F.col("id").alias("query_id"), F.col("code").alias("asked"), F.lit(limit).alias("bound"), others.alias("others")
        )
    )
    found = None
    m = len(cuts)
    steps = [[(j, s) for s in range(first_radius + 1) for j in range(m)]]
    steps += [[(j, s) for j in range(m)] for s in range(first_radius + 1, WHOLE_RADIUS + 1)]
    steps += [[(j, s)] for s in range(WHOLE_RADIUS + 1, max(w for _, w in cuts) + 1) for j in range(m)]
    for step in steps:
        if waiting.isEmpty():
            break
        fresh = None
        for j in sorted({j for j, _ in step}):
            radii = [s for i, s in step if i == j and s <= cuts[j][1]]
            flips = [f for s in radii for f in _flips(cuts[j][1], s)]
            if not flips:
                continue
            hits = _probe(waiting, entries, cuts, j, flips)
            fresh = hits if fresh is None else fresh.unionAll(hits)
        if fresh is not None:
            pairs = fresh.select("query_id", "distance", F.explode("ids").alias("id")).where("id != query_id")
            both = pairs if found is None else pairs.unionAll(found.select("query_id", "distance", "id"))
            nearest = Window.partitionBy("query_id").orderBy("distance", "id")
            found = settled(both.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k))
        j, s = step[-1]
        covered = m * s + j
        bounds = found.groupBy("query_id").agg(F.count("*").alias("n"), F.max("distance").alias("d"))
        far = F.when(F.col("n") >= k, F.col("d")).otherwise(limit)
        open_ = waiting.drop("bound").join(bounds, "query_id", "left")
        enough = F.coalesce(F.col("n"), F.lit(0)) >= F.col("others")
        waiting = settled(
            open_.withColumn("bound", F.coalesce(far, F.lit(limit)).cast("int"))
            .where((F.col("bound") > covered) & ~enough)
            .select("query_id", "asked", "bound", "others")
        )
    if found is None:
        return codes.sparkSession.createDataFrame([], "query_id long, rank int, id long, distance int")
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "id", "distance")


def _probe(
    waiting: DataFrame, entries: DataFrame, cuts: list[tuple[int, int]], j: int, flips: list[int]
) -> DataFrame:
    """Codes whose segment j is one of the flips away from a query's, found by no earlier probe."""
    probes = waiting.select("*", F.explode(F.lit(flips)).alias("flip")).select(
        "query_id", "asked", "bound", _segment(F.col("asked"), *cuts[j]).bitwiseXOR(F.col("flip").cast("long")).alias("part")
    )
    index = entries.select("code", "ids", _segment(F.col("code"), *cuts[j]).alias("part"))
    apart = F.col("asked").bitwiseXOR(F.col("code"))
    at = [F.bit_count(_segment(apart, *cut)) for cut in cuts]
    earlier = F.lit(True)
    for i in range(len(cuts)):
        if i != j:
            earlier = earlier & (at[i] >= at[j] if i > j else at[i] > at[j])
    distance = F.bit_count(apart)
    return (
        probes.join(index, "part")
        .where(earlier & (distance <= F.col("bound")))
        .select("query_id", distance.alias("distance"), "ids")
    )
