"""SimHash near duplicates by meet-in-the-middle ball hashing.

Two fingerprints within distance 3 meet in a variant that is one bit from one of them and two bits
from the other. Distances 0 to 2 meet in the balls of radius 1, which every fingerprint emits. At
distance 3 the two have different parity, so only even fingerprints have to emit variants at radius 2;
and of any three bits two lie in the same half, so pairs within a half are enough: 992 of 2016.

Fingerprints are made distinct first, so a group of copies of any size emits one ball, and a variant
is emitted by at most 65 fingerprints at radius 1: no variant is hot. Variants that share a half are
shuffled as one row, by that half, and made where they meet. A half that many fingerprints share is
told beforehand by its count; its variants, and those of halves one bit away, are made before the
shuffle and dealt one by one. All fingerprints that meet in a
variant are linked to the smallest one of its radius-1 ball (at most 1 + 2 bits away), which keeps
every component whole with no pairs of a group emitted. Links are made distinct and verified.

Edge cases: a null or blank text has fingerprint zero and links like any other. Documents with a null
id are grouped too; a component without any id has a null ``component_id``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritide.llm.common import col, setting, settled
from veritide.llm.components import components, with_least

WORDS = 3
DISTANCE = 3
SEED = 42
SHINGLES_AT_ONCE = 1 << 16
#: A half is crowded if more fingerprints than this share it, and more than one in ``CROWDS`` of all: so there are
#: fewer than ``CROWDS`` such halves, and 33 times as many with those one bit away, which is what is broadcast.
CROWD = 2000
CROWDS = 20_000


def fingerprint_of(text: str | None, words: int = WORDS) -> int:
    """Majority bits of the XXH64 of all word shingles; only A-Z are lower-cased."""
    parts = (text or "").encode().lower().split()  # bytes split at ASCII white space only
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        starts, ends = [0], [len(joined)]
    else:
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        after = np.cumsum(lengths + 1)
        starts = (after - lengths - 1)[: len(parts) - words + 1].tolist()
        ends = (after - 1)[words - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        a, b = starts[at : at + SHINGLES_AT_ONCE], ends[at : at + SHINGLES_AT_ONCE]
        hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(a, b, strict=True)], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(counts * 2 > len(starts), bitorder="little")
    return int(set_bits.view("<i8")[0])


def fingerprint(text: Column, words: int = WORDS) -> Column:
    """The fingerprint as a signed 64-bit number."""

    @F.pandas_udf("long")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([fingerprint_of(t, words) for t in texts], dtype="int64")

    return of(text)


def hexadecimal(print_: Column) -> Column:
    return F.lpad(F.lower(F.hex(print_)), 16, "0")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Pairs ``hub``, ``print`` of the distinct fingerprints in column ``print``.

    Each pair is at most ``distance`` bits apart, and the pairs connect what all links connect.
    """
    if not 0 <= distance <= 3:
        raise ValueError("distances from 0 to 3 are supported: balls grow with 64 to half the distance")
    low, high = range(32), range(32, 64)
    found = _met(prints, low, high, distance, inner=True)
    if distance == 3:
        found = found.unionAll(_met(prints, high, low, distance, inner=False))
    apart = F.bit_count(F.col("hub").bitwiseXOR(F.col("print")))
    return found.where("hub != print").distinct().where(apart <= distance)


def _other_half(code: Column, other: range) -> Column:
    whole = F.lit((1 << 32) - 1)
    return F.shiftrightunsigned(code, 32) if other[0] else code.bitwiseAND(whole)


def _crowded(prints: DataFrame, other: range) -> DataFrame:
    """``half``: halves that many fingerprints share, and those one bit away, where these fingerprints go as well."""
    counts = prints.groupBy(_other_half(F.col("print"), other).alias("half")).agg(F.count("*").alias("n"))
    limit = max(CROWD, prints.count() // CROWDS)
    flips = F.lit([0, *(1 << i for i in range(32))]).cast("array<bigint>")
    around = counts.where(F.col("n") > limit).select(F.explode(flips).alias("flip"), "half")
    return settled(around.select(F.col("half").bitwiseXOR(F.col("flip")).alias("half")).distinct())


def _met_at(frame: DataFrame, masks: Column, other: range, crowded: DataFrame) -> DataFrame:
    """``print, half, salt, variant`` by the masks of each ``print`` and ``code``, dealt to where variants meet."""
    alone = F.lit([0])
    marks = F.broadcast(crowded.withColumn("crowded", F.lit(True)))
    marked = frame.withColumn("half", _other_half(F.col("code"), other)).join(marks, "half", "left")
    first = F.when(F.col("crowded"), masks).otherwise(alone)
    variant = F.col("code").bitwiseXOR(F.col("flip"))
    made = marked.select("*", F.explode(first).alias("flip")).select(
        "print",
        "half",
        variant.alias("code"),
        F.when(F.col("crowded"), variant).otherwise(F.lit(0)).alias("salt"),
        F.coalesce("crowded", F.lit(False)).alias("made"),
    )
    dealt = made.repartition(int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")), "half", "salt")
    rest = F.when(F.col("made"), alone).otherwise(masks)
    flipped = dealt.select("print", "half", "salt", "code", F.explode(rest).alias("flip"))
    return flipped.select("print", "half", "salt", variant.alias("variant"))


def _met(prints: DataFrame, own: range, other: range, distance: int, *, inner: bool) -> DataFrame:
    """Links by variants whose bits of the half ``own`` were flipped, or one bit of either half.

    Variants are dealt by their ``other`` half. All variants that flip bits of ``own`` alone share it, so
    they travel as one row and are made where they meet; in crowded halves they are made first, and dealt
    by the variant too.
    """
    ball = [_signed(1 << i) for i in own] if distance >= 2 else []
    across = [_signed(1 << i) for i in other] if distance >= 2 else []
    crowded, alone = _crowded(prints, other), F.lit([0])

    emitted = prints.select("print", F.explode(F.lit([0, *across])).alias("mask"))
    near = emitted.select("print", F.col("print").bitwiseXOR(F.col("mask")).alias("code"))
    masks = F.when(F.col("print") == F.col("code"), F.lit([0, *ball])).otherwise(alone)
    meet = ["half", "salt", "variant"]
    hubs = _met_at(near, masks, other, crowded).withColumn("hub", F.min("print").over(Window.partitionBy(*meet)))
    found = hubs.select("hub", "print") if inner else None
    if distance % 2:
        # Even fingerprints flip one bit more than the others; that makes the parity of a meeting.
        more = [_signed(1 << i | 1 << j) for i, j in itertools.combinations(own, 2)]
        outer = more if distance == 3 else [_signed(1 << i) for i in (*own, *other)]
        far = prints.where(F.bit_count("print") % 2 == 0).withColumn("code", F.col("print"))
        if distance == 1:  # flips of both halves: one row for each
            each = far.select("print", F.explode(F.lit(outer)).alias("flip"))
            far = _met_at(each.select("print", F.col("print").bitwiseXOR(F.col("flip")).alias("code")), alone, other, crowded)
        else:
            far = _met_at(far, F.lit(outer), other, crowded)
        parity = 1 if distance == 1 else 0
        meeting = hubs.where("hub = print").where(F.bit_count("variant") % 2 == parity)
        met = far.join(meeting.select(*meet, "hub").hint("shuffle_hash"), meet).select("hub", "print")
        found = met if found is None else found.unionAll(met)
    return found


def _rooted(prints: DataFrame, first: Column, distance: int) -> DataFrame:
    """``print``, ``first`` (the smallest of its rows) and ``root`` for each distinct fingerprint."""
    distinct = settled(prints.groupBy("print").agg(F.min(first).alias("first")))
    # Both sides of the joins on half and variant are dealt by half already.
    with setting(prints.sparkSession, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        linked = settled(links(distinct.select("print"), distance))
    tree = components(linked, "hub", "print")
    roots = tree.select(F.col("node").alias("print"), "root")
    return distinct.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))


def grouped(
    documents: DataFrame,
    *,
    words: int = WORDS,
    distance: int = DISTANCE,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (the smallest id that can be
    reached) and ``component_print`` (one fingerprint of the component) for each row."""
    prints = settled(
        documents.select(col(doc_id).alias("doc_id"), fingerprint(col(text), words).alias("print"))
    )
    rooted = _rooted(prints, F.col("doc_id"), distance)
    by_print = with_least(rooted, "root", "print", "first", "component_id").select("print", "root", "component_id")
    return prints.join(by_print, "print").select(
        "doc_id",
        hexadecimal(F.col("print")).alias("fingerprint"),
        "component_id",
        hexadecimal(F.col("root")).alias("component_print"),
    )


def one_of_each(
    documents: DataFrame,
    *,
    words: int = WORDS,
    distance: int = DISTANCE,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents, one row of each component: that of its smallest id, null ids last.

    An id may repeat, in one component or in several: of a component's rows that share its smallest id,
    the one whose text has the smallest digest is kept, and of rows that share the text too, the smallest
    by their other columns.
    """
    # An id and a text's digest name a row up to copies. A struct is never null, and equal if its parts are.
    key = F.struct(col(doc_id).alias("id"), F.unhex(F.sha2(col(text), 256)).alias("digest"))
    prints = settled(documents.select(key.alias("key"), fingerprint(col(text), words).alias("print")))
    rooted = _rooted(prints, F.struct(F.col("key.id").isNull().alias("last"), "key"), distance)
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.key")
    # A task leaves one row of each key before the shuffle, so copies in any number are not gathered.
    rows = documents.select(key.alias("key"), F.struct(*[col(c) for c in documents.columns]).alias("row"))
    others = [c for c, kind in documents.dtypes if c not in (doc_id, text) and "map<" not in kind]
    order = [F.col("row").getField(c) for c in others] or [F.lit(0)]
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(*order)))
    return ranked.where("rank = 1").join(kept, "key", "left_semi").select("row.*")
