"""Exact dedup in two passes of Bloom filters: only rows whose hash may repeat are shuffled.

The first pass marks, for every bit of a filter, whether some row and whether two rows or more set it.
A row can repeat only if two rows set all its bits, which the second pass looks up. Rows that fail the
look-up pass straight through; the others are grouped by the SHA-256 of their text, which decides.

The filter is cut into segments of ``SEGMENT_BITS`` that take ``ROWS_PER_SEGMENT`` rows each, so it grows with
the rows; the first 8 bytes of a digest choose the segment and the next 8 the four bits. Tasks send the
segments that their rows touch, and what meets is segments, not rows. The look-up needs the filter in
every task, so rows are taken in slices of at most ``SEGMENTS_PER_SLICE`` segments: what is broadcast is 64 MB
at most, whatever the input. A task holds two such filters while it marks.

A text that a third of all rows share is cut into parts by the rows' places: parts are counted and
added up, and rows meet the verdict by digest and part.

Edge cases: a null text counts as empty; null ids are less than all others; of rows with one id and one
text the one read last stays; an empty table gives no rows. Columns of the input are never replaced:
``verdicts`` takes only the id and the text, ``deduplicated`` returns the input's own columns.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritide.llm.common import col, settled

SEGMENT_BITS = 1 << 16
ROWS_PER_SEGMENT = 4096
SEGMENTS_PER_SLICE = 8192
#: Parts of a digest for each shuffle partition.
PARTS_PER_PARTITION = 4

SEGMENT_BYTES = SEGMENT_BITS // 8


def digest(text: Column) -> Column:
    """The SHA-256 of a text with A-Z in lower case, 32 bytes."""
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.unhex(F.sha2(lowered.cast("binary"), 256))


def _segment(segments: int) -> Column:
    """The segment of a digest: its first 8 bytes but for the sign, modulo the number of segments."""
    leading = F.conv(F.hex(F.substring("sha", 1, 8)), 16, -10).cast("long")
    return F.pmod(leading, F.lit(segments)).cast("int")


def _bits(digests: pa.Array) -> np.ndarray:
    """Four bits of its segment for each digest, from its second 8 bytes."""
    packed = np.frombuffer(b"".join(digests.to_pylist()), "<u2").reshape(-1, 16)
    return packed[:, 4:8]


class Marks:
    """Two bits for each place of a run of segments: set at all, and set more than once."""

    def __init__(self, first: int, segments: int):
        self.first = first
        self.once = np.zeros(segments * SEGMENT_BYTES, np.uint8)
        self.again = np.zeros(segments * SEGMENT_BYTES, np.uint8)

    def add(self, segments: np.ndarray, bits: np.ndarray) -> None:
        places = (segments.astype(np.int64) - self.first)[:, None] * SEGMENT_BITS + bits
        places, counts = np.unique(places, return_counts=True)
        byte, mask = places >> 3, (1 << (places & 7)).astype(np.uint8)
        repeated = (counts > 1) | (self.once[byte] & mask != 0)
        np.bitwise_or.at(self.again, byte[repeated], mask[repeated])
        np.bitwise_or.at(self.once, byte, mask)

    def rows(self) -> Iterator[tuple[int, bytes, bytes]]:
        once, again = (x.reshape(-1, SEGMENT_BYTES) for x in (self.once, self.again))
        for i in np.flatnonzero(once.any(axis=1)):
            yield self.first + int(i), zlib.compress(once[i].tobytes(), 1), zlib.compress(again[i].tobytes(), 1)


MARKED = "segment int, once binary, again binary"


def _mark(first: int, segments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        marks = Marks(first, segments)
        for batch in batches:
            if batch.num_rows:
                marks.add(batch.column("segment").to_numpy(zero_copy_only=False), _bits(batch.column("sha")))
        found = marks.rows()
        while block := [row for _, row in zip(range(256), found)]:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in block], pa.int32()), *[pa.array([r[i] for r in block], pa.binary()) for i in (1, 2)]],
                names=["segment", "once", "again"],
            )

    return run


def _merged(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The marks of each segment over all tasks; rows come sorted by segment, so one is held at a time."""
    at, once, again = None, None, None

    def done() -> pd.DataFrame:
        return pd.DataFrame({"segment": [at], "again": [zlib.compress(again.tobytes(), 1)]})

    for frame in frames:
        for segment, o, a in zip(frame["segment"], frame["once"], frame["again"], strict=True):
            o, a = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (o, a))
            if segment != at:
                if at is not None:
                    yield done()
                at, once, again = segment, o, a
            else:
                again = again | a | (once & o)
                once = once | o
    if at is not None:
        yield done()


def _repeated_bits(rows: DataFrame, first: int, segments: int) -> bytes:
    """The bits of a slice's segments that two rows or more set, on the driver: 64 MB at most."""
    marked = rows.select("segment", "sha").mapInArrow(_mark(first, segments), MARKED)
    merged = marked.repartition("segment").sortWithinPartitions("segment").mapInPandas(_merged, "segment int, again binary")
    bits = bytearray(segments * SEGMENT_BYTES)
    for row in merged.toLocalIterator():
        at = (row["segment"] - first) * SEGMENT_BYTES
        bits[at : at + SEGMENT_BYTES] = zlib.decompress(row["again"])
    return bytes(bits)


def _may_repeat(bits, first: int) -> Column:
    """Whether two rows or more set all bits of a row's digest, by the broadcast bits of its slice."""

    @F.arrow_udf("boolean")
    def run(segment: pa.Array, sha: pa.Array) -> pa.Array:
        if not len(sha):
            return pa.array([], pa.bool_())
        again = np.frombuffer(bits.value, np.uint8)
        base = (segment.to_numpy(zero_copy_only=False).astype(np.int64) - first)[:, None] * SEGMENT_BITS
        places = base + _bits(sha)
        return pa.array(((again[places >> 3] >> (places & 7).astype(np.uint8)) & 1).all(axis=1))

    return run(F.col("segment"), F.col("sha"))


def _told_apart(rows: DataFrame, count: int) -> DataFrame:
    """Rows (with ``sha``) with ``possible``: whether another row may have the same digest."""
    context = rows.sparkSession.sparkContext
    segments = max(1, -(-count // ROWS_PER_SEGMENT))
    rows = rows.withColumn("segment", _segment(segments))
    told = None
    for first in range(0, segments, SEGMENTS_PER_SLICE):
        size = min(SEGMENTS_PER_SLICE, segments - first)
        own = rows if size == segments else rows.where(F.col("segment").between(first, first + size - 1))
        bits = context.broadcast(_repeated_bits(own, first, size))
        seen = own.withColumn("possible", _may_repeat(bits, first))
        told = seen if told is None else told.unionAll(seen)
    return told.drop("segment")


def verdicts(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``keep_id`` (the largest id of the text), ``group_size``, ``kept`` and ``text_sha256`` of each row."""
    narrow = documents.select(
        col(doc_id).alias("doc_id"), digest(col(text)).alias("sha"), F.monotonically_increasing_id().alias("place")
    )
    narrow = settled(narrow)
    told = settled(_told_apart(narrow, narrow.count()))
    shown = F.lower(F.hex("sha")).alias("text_sha256")
    alone = told.where(~F.col("possible")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), shown
    )
    parts = PARTS_PER_PARTITION * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("place"), F.lit(parts)).cast("int")
    possible = told.where("possible").select("doc_id", "sha", "place", part.alias("part"))
    counted = possible.groupBy("sha", "part").agg(
        F.count("*").alias("n"), F.max(F.struct("doc_id", "place")).alias("last")
    )
    whole = Window.partitionBy("sha")
    verdict = counted.select(
        "sha", "part", F.sum("n").over(whole).alias("group_size"), F.max("last").over(whole).alias("keep")
    )
    grouped = possible.join(verdict, ["sha", "part"]).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("place") == F.col("keep.place")).alias("kept"), shown
    )
    return alone.unionAll(grouped)


def deduplicated(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with their own columns; of rows with one id and one text any one stays.

    Whole rows are shuffled only if their digest may repeat, and of those a task sends one for each digest.
    """
    rows = documents.select(
        digest(col(text)).alias("sha"),
        F.struct(col(doc_id), F.monotonically_increasing_id()).alias("order"),
        F.struct(*[col(c) for c in documents.columns]).alias("row"),
    )
    # The filters come from stored digests; the texts are read once more, for the rows themselves.
    digests = settled(rows.select("sha"))
    count = digests.count()
    if not count:
        return documents
    segments = -(-count // ROWS_PER_SEGMENT)
    narrow = digests.withColumn("segment", _segment(segments))
    rows = rows.withColumn("segment", _segment(segments))
    context, kept = documents.sparkSession.sparkContext, None
    for first in range(0, segments, SEGMENTS_PER_SLICE):
        size = min(SEGMENTS_PER_SLICE, segments - first)
        inside = F.col("segment").between(first, first + size - 1)
        bits = context.broadcast(_repeated_bits(narrow.where(inside), first, size))
        seen = rows.where(inside).withColumn("possible", _may_repeat(bits, first))
        one = seen.where("possible").groupBy("sha").agg(F.max_by("row", "order").alias("row")).select("row")
        own = seen.where(~F.col("possible")).select("row").unionAll(one)
        kept = own if kept is None else kept.unionAll(own)
    return kept.select("row.*")
