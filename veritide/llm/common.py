"""What several operators need: checkpoints in the shared folder, and samples of labelled rows."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_folder(frame: DataFrame) -> str:
    """The shared folder of ``spark.checkpoint.dir``. Only a local session without that setting
    gets a temporary folder of this machine."""
    context = frame.sparkSession.sparkContext
    folder = context.getCheckpointDir()
    if folder is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
            folder = tempfile.mkdtemp(prefix="veritide-")
        context.setCheckpointDir(folder)
    return folder


def settled(frame: DataFrame) -> DataFrame:
    """The frame, computed once and read from the shared folder from then on."""
    checkpoint_folder(frame)
    return frame.checkpoint()


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the plans that run inside."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fresh(frame: DataFrame, stem: str) -> str:
    """A column name that the frame does not have, in any case."""
    taken = {c.lower() for c in frame.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def col(name: str) -> Column:
    """A column by its exact name, dots and back-ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def table(values: list, kind: str) -> Column:
    """A constant array. One literal, however long: Spark folds it when it plans."""
    if not values:
        return F.array().cast(f"array<{kind}>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def among_smallest(hashed: Column, wanted: int, total: int) -> Column:
    """Whether a 64-bit hash is so small that of ``total`` ids 1.25 ``wanted`` + 1000 are expected to be.

    Put before a limit to the ``wanted`` smallest hashes, it leaves the limit a few thousand rows to
    sort, however many tasks and rows there are; without it every task would send ``wanted`` rows to one.
    The limit gets less than it asks for only if the count of such ids falls short by 10 standard deviations.
    """
    kept = wanted + wanted // 4 + 1000
    if kept >= total:
        return F.lit(True)
    return hashed <= F.lit(kept * (1 << 64) // total - (1 << 63))


@dataclass(frozen=True)
class Sample:
    """Rows to learn from (``label`` 0 or 1 and the inputs) and how many labelled ids there are."""

    rows: DataFrame
    negatives: int
    positives: int


def labelled_sample(
    documents: DataFrame,
    labels: DataFrame,
    *,
    label: str,
    inputs: list[str],
    per_class: int,
    doc_id: str = "doc_id",
) -> Sample:
    """At most ``per_class`` documents of each label, those with the smallest hash of their id.

    Held-out ids are left out, and so are null ids and labels other than 0 and 1. An id with both
    labels counts as 0. Of rows with one id the smallest by its inputs is taken. Only the ids of the
    sample are broadcast: two times ``per_class`` of them at most.
    """
    known = (
        labels.select(col(doc_id).alias("id"), col(label).cast("int").alias("label"))
        .where("id IS NOT NULL AND label IN (0, 1)")
        .where(~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.min("label").alias("label"))
    )
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    hashed = F.xxhash64("id")
    drawn = [
        known.where((F.col("label") == k) & among_smallest(hashed, per_class, counts.get(k, 0)))
        .orderBy(hashed, "id")
        .limit(per_class)
        for k in (0, 1)
    ]
    ids = drawn[0].unionAll(drawn[1])
    found = documents.select(
        col(doc_id).alias("id"), F.struct(*[col(c).alias(f"in{i}") for i, c in enumerate(inputs)]).alias("inputs")
    ).join(F.broadcast(ids), "id")
    one_each = found.groupBy("id").agg(F.min(F.struct("label", "inputs")).alias("row"))
    rows = one_each.select(
        "row.label", *[F.col(f"row.inputs.in{i}").alias(c) for i, c in enumerate(inputs)]
    )
    return Sample(rows, counts.get(0, 0), counts.get(1, 0))
