"""Shards of near equal bytes by a k-d tree over document metadata.

A node that stands for s shards is split along its widest dimension into nodes of s//2 and s - s//2
shards, at the weighted quantile that gives each side its part of the bytes. Every level of the tree
is a few aggregations for all its nodes at once: extents, then histograms of the bytes by position
that narrow the cut down. Each task adds up its own rows first, so what is shuffled and collected is
bounded by shards times ``BINS``, and a value or key that many rows share costs no task more.

Dimensions are numbers from 0 to 1: bytes and ``numbers`` on a log scale, ``names`` by hash. A value
that many rows share becomes an interval: the hash of id and text puts the rows of equal values in an
order within it, so equal metadata can be cut as well. Rows that are equal in id and text stand at one point;
where a cut falls on such a point, or on more bytes than ``TOLERANCE`` allows that no bin tells apart, the rows there are
cut by a hash of their places, found by the same histograms.

Edge cases: a null text has no bytes and crc32 0; null metadata take a place of their own before all
values; shards of an empty table don't appear. Repeated rows are rows of their own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritide.llm.common import col, settled, table

OVERHEAD = 16  # bytes counted for each document besides its text
BINS = 4096
ROUNDS = 5
TIE_ROUNDS = 2
#: A cut is exact enough if the bytes of its last bin are this part of a shard.
TOLERANCE = 0.002
ROWS_PER_BLOCK = 50_000


@dataclass(frozen=True)
class Node:
    first: int
    shards: int
    dimension: int = 0
    low: float = 0.0
    high: float = 1.0
    below: float = 0.0  # bytes of the node before ``low``
    cut: float = math.inf
    top: float = math.inf  # from ``cut`` to here the hash of the place decides
    tie: float = 0.0
    done: bool = False


def _position(value: Column, jitter: Column) -> Column:
    """A number or null on a log scale; equal whole numbers share an interval."""
    scaled = F.log1p(F.greatest(value.cast("double"), F.lit(0.0)) + jitter) / 45
    return F.coalesce(scaled * 0.9 + 0.1, jitter * 0.05)


def _hashed(value: Column, jitter: Column) -> Column:
    share = (F.pmod(F.xxhash64(value.cast("string")), F.lit(1 << 16)) + jitter) / (1 << 16)
    return F.when(value.isNull(), jitter * 0.05).otherwise(share * 0.9 + 0.1)


def _measured(
    documents: DataFrame, numbers: list[str], names: list[str], doc_id: str, text: str
) -> DataFrame:
    """One narrow row for each document: id, size, crc32, place of the row and positions."""
    plain = documents.select(
        col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(col(text)), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32(col(text).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.monotonically_increasing_id().alias("place"),
        *[col(c).alias(f"n{i}") for i, c in enumerate([*numbers, *names])],
    )
    jitter = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(1 << 32)) / float(1 << 32)
    by_place = F.pmod(F.xxhash64("place"), F.lit(1 << 52)) / float(1 << 52)
    dimensions = [_position(F.col("size"), F.col("jitter"))]
    for i in range(len(numbers) + len(names)):
        place = _position if i < len(numbers) else _hashed
        dimensions.append(place(F.col(f"n{i}"), F.col("jitter")))
    narrow = plain.withColumn("jitter", jitter)
    return narrow.select(
        "doc_id", "size", "text_crc32", "place", by_place.alias("tie"), *[d.alias(f"d{i}") for i, d in enumerate(dimensions)]
    )


def _pick(dimensions: int, which: Column) -> Column:
    return F.get(F.array(*[F.col(f"d{i}") for i in range(dimensions)]), which)


def _by_node(nodes: list[Node], field: str, kind: str) -> Column:
    return F.get(table([getattr(n, field) for n in nodes], kind), F.col("node"))


def _children(nodes: list[Node]) -> list[Node]:
    out = []
    for n in nodes:
        if n.shards == 1:
            out.append(Node(n.first, 1))
        else:
            left = n.shards // 2
            out += [Node(n.first, left), Node(n.first + left, n.shards - left)]
    return out


def _level(nodes: list[Node]) -> Column:
    """How the rows of these nodes go on: dimension, cut and the number of the left child, by node."""
    base = [0]
    for n in nodes[:-1]:
        base.append(base[-1] + (1 if n.shards == 1 else 2))
    return F.struct(
        table([n.dimension for n in nodes], "int").alias("dimension"),
        table([n.cut for n in nodes], "double").alias("cut"),
        table([n.top for n in nodes], "double").alias("top"),
        table([n.tie for n in nodes], "double").alias("tie"),
        table(base, "int").alias("base"),
    )


def _walked(levels: list[Column], dimensions: int) -> Column:
    """The number of a row's node below the given levels."""

    def down(node: Column, level: Column) -> Column:
        value = _pick(dimensions, F.get(level["dimension"], node))
        within = (value >= F.get(level["cut"], node)) & (F.col("tie") >= F.get(level["tie"], node))
        right = (value >= F.get(level["top"], node)) | within
        return F.get(level["base"], node) + right.cast("int")

    return F.aggregate(F.array(*levels), F.lit(0), down) if levels else F.lit(0)


def _cuts(rows: DataFrame, nodes: list[Node], dimensions: int) -> list[Node]:
    """The nodes with the dimension and the place of their cut."""
    extents = rows.groupBy("node").agg(
        F.sum("size").alias("size"),
        *[f(f"d{i}").alias(f"{k}{i}") for i in range(dimensions) for k, f in (("lo", F.min), ("hi", F.max))],
    )
    total = {}
    nodes = list(nodes)
    for r in extents.collect():
        n = nodes[r["node"]]
        total[r["node"]] = r["size"]
        widest = max(range(dimensions), key=lambda i: (r[f"hi{i}"] - r[f"lo{i}"], -i))
        nodes[r["node"]] = replace(
            n, dimension=widest, low=r[f"lo{widest}"], high=math.nextafter(r[f"hi{widest}"], 9.0), done=n.shards == 1
        )
    value = _pick(dimensions, _by_node(nodes, "dimension", "int"))
    lumps = [False] * len(nodes)
    for _ in range(ROUNDS):
        if all(n.done for n in nodes):
            break
        for i, (low, high, before, held) in _crossings(rows, nodes, value, F.lit(True), total).items():
            n, size = nodes[i], total[i]
            nearer = low if _target(n, size) - before <= before + held - _target(n, size) else high
            small, point = held <= TOLERANCE * size / n.shards, high == math.nextafter(low, 9.0)
            lumps[i] = not small
            nodes[i] = replace(n, low=low, high=high, below=before, cut=nearer, top=nearer, done=small or point)
    # What is left at one point, or in one bin, is cut by the places of its rows.
    if any(lumps):
        nodes = [replace(n, cut=n.low, top=n.high) if lump else n for n, lump in zip(nodes, lumps, strict=True)]
        own = (value >= _by_node(nodes, "cut", "double")) & (value < _by_node(nodes, "top", "double"))
        ties = [Node(n.first, n.shards, below=n.below, done=not lump) for n, lump in zip(nodes, lumps, strict=True)]
        for _ in range(TIE_ROUNDS):
            for i, (low, high, before, held) in _crossings(rows, ties, F.col("tie"), own, total).items():
                nearer = low if _target(ties[i], total[i]) - before <= before + held - _target(ties[i], total[i]) else high
                ties[i] = replace(ties[i], low=low, high=high, below=before, cut=nearer)
        nodes = [replace(n, tie=t.cut) if lump else n for n, t, lump in zip(nodes, ties, lumps, strict=True)]
    return nodes


def _target(node: Node, size: int) -> float:
    return size * (node.shards // 2) / node.shards


def _crossings(rows: DataFrame, nodes: list[Node], value: Column, own: Column, total: dict) -> dict[int, tuple]:
    """By node that isn't done, the bin in which its target falls: the edges of its values, the bytes before it, and its own."""
    low, high = _by_node(nodes, "low", "double"), _by_node(nodes, "high", "double")
    place = F.least(F.floor((value - low) / (high - low) * BINS), F.lit(BINS - 1)).cast("int")
    inside = own & ~_by_node(nodes, "done", "boolean") & (value >= low) & (value < high)
    bins = (
        rows.groupBy("node", F.when(inside, place).alias("bin"))
        .agg(F.sum("size").alias("size"), F.min(value).alias("low"), F.max(value).alias("high"))
        .where("bin IS NOT NULL")
    )
    held = F.sum("size").over(Window.partitionBy("node").orderBy("bin"))
    wanted = table([_target(n, total.get(i, 0)) - n.below for i, n in enumerate(nodes)], "double")
    crossing = bins.withColumn("held", held).where(F.col("held") > F.get(wanted, F.col("node")))
    first = crossing.groupBy("node").agg(F.min(F.struct("bin", "held", "size", "low", "high")).alias("at"))
    return {
        r["node"]: (r["low"], math.nextafter(r["high"], 9.0), nodes[r["node"]].below + r["held"] - r["size"], r["size"])
        for r in first.select("node", "at.*").collect()
    }


def sharded(
    documents: DataFrame,
    shards: int,
    *,
    numbers: tuple[str, ...] = ("n_chars",),
    names: tuple[str, ...] = ("lang", "source"),
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard`` (0 to ``shards`` - 1) and ``slot``, a number
    without gaps from 0 within the shard, for each row."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    dimensions = 1 + len(numbers) + len(names)
    stored = settled(_measured(documents, list(numbers), list(names), doc_id, text))
    levels: list[Column] = []
    nodes = [Node(0, shards)]
    while any(n.shards > 1 for n in nodes):
        nodes = _cuts(stored.withColumn("node", _walked(levels, dimensions)), nodes, dimensions)
        levels.append(_level(nodes))
        nodes = _children(nodes)
    return numbered(stored.withColumn("shard", _walked(levels, dimensions))).select(
        "doc_id", "size", "text_crc32", "shard", "slot"
    )


def numbered(rows: DataFrame) -> DataFrame:
    """The rows with ``slot``, from 0 within each shard, in the order of ``place``.

    Slots are counted in blocks of at most ``ROWS_PER_BLOCK`` stored neighbours, so a shard of any
    size is numbered by many tasks; only the blocks' counts are added up along a shard.
    """
    place = F.col("place")
    blocks = rows.withColumn("block", F.floor(place / ROWS_PER_BLOCK))
    counts = blocks.groupBy("shard", "block").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("block")
    offsets = counts.select("shard", "block", (F.sum("rows").over(before) - F.col("rows")).alias("offset"))
    within = Window.partitionBy("shard", "block").orderBy("place")
    ranked = blocks.withColumn("rank", F.row_number().over(within))
    return ranked.join(offsets, ["shard", "block"]).withColumn(
        "slot", (F.col("offset") + F.col("rank") - 1).cast("long")
    )
