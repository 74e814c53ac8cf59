"""A prefix trie of conversations from sorted sequences, their LCPs and a sparse table of minima.

Conversations are sorted by their sequences of turns, each turn a digest of role and text. What neighbours
share is their LCP, and conversations share a prefix of e turns exactly if no LCP between them is below e. So
each prefix, taken where it first stands, finds its first and last member by two binary searches in a sparse
table of range minima, one to the left and one to the right, on its own and in any order; no stack is kept.
Numbers of a node are then sums and minima over an interval: conversations, smallest member, leaves
(sequences that go no further), and the bytes that neighbours share, which add up to what sharing saves.

The sort is one of Spark's ranges, and each range builds its own table. Only nodes on the path of a range's first or
last sequence can go on in the next range, at most ``SLAB`` + 1 on either side; their parts are added up on the driver, a
number of rows that grows with the ranges and not with a range. All other nodes are done where they are.

A conversation can hold any part of all turns. Turns are numbered along sorted ranges, and a sequence is cut into
slabs of ``SLAB`` turns, a row each: a slab is sorted below the hash of all turns before it (two 64-bit hashes, put
together by exclusive or with their positions), so one slab's nodes are known from its rows alone, and what deeper
slabs add is summed along a conversation, a number for each slab. ``ends_sha256`` hashes the ids of all
conversations that end at a node in their order; SHA-256 takes them one after another, so a node at which many
conversations end is hashed by one task, which streams the sorted ids and holds none of them.

Edge cases: rows without a conversation id name no conversation and are left out; null roles and texts are
empty; turns of one number are ordered by their digest, null numbers first, and repeated rows are turns of
their own; an empty table has no trie and gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritide.llm.common import col, settled, table

SLAB = 64
ROWS_PER_RANGE = 100_000
#: Ranges are smaller than that, down to this size, as long as there are fewer than shuffle partitions.
FEW_ROWS = 2_000
#: Turns of a conversation that meet its facts in one part.
TURNS_PER_PART = 4096
#: Copies of a node at the end of a slab, for its children in the next one.
SALTS = 16
#: Prefixes that are searched at once.
BATCH = 200_000
ITEM = 32  # hex digits of a turn's digest

NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string"
)
LINK = "above int, above1 long, above2 long, below int, below1 long, below2 long"
NO_ENDS = sha256(b"").hexdigest()


def _ranges(frame: DataFrame, rows: int) -> int:
    partitions = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(partitions, -(-rows // FEW_ROWS)), -(-rows // ROWS_PER_RANGE))


# Turns in order


def numbered(
    turns: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv``, ``pos`` (from 1), ``item`` (a digest of role and text) and ``size`` (bytes of the text) of each turn."""
    role, text = F.coalesce(col(role), F.lit("")), F.coalesce(col(text), F.lit(""))
    item = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    rows = turns.where(col(conversation).isNotNull()).select(
        col(conversation).cast("long").alias("conv"),
        col(turn).alias("turn"),
        F.substring(item, 1, ITEM).alias("item"),
        F.octet_length(text).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("place"),
    )
    rows = settled(rows)
    ranges = _ranges(rows, rows.count())
    order = ["conv", "turn", "item", "place"]
    dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    dealt = dealt.withColumn("range", F.spark_partition_id()).drop("place", "turn")
    placed = settled(dealt.mapInPandas(_placed, "conv long, item string, size long, range int, at long, head boolean"))
    bounds = placed.groupBy("range").agg(
        F.min_by("conv", F.struct("conv")).alias("first"),
        F.max("conv").alias("last"),
        F.max("at").alias("longest"),
        F.max(F.when(F.col("head"), F.col("at"))).alias("of_first"),
        F.max(F.struct("conv", "at"))["at"].alias("of_last"),
    )
    before, carried = {}, (None, 0)
    for b in sorted(bounds.collect(), key=lambda r: r["range"]):
        start = carried[1] if carried[0] == b["first"] else 0
        before[b["range"]] = start
        carried = (b["last"], b["of_last"] + (start if b["first"] == b["last"] else 0))
    offsets = table([before.get(i, 0) for i in range(max(before, default=0) + 1)], "long")
    offset = F.when(F.col("head"), F.get(offsets, F.col("range"))).otherwise(F.lit(0))
    return placed.select("conv", (F.col("at") + offset).alias("pos"), "item", "size")


def _placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The number of each turn among its conversation's in the range, and whether that is the range's first."""
    first = last = None
    held = 0
    for frame in frames:
        if not len(frame):
            continue
        conv = frame["conv"].to_numpy()
        first = conv[0] if first is None else first
        starts = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        run = np.repeat(starts, np.diff(np.append(starts, len(conv))))
        at = np.arange(len(conv)) - run + 1
        if last is not None and conv[0] == last:
            at[conv == last] += held
        last, held = conv[-1], int(at[-1])
        yield frame.assign(at=at, head=conv == first)


def rebuilt(turns: DataFrame, *, block: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations whose heads come from the first conversation of their ``block`` of ids.

    Of conversation c the first h turns are those of c - c % block (all if fewer, none if absent), with
    h = crc32(c) % most, and then come its own turns after its first h. Takes and returns what ``numbered`` gives, and
    the ``length`` of each ``conv``, which may be 0.
    """
    own = turns.groupBy("conv").agg(F.max("pos").alias("n"))
    base, h = F.col("conv") - F.col("conv") % block, F.crc32(F.col("conv").cast("string").cast("binary")) % most
    facts = own.select("conv", "n", base.alias("base"), h.alias("h"))
    given = own.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    facts = facts.join(given, "base", "left").withColumn("k", F.least("h", F.coalesce("base_n", F.lit(0))))
    length = (F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")
    facts = settled(facts.select("conv", "n", "base", "h", "k", length))
    heads = turns.where(F.col("pos") < most).withColumnRenamed("conv", "base")
    taken = heads.join(facts.select("conv", "base", "h"), "base").where("pos <= h").select("conv", "pos", "item", "size")
    # A long conversation meets its facts in parts.
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n") / TURNS_PER_PART))).alias("part")
    rest = turns.withColumn("part", F.floor(F.col("pos") / TURNS_PER_PART)).join(
        facts.select("conv", "h", "k", part), ["conv", "part"]
    )
    rest = rest.where("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "item", "size")
    return taken.unionAll(rest), facts.select("conv", "length")


# Slabs


def _hashes(slab: Column, path: Column) -> list[Column]:
    return [F.xxhash64(F.lit(seed), slab, path) for seed in (1, 2)]


def slabs(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row for every ``SLAB`` turns of a conversation, and one for a conversation without any.

    ``p1``, ``p2`` hash all turns of earlier slabs, and ``q1``, ``q2`` all up to this one's end; ``goes_on`` says whether there
    are later slabs.
    """
    slab = F.floor((F.col("pos") - 1) / SLAB).cast("int").alias("slab")
    held = F.sort_array(F.collect_list(F.struct("pos", "item", "size")))
    rows = turns.select("conv", slab, "pos", "item", "size").groupBy("conv", "slab").agg(held.alias("held"))
    cells = F.ceil(F.greatest(F.col("length"), F.lit(1)) / SLAB).cast("int")
    planned = lengths.select("conv", "length", F.explode(F.sequence(F.lit(0), cells - 1)).alias("slab"))
    rows = planned.join(rows, ["conv", "slab"], "left").select(
        "conv",
        "slab",
        F.coalesce(F.array_join("held.item", ""), F.lit("")).alias("path"),
        F.coalesce("held.size", F.array().cast("array<bigint>")).alias("sizes"),
        (F.col("length") > (F.col("slab") + 1) * SLAB).alias("goes_on"),
        (F.col("length") > SLAB).alias("long"),
    )
    rows = settled(rows)
    own = [x.alias(f"x{i}") for i, x in enumerate(_hashes(F.col("slab"), F.col("path")), 1)]
    hashed = rows.select("*", *own)
    earlier = Window.partitionBy("conv").orderBy("slab").rowsBetween(Window.unboundedPreceding, -1)
    many = hashed.where("long").select(
        "*", *[F.coalesce(F.bit_xor(f"x{i}").over(earlier), F.lit(0)).alias(f"p{i}") for i in (1, 2)]
    )
    one = hashed.where("NOT long").select("*", *[F.lit(0).cast("long").alias(f"p{i}") for i in (1, 2)])
    after = [F.col(f"p{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"q{i}") for i in (1, 2)]
    return many.unionAll(one).select("conv", "slab", "path", "sizes", "goes_on", "p1", "p2", *after)


GROUP = ["slab", "p1", "p2"]


def _sorted(rows: DataFrame) -> DataFrame:
    """The rows in ranges, stored, each with the number of its ``range``. Of equal slabs those that end come first."""
    order = [*GROUP, "path", "goes_on", "conv"]
    rows = settled(rows)
    dealt = rows.repartitionByRange(_ranges(rows, rows.count()), *order).sortWithinPartitions(*order)
    return settled(dealt.withColumn("range", F.spark_partition_id()))


def _shared(a: str, b: str) -> int:
    """How many items two paths share at their start."""
    if a == b:
        return len(a) // ITEM
    low, high = 0, min(len(a), len(b)) // ITEM
    while low < high and a[low * ITEM : (low + 1) * ITEM] == b[low * ITEM : (low + 1) * ITEM]:
        low += 1
    return low


def _lcp(a: tuple, b: tuple) -> int:
    """The LCP of two rows (group and path); -1 if they don't stand below one prefix."""
    return _shared(a[3], b[3]) if a[:3] == b[:3] else -1


@dataclass
class Edge:
    """How a range meets its neighbours: LCPs, and whether one run of equal ended rows goes on over an edge."""

    left: int = -1
    right: int = -1
    run_left: bool = False
    run_right: bool = False
    run: int = -1  # the range in which the run over the left edge starts
    paths: dict = field(default_factory=dict)


def _edges(rows: DataFrame) -> dict[int, Edge]:
    """The edge of each range that has rows; two rows of each come to the driver."""

    def ends(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = last = None
        for frame in frames:
            if len(frame):
                first = frame.iloc[:1] if first is None else first
                last = frame.iloc[-1:]
        if first is not None:
            yield pd.concat([first, last])

    kind = "range int, slab int, p1 long, p2 long, path string, goes_on boolean"
    found = rows.select("range", *GROUP, "path", "goes_on").mapInPandas(ends, kind).collect()
    by_range: dict[int, list] = {}
    for r in found:
        by_range.setdefault(r["range"], []).append(tuple(r)[1:])
    edges, before = {}, None
    for number in sorted(by_range):
        first, last = by_range[number]
        edge = edges[number] = Edge()
        if before is not None:
            earlier, own = before
            edge.left = edges[earlier].right = _lcp(own, first)
            edge.run_left = edges[earlier].run_right = own == first and not first[4]
            if edge.run_left:
                whole = edges[earlier].run_left and edges[earlier].paths["whole"]
                edge.run = edges[earlier].run if whole else earlier
        edge.paths["whole"] = first == last
        before = number, last
    return edges


# One range


class Minima:
    """A sparse table: the minimum of any run of values from two overlapping powers of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def over(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minima over [first, last]."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), self.levels[0].dtype)
        for k in np.unique(level):
            own = level == k
            out[own] = np.minimum(self.levels[k][first[own]], self.levels[k][last[own] - (1 << k) + 1])
        return out

    def extent_right(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The last place up to which no value after ``start`` is below ``least``."""
        at, size = start.copy(), len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            inside = np.flatnonzero(at + (1 << k) < size)
            go = inside[self.levels[k][at[inside] + 1] >= least[inside]]
            at[go] += 1 << k
        return at

    def extent_left(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first place from which no value up to ``start`` is below ``least``, but for its own."""
        at = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            inside = np.flatnonzero(at - (1 << k) >= 0)
            go = inside[self.levels[k][at[inside] - (1 << k) + 1] >= least[inside]]
            at[go] -= 1 << k
        return at


class Range:
    """The sorted rows of one range as arrays."""

    def __init__(self, frames: Iterator[pd.DataFrame], edges: dict[int, Edge]):
        frame = pd.concat([f for f in frames if len(f)] or [pd.DataFrame()], ignore_index=True)
        self.size = len(frame)
        if not self.size:
            return
        numbers = frame["range"].unique()
        if len(numbers) > 1:
            raise ValueError("a range was not read as it was stored")
        self.number, self.edge = int(numbers[0]), edges[int(numbers[0])]
        self.conv = frame["conv"].to_numpy(np.int64)
        self.goes_on = frame["goes_on"].to_numpy(bool)
        self.group = [frame[c].to_numpy() for c in GROUP]
        self.link = [frame[c].to_numpy() for c in ("q1", "q2")] if "q1" in frame else []
        rows = list(zip(*self.group, frame["path"], strict=True))
        self.length = np.array([len(r[3]) // ITEM for r in rows], np.int64)
        self.lcp = np.array([-1, *map(_lcp, rows, rows[1:])], np.int64)  # in the range alone
        self.known = self.lcp.copy()  # with the rows before the range
        self.known[0] = self.edge.left
        self.next = np.append(self.lcp[1:], self.edge.right)
        flat = np.concatenate([np.asarray(s, np.int64) for s in frame["sizes"]])
        self.bytes = np.concatenate([[0], np.cumsum(flat)])
        self.offset = np.cumsum(self.length) - self.length
        zeros = np.zeros(self.size, np.int64)
        deep = [frame[c].to_numpy(np.int64) if c in frame else zeros for c in ("deep_leaves", "deep_saved", "starts")]
        self.leaves = ((self.next < self.length) & ~self.goes_on) + deep[0]
        self.shared = np.where(self.known > 0, self.upto(np.arange(self.size), np.maximum(self.known, 0)), 0)
        self.deep_saved, self.starts = deep[1], deep[2]
        self.lcps, self.smallest = Minima(self.lcp), Minima(self.conv)
        self.sums = [np.concatenate([[0], np.cumsum(x)]) for x in (self.leaves, self.deep_saved, self.starts, self.shared)]
        own = np.flatnonzero((self.length > self.lcp) & (self.lcp >= 0))
        self.turning = np.sort(self.lcp[own] * self.size + own)

    def upto(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Bytes of a row's first turns."""
        return self.bytes[self.offset[row] + depth] - self.bytes[self.offset[row]]

    def measured(self, first: np.ndarray, last: np.ndarray, depth: np.ndarray) -> list[np.ndarray]:
        """What the rows of an interval add to a node of that depth: members, smallest, children, leaves, and
        saved bytes but for the prefix above the node."""
        leaves, deep, starts, shared = (s[last + 1] - s[first] for s in self.sums)
        turning = [np.searchsorted(self.turning, depth * self.size + x, "right") for x in (first, last)]
        opening = (self.known[first] <= depth) & (self.length[first] > depth)
        children = np.where(depth == SLAB, starts, turning[1] - turning[0] + opening)
        own = np.where(self.known[first] >= depth, 0, self.shared[first])
        return [last - first + 1, self.smallest.over(first, last), children, leaves, deep + shared - own]

    def pieces(self) -> list[tuple]:
        """(whether on the first row's path, on the last one's, depth, measures) of the nodes on these paths."""
        root = 0 if self.group[0][0] == 0 else 1
        depth = np.arange(root, self.length[0] + 1)
        first = np.zeros(len(depth), np.int64)
        last = self.lcps.extent_right(first, depth)
        out = [(True, bool(z == self.size - 1), int(d), *m) for z, d, *m in zip(last.tolist(), depth, *(x.tolist() for x in self.measured(first, last, depth)), strict=True)]
        root = 0 if self.group[0][-1] == 0 else 1
        depth = np.arange(root, self.length[-1] + 1)
        last = np.full(len(depth), self.size - 1)
        first = self.lcps.extent_left(last, depth)
        out += [(False, True, int(d), *m) for a, d, *m in zip(first.tolist(), depth, *(x.tolist() for x in self.measured(first, last, depth)), strict=True) if a > 0]
        return out

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """For each row, whether it ends here, and the last row of its run of equal ended rows."""
        ended = ~self.goes_on
        same = (self.lcp == self.length) & (np.append(-1, self.length[:-1]) == self.length)
        same &= ended & np.append(False, ended[:-1])
        starts = np.flatnonzero(~same)
        return ended, np.repeat(np.append(starts[1:], self.size) - 1, np.diff(np.append(starts, self.size)))

    def nodes(self, joined: dict, digests: dict[int, str]) -> Iterator[pd.DataFrame]:
        """The nodes that start in this range. ``joined`` has the measures of nodes over its edges, by side and depth."""
        ended, run = self.runs()
        lowest = np.where(self.group[0] == 0, 0, 1)
        start = np.maximum(self.known + 1, lowest)
        count = np.maximum(self.length - start + 1, 0)
        bounds = np.cumsum(count)
        cuts = np.searchsorted(bounds, np.arange(BATCH, bounds[-1] + BATCH, BATCH), "left") + 1
        low = 0
        for high in np.unique(np.minimum(cuts, self.size)):
            own = np.arange(low, high)
            low = high
            row = np.repeat(own, count[own])
            if not len(row):
                continue
            within = np.arange(len(row)) - np.repeat(np.cumsum(count[own]) - count[own], count[own])
            depth = start[row] + within
            yield self._described(row, depth, lowest, ended, run, joined, digests)

    def _described(self, row, depth, lowest, ended, run, joined, digests) -> pd.DataFrame:
        first, last = self.lcps.extent_left(row, depth), self.lcps.extent_right(row, depth)
        measures = self.measured(first, last, depth)
        over = (last == self.size - 1) & (self.edge.right >= depth)
        for i in np.flatnonzero(over):
            for m, value in zip(measures, joined["right"][int(depth[i])], strict=True):
                m[i] = value
        members, smallest, children, leaves, saved = measures
        above = self.upto(row, np.maximum(depth - 1, 0))
        saved = saved - (members - 1) * above
        upper = depth - 1
        has = upper >= lowest[row]
        parent = np.zeros(len(row), np.int64)
        a, z = self.lcps.extent_left(row[has], upper[has]), self.lcps.extent_right(row[has], upper[has])
        found = self.smallest.over(a, z)
        left = (a == 0) & (self.edge.left >= upper[has])
        right = (z == self.size - 1) & (self.edge.right >= upper[has])
        for i in np.flatnonzero(left | right):
            found[i] = joined["left" if left[i] else "right"][int(upper[has][i])][1]
        parent[has] = found
        group = [g[row] for g in self.group]
        ends = []
        for i, d in zip(row.tolist(), depth.tolist(), strict=True):
            if self.length[i] != d or not ended[i]:
                ends.append(NO_ENDS)
            elif run[i] == self.size - 1 and self.edge.run_right:
                ends.append(digests[self.number])
            else:
                ends.append(sha256(",".join(map(str, self.conv[i : run[i] + 1].tolist())).encode()).hexdigest())
        below = depth == SLAB
        frame = pd.DataFrame(
            {
                "conv_id": smallest,
                "depth": group[0].astype(np.int64) * SLAB + depth,
                "parent_conv_id": pd.arrays.IntegerArray(parent, ~has),
                "n_convs": members,
                "n_children": children,
                "n_leaves": leaves,
                "saved_tokens": saved,
                "ends_sha256": ends,
            }
        )
        unknown = ~has & (group[0] > 0)
        links = [(unknown, group), (below, [group[0] + 1, self.link[0][row], self.link[1][row]])]
        for name, (mask, values) in zip(("above", "below"), links, strict=True):
            for c, v in zip(("", "1", "2"), values, strict=True):
                frame[name + c] = pd.arrays.IntegerArray(v.astype(np.int64), ~mask)
        return frame


# All ranges


def _joined(pieces: list, edges: dict[int, Edge]) -> dict[int, dict]:
    """The measures of nodes that lie on a range's edge, over all ranges, by range, side and depth."""
    by_range: dict[int, list] = {}
    for p in pieces:
        by_range.setdefault(p["range"], []).append(p)
    out, running = {}, {}
    for number in sorted(by_range):
        left, right, edge = {}, {}, edges[number]
        for p in by_range[number]:
            value = [p["members"], p["smallest"], p["children"], p["leaves"], p["saved"]]
            d = p["depth"]
            if p["first"] and d <= edge.left:
                total = running[d]
                total[1] = min(total[1], value[1])
                for i in (0, 2, 3, 4):
                    total[i] += value[i]
            else:
                total = value
            if p["first"]:
                left[d] = total
            if p["last"]:
                right[d] = total
        out[number] = {"left": left, "right": right}
        running = right
    return out


PIECE = (
    "range int, first boolean, last boolean, depth long, members long, smallest long, children long, leaves long, saved long"
)


def _deeper(rows: DataFrame) -> DataFrame:
    """What the slabs below each slab add to it: leaves, saved bytes, and whether its next slab starts a child."""
    under = _sorted(rows.where("slab > 0"))
    edges = _edges(under)

    def facts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Range(frames, edges)
        if own.size:
            yield pd.DataFrame(
                {
                    "conv": own.conv,
                    "slab": own.group[0] - 1,
                    "leaf": own.leaves,
                    "saved": own.shared,
                    "starts": (own.known <= 0).astype(np.int64),
                }
            )

    found = under.mapInPandas(facts, "conv long, slab int, leaf long, saved long, starts long")
    down = Window.partitionBy("conv").orderBy(F.col("slab").desc())
    return found.select(
        "conv", "slab", F.sum("leaf").over(down).alias("deep_leaves"), F.sum("saved").over(down).alias("deep_saved"), "starts"
    )


def _long_ends(rows: DataFrame, edges: dict[int, Edge]) -> dict[int, str]:
    """The digest of the ids of each run of equal ended rows that goes over an edge, by the range where it starts."""

    def members(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Range(frames, edges)
        if not own.size:
            return
        _, run = own.runs()
        edge, spans = own.edge, []
        if edge.run_left:
            spans.append((edge.run, 0, int(run[0])))
        if edge.run_right and not (edge.run_left and run[0] == own.size - 1):
            spans.append((own.number, int(np.searchsorted(run, own.size - 1)), own.size - 1))
        for number, a, z in spans:
            yield pd.DataFrame({"run": number, "conv": own.conv[a : z + 1]})

    def hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, None
        for frame in frames:
            for number, part in frame.groupby("run", sort=False):
                ids = ",".join(map(str, part["conv"].tolist())).encode()
                if number == at:
                    state.update(b"," + ids)
                else:
                    if at is not None:
                        yield pd.DataFrame({"run": [at], "digest": [state.hexdigest()]})
                    at, state = number, sha256(ids)
        if at is not None:
            yield pd.DataFrame({"run": [at], "digest": [state.hexdigest()]})

    if not any(e.run_right for e in edges.values()):
        return {}
    found = rows.mapInPandas(members, "run int, conv long").repartition("run").sortWithinPartitions("run", "conv")
    return {r["run"]: r["digest"] for r in found.mapInPandas(hashed, "run int, digest string").collect()}


def trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row for each node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``
    and ``saved_tokens`` (bytes) of its subtree, and ``ends_sha256``.

    ``turns`` holds ``conv``, ``pos`` (from 1, without gaps), ``item`` and ``size``, and ``lengths`` each ``conv`` with its number of turns.
    """
    rows = settled(slabs(turns, lengths))
    rows = rows.join(_deeper(rows), ["conv", "slab"], "left").fillna(0, ["deep_leaves", "deep_saved", "starts"])
    rows = _sorted(rows)
    edges = _edges(rows)

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Range(frames, edges)
        if own.size:
            names = [f.split()[0] for f in PIECE.split(", ")]
            yield pd.DataFrame([(own.number, *p) for p in own.pieces()], columns=names)

    joined = _joined(rows.mapInPandas(pieces, PIECE).collect(), edges)
    digests = _long_ends(rows, edges)
    shared = rows.sparkSession.sparkContext.broadcast((joined, digests))

    def nodes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        joined, digests = shared.value
        own = Range(frames, edges)
        if own.size:
            yield from own.nodes(joined[own.number], digests)

    found = settled(rows.mapInPandas(nodes, f"{NODE}, {LINK}"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    ends = found.where("below IS NOT NULL").select(
        F.col("below").alias("above"), F.col("below1").alias("above1"), F.col("below2").alias("above2"), F.col("conv_id").alias("up"), salts
    )
    lost = found.where("above IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).cast("int"))
    names = [f.split()[0] for f in NODE.split(", ")]
    linked = lost.join(ends, ["above", "above1", "above2", "salt"]).withColumn("parent_conv_id", F.col("up"))
    return found.where("above IS NULL").select(names).unionAll(linked.select(names))
