"""Approximate nearest neighbours by a robust-pruned directed graph (Subramanya and others 2019).

Vectors are dealt to shards of about ``SHARD_ROWS`` by a hash of id and vector, so shards grow in number
and not in size. Each shard builds its own graph: a greedy search from the middle of the shard
proposes neighbours for a node, relaxed distance pruning keeps diverse ones (a candidate is dropped
if a kept neighbour is ``ALPHA`` times nearer to it than the node is), and edges are added both ways
and pruned again where a node has too many. Queries come in blocks; each block searches each shard
by beam search, and the best of all shards are merged. Searches of a block go in lockstep in numpy.

Largest inner products become smallest distances with one more component, sqrt(M^2 - |x|^2) for the
largest norm M of the shard, so vectors need no unit length. Results are ranked by the inner product
in double precision of the original vectors, ties to the smaller id.

Equal vectors of a shard are one node that stands for its smallest ids; k + 1 of them are all that a
result can hold.

What a beam finds depends on the data: directions without clusters and lengths that vary need wide ones. So
``SAMPLE`` queries are compared with all rows first, and the beam doubles until it finds ``RECALL`` of their nearest;
one as wide as a shard is a comparison with all of its rows.

Edge cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do rows
without an id; rows of one id are rows of their own, as queries and as candidates, and of the rows with a query's
id and vector one is its own and left out; vectors meet those of their own length only; with fewer than k
candidates all are returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritide.llm.common import settled

SHARD_ROWS = 6000
QUERY_BLOCK = 8192
DEGREE = 32
BUILD_BEAM = 64
BEAM = 160
ALPHA = 1.2
INSERTED_AT_ONCE = 512
SEARCHED_AT_ONCE = 256
#: Queries that the beam is chosen by, and the part of their nearest that it is to find.
SAMPLE = 64
RECALL = 0.95


class Graph:
    """Adjacency by position; -1 where a node has fewer edges."""

    def __init__(self, points: np.ndarray, edges: np.ndarray, entry: int):
        self.points, self.edges, self.entry = points, edges, entry
        self.square = (points * points).sum(axis=1)

    def beam(self, targets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """For each target the positions and squared distances of the nearest nodes met, best first.

        All searches take one step at a time: the nearest node not yet expanded adds its neighbours,
        and the best ``width`` stay. A search is over when all of those are expanded.
        """
        n, q = len(self.points), len(targets)
        width = min(width, n)
        seen = np.zeros((q, n + 1), bool)
        seen[:, n] = True  # where -1 points to
        entry_far = ((targets - self.points[self.entry]) ** 2).sum(axis=1)
        place = np.full((q, width), n, np.int32)
        far = np.full((q, width), np.inf, np.float32)
        open_ = np.zeros((q, width), bool)
        place[:, 0], far[:, 0], open_[:, 0] = self.entry, entry_far, True
        seen[:, self.entry] = True
        target_square = (targets * targets).sum(axis=1)
        active = np.arange(q)
        while len(active):
            best = open_[active].argmax(axis=1)
            open_[active, best] = False
            around = self.edges[place[active, best]]
            around = np.where(around < 0, n, around)
            new = ~seen[active[:, None], around]
            seen[active[:, None], around] = True
            at = np.minimum(around, n - 1)
            dot = np.matmul(self.points[at], targets[active][:, :, None])[:, :, 0]
            d = self.square[at] - 2 * dot + target_square[active][:, None]
            d = np.where(new, d, np.inf).astype(np.float32)
            far_all = np.concatenate([far[active], d], axis=1)
            place_all = np.concatenate([place[active], around], axis=1)
            open_all = np.concatenate([open_[active], new], axis=1)
            order = np.argsort(far_all, axis=1, kind="stable")[:, :width]
            far[active] = np.take_along_axis(far_all, order, axis=1)
            place[active] = np.take_along_axis(place_all, order, axis=1)
            open_[active] = np.take_along_axis(open_all, order, axis=1) & np.isfinite(far[active])
            active = active[open_[active].any(axis=1)]
        return place, far


def pruned(points: np.ndarray, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """At most ``DEGREE`` diverse neighbours of each node among its candidates (-1: none)."""
    n, c = len(points), candidates.shape[1]
    ordered = np.sort(candidates, axis=1)
    twice = np.concatenate([np.zeros((len(nodes), 1), bool), ordered[:, 1:] == ordered[:, :-1]], axis=1)
    valid = (ordered >= 0) & (ordered != nodes[:, None]) & ~twice
    at = np.where(valid, ordered, 0)
    own, theirs = points[nodes], points[at]
    d = ((theirs - own[:, None, :]) ** 2).sum(axis=2)
    d = np.where(valid, d, np.inf)
    order = np.argsort(d, axis=1, kind="stable")
    d, at = np.take_along_axis(d, order, axis=1), np.take_along_axis(at, order, axis=1)
    theirs = np.take_along_axis(theirs, order[:, :, None], axis=1)
    square = (theirs * theirs).sum(axis=2)
    between = square[:, :, None] + square[:, None, :] - 2 * np.matmul(theirs, theirs.transpose(0, 2, 1))
    alive = np.isfinite(d)
    out = np.full((len(nodes), DEGREE), -1, np.int32)
    rows = np.arange(len(nodes))
    for slot in range(min(DEGREE, c)):
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        out[some, slot] = at[rows[some], first[some]]
        near = between[rows, first] * ALPHA**2 <= d
        alive &= ~(near & some[:, None])
        alive[rows, first] = False
    return out


def built(points: np.ndarray) -> Graph:
    """The graph of a shard: random edges first, then nodes inserted in batches in a fixed order."""
    n = len(points)
    rng = np.random.default_rng(7)
    entry = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    edges = np.full((n, DEGREE), -1, np.int32)
    if n > 1:
        start = rng.integers(0, n - 1, (n, min(DEGREE // 2, n - 1))).astype(np.int32)
        start += start >= np.arange(n)[:, None]
        edges[:, : start.shape[1]] = start
    graph = Graph(points, edges, entry)
    order = rng.permutation(n)
    for at in range(0, n, INSERTED_AT_ONCE):
        nodes = order[at : at + INSERTED_AT_ONCE]
        met, _ = graph.beam(points[nodes], BUILD_BEAM)
        met = np.where(met >= n, -1, met)
        edges[nodes] = pruned(points, nodes, np.concatenate([met, edges[nodes]], axis=1))
        _add_back(points, edges, nodes)
    return graph


def _add_back(points: np.ndarray, edges: np.ndarray, nodes: np.ndarray) -> None:
    """Edges from the chosen neighbours back to the nodes, pruned where they don't fit."""
    to = edges[nodes].ravel()
    source = np.repeat(nodes, DEGREE)[to >= 0].astype(np.int32)
    to = to[to >= 0]
    order = np.argsort(to, kind="stable")
    to, source = to[order], source[order]
    targets, starts, counts = np.unique(to, return_index=True, return_counts=True)
    for at in range(0, len(targets), INSERTED_AT_ONCE):
        own, first, many = (x[at : at + INSERTED_AT_ONCE] for x in (targets, starts, counts))
        more = np.full((len(own), int(many.max())), -1, np.int32)
        column = np.arange(more.shape[1])
        taken = column < many[:, None]
        more[taken] = source[(first[:, None] + column)[taken]]
        joined = np.concatenate([edges[own], more], axis=1)
        edges[own] = pruned(points, own, joined)


def lifted(vectors: np.ndarray) -> np.ndarray:
    """One more component, so that the nearest point has the largest inner product."""
    square = (vectors * vectors).sum(axis=1)
    return np.concatenate([vectors, np.sqrt(np.maximum(square.max() - square, 0))[:, None]], axis=1)


def _unpacked(column: pd.Series, kind: str) -> np.ndarray:
    return np.stack([np.frombuffer(b, kind) for b in column]) if len(column) else np.zeros((0, 1), kind)


def _stacked(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64) + 0.0  # a zero has one sign


def _index(k: int):
    def index(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("id")
        shard = shard.loc[shard.index.repeat(shard["copies"].clip(upper=k + 1))]
        vectors = _stacked(shard["vector"])
        distinct, which = np.unique(vectors, axis=0, return_inverse=True)
        order = np.argsort(which.ravel(), kind="stable")
        bounds = np.cumsum(np.bincount(which.ravel()))[:-1]
        ids = np.split(shard["id"].to_numpy(np.int64)[order], bounds)
        points = lifted(distinct).astype(np.float32)
        graph = built(points)
        return pd.DataFrame(
            {
                "shard": shard["shard"].iloc[0],
                "size": shard["size"].iloc[0],
                "node": np.arange(len(points)),
                "entry": graph.entry,
                "ids": [x[: k + 1].tobytes() for x in ids],
                "vector": [v.tobytes() for v in distinct],
                "point": [p.tobytes() for p in points],
                "edges": [e.tobytes() for e in graph.edges],
            }
        )

    return index


FOUND = "query long, query_id long, id long, score double"


def _best(score: np.ndarray, where: np.ndarray, members: list[np.ndarray], same: int, own: int, k: int) -> Iterator[tuple[int, float]]:
    """Ids and scores of the k best rows and of those that tie with the last. Of the node ``same``, which has the query's
    vector, one row of its id is left out."""
    kept, last = 0, np.inf
    for b in np.argsort(-score, kind="stable"):
        if kept >= k and score[b] < last:
            return
        last, ids = score[b], members[where[b]].tolist()
        if where[b] == same and own in ids:
            ids.remove(own)
        for other in ids:
            yield other, float(score[b])
        kept += len(ids)


def _search(k: int, beam: int):
    def search(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, float]] = []
        if len(index) and len(queries):
            index = index.sort_values("node")
            graph = Graph(_unpacked(index["point"], "f4"), _unpacked(index["edges"], "i4"), int(index["entry"].iloc[0]))
            exact = _unpacked(index["vector"], "f8")
            members = [np.frombuffer(b, np.int64) for b in index["ids"]]
            node = {b: i for i, b in enumerate(index["vector"])}
            asked = _stacked(queries["vector"])
            numbers, ids = queries["query"].tolist(), queries["id"].tolist()
            for at in range(0, len(asked), SEARCHED_AT_ONCE):
                block = asked[at : at + SEARCHED_AT_ONCE]
                if beam >= len(exact):
                    met = [np.arange(len(exact))] * len(block)
                else:
                    # A query's length doesn't change what is nearest in the lifted space.
                    unit = block / np.linalg.norm(block, axis=1, keepdims=True) * np.linalg.norm(graph.points[0])
                    target = np.concatenate([unit, np.zeros((len(block), 1))], axis=1).astype(np.float32)
                    met = [where[np.isfinite(d)] for where, d in zip(*graph.beam(target, beam), strict=True)]
                for row, where in enumerate(met):
                    query, own = numbers[at + row], ids[at + row]
                    score = exact[where] @ block[row]
                    same = node.get(block[row].tobytes(), -1)
                    out += [(query, own, i, s) for i, s in _best(score, where, members, same, own, k)]
        names = [f.split()[0] for f in FOUND.split(", ")]
        return pd.DataFrame(out, columns=names).astype({n: "float64" if n == "score" else "int64" for n in names})

    return search


def _compared(rows: DataFrame, sample: list[tuple], k: int) -> DataFrame:
    """The best k + 1 scores of a few queries in each task's rows, and whether a row is the query's own or like it."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            held: list[tuple[int, float, bool]] = []
            for size, part in frame.groupby("size"):
                vectors, ids = _stacked(part["vector"]), part["id"].to_numpy()
                copies = np.minimum(part["copies"].to_numpy(), k + 1)
                for query, own, vector in sample:
                    if len(vector) == size:
                        score = vectors @ np.array(vector)
                        for at in np.argsort(-score, kind="stable")[: k + 1]:
                            like = bool(ids[at] == own and (vectors[at] == vector).all())
                            held += [(query, float(score[at]), like)] * copies[at]
            yield pd.DataFrame(held, columns=["query", "score", "own"])

    found = rows.select("id", "vector", "size", "copies").mapInPandas(run, "query long, score double, own boolean")
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("own").desc())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def _beam(rows: DataFrame, asked: DataFrame, indexes: DataFrame, shards: int, k: int, beam: int, widest: int) -> int:
    """The beam that finds ``RECALL`` of the nearest of a few queries, doubled until it does. At most ``SAMPLE`` queries and
    their results are on the driver."""
    some = settled(asked.orderBy(F.xxhash64("id", "query")).limit(SAMPLE))
    sample = [(r["query"], r["id"], r["vector"]) for r in some.collect()]
    scores: dict[int, list[tuple[bool, float]]] = {}
    for r in _compared(rows, sample, k).collect():
        scores.setdefault(r["query"], []).append((r["own"], r["score"]))
    least, total = {}, 0
    for query, found in scores.items():
        if any(own for own, _ in found):  # one row is the query's own
            found.remove(max(x for x in found if x[0]))
        nearest = sorted((score for _, score in found), reverse=True)[:k]
        if nearest:
            least[query], total = nearest[-1] - 1e-9 * abs(nearest[-1]), total + len(nearest)
    while beam < widest:
        met = _ranked(_met(indexes, some, shards, 1, k, beam), k).collect()
        if sum(r["score"] >= least.get(r["query"], np.inf) for r in met) >= RECALL * total:
            break
        beam *= 2
    return beam


def _met(indexes: DataFrame, asked: DataFrame, shards: int, blocks: int, k: int, beam: int) -> DataFrame:
    """What the search of each query in each shard finds."""
    each_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    each_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    copies = indexes.select("*", each_block).groupBy("size", "shard", "block")
    block = F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")
    asking = asked.withColumn("block", block).select("*", each_shard).groupBy("size", "shard", "block")
    return copies.cogroup(asking).applyInPandas(_search(k, beam), FOUND)


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda v: v.isNotNull() & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def nearest(vectors: DataFrame, queries: DataFrame, k: int, *, beam: int = BEAM) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``id`` and ``score`` of the k nearest found.

    Both frames hold ``id`` and ``vector`` (an array of numbers).
    """
    as_doubles = F.col("vector").cast("array<double>").alias("vector")

    def cleaned(frame: DataFrame) -> DataFrame:
        good = frame.select("id", as_doubles).where(F.col("id").isNotNull() & usable(F.col("vector")))
        return good.withColumn("size", F.size("vector"))

    # Equal rows are one with a number, so that an id or row that repeats without end fills no shard.
    rows = settled(cleaned(vectors).groupBy("id", "vector", "size").agg(F.count("*").alias("copies")))
    asked = settled(cleaned(queries).withColumn("query", F.monotonically_increasing_id()))
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    shard = F.pmod(F.xxhash64("id", "vector"), F.lit(shards)).cast("int")
    fields = "shard int, size int, node long, entry long, ids binary, vector binary, point binary, edges binary"
    indexes = settled(
        rows.withColumn("shard", shard).groupBy("size", "shard").applyInPandas(_index(k), fields)
    )
    widest = indexes.groupBy("size", "shard").count().agg(F.max("count")).first()[0] or 0
    beam = _beam(rows, asked, indexes, shards, k, beam, widest)
    return _ranked(_met(indexes, asked, shards, blocks, k, beam), k).select("query_id", "rank", "id", "score")
