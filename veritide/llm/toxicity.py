"""Toxic passages: maximum-scoring segments of token log-odds, with extreme-value calibration.

1. Each token gets the log-odds ratio between toxic and other documents under an informative
   Dirichlet prior (Monroe, Colaresi and Quinn 2008), counted by documents, so that one document
   that repeats a token counts once. A token scores the lower bound of its log-odds, and the fixed
   ``DRIFT`` where that is lower: text without evidence loses.
2. All maximal-scoring segments of a document are found in one linear scan (Ruzzo and Tompa 1999).
3. The best segment of n clean tokens follows an extreme-value law: P(S >= s) = 1 - exp(-K n
   exp(-lambda s)) (Karlin and Altschul 1990). K and lambda come from the clean documents of the
   sample. A segment is significant if its expected number by chance, K n exp(-lambda s), is at most
   ``EXPECTED``; the evidence of a document is the sum of -ln of these numbers over its
   significant segments, and of its best segment if none is.
4. A logistic curve fitted on the same sample turns the evidence into a probability.

Tokens are hashed to ``BUCKETS`` counters, so the model has a fixed size. Learning takes at most
``per_class`` documents of each label.

Edge cases: a null text counts as empty; an empty text has no segment and the lowest evidence.
Without labels of both kinds every score is the share of label 1 (one half if there are none).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritide.llm.common import col, held_out, labelled_sample

BUCKETS = 1 << 18
PER_CLASS = 5000
PRIOR = 500.0  # documents worth of prior counts
Z = 2.33  # lower bound of the log-odds, in standard deviations
DRIFT = -0.5
EXPECTED = 0.05
KEPT_WORDS = 300_000
THRESHOLD = 0.7

_TOKEN = re.compile(r"\w+")

SEGMENT = "struct<start: int, stop: int, score: double, expected: double>"


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def bucket_of(token: str) -> int:
    return zlib.crc32(token.encode()) % BUCKETS


def log_odds(positive: np.ndarray, negative: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Scores by bucket from the numbers of documents that hold a token of the bucket."""
    both = positive + negative
    prior = PRIOR * (both + 0.5) / (n1 + n0 + 1)
    a, b = positive + prior * n1 / (n1 + n0), negative + prior * n0 / (n1 + n0)
    delta = np.log(a / (n1 + PRIOR - a).clip(1e-9)) - np.log(b / (n0 + PRIOR - b).clip(1e-9))
    bound = delta - Z * np.sqrt(1 / a + 1 / b)
    return np.where(both > 0, np.maximum(bound, DRIFT), DRIFT).astype(np.float32)


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments as (start, stop, score), left to right.

    A stack of candidates with the sums before and after each; only tokens above zero start one, and
    each candidate is taken off once at most, so the time is linear.
    """
    total = np.concatenate([[0.0], np.cumsum(scores, dtype=float)])
    lefts: list[float] = []
    rights: list[float] = []
    starts: list[int] = []
    stops: list[int] = []
    below: list[int] = []  # index of the nearest candidate with a smaller left sum, or -1
    for at in np.flatnonzero(scores > 0).tolist():
        left, right, start = float(total[at]), float(total[at + 1]), at
        while True:
            j = len(lefts) - 1
            while j >= 0 and lefts[j] >= left:
                j = below[j]
            if j < 0 or rights[j] >= right:
                break
            left, start = lefts[j], starts[j]
            del lefts[j:], rights[j:], starts[j:], stops[j:], below[j:]
        lefts.append(left)
        rights.append(right)
        starts.append(start)
        stops.append(at + 1)
        below.append(j)
    return [(s, e, r - x) for s, e, x, r in zip(starts, stops, lefts, rights, strict=True)]


class Scores(dict):
    """Token to score; forgets all tokens when it is full."""

    def __init__(self, by_bucket: np.ndarray):
        self.by_bucket = by_bucket.tolist()

    def __missing__(self, token: str) -> float:
        if len(self) >= KEPT_WORDS:
            self.clear()
        score = self[token] = self.by_bucket[bucket_of(token)]
        return score


@dataclass(frozen=True)
class Model:
    by_bucket: np.ndarray
    rate: float  # lambda
    scale: float  # K
    slope: float
    offset: float

    def passages(self, text: str | None, scores: Scores) -> tuple[list[tuple], float]:
        """The significant passages by token offsets, and the evidence of the document."""
        words = tokens(text)
        if not words:
            return [], _NOTHING
        own = np.fromiter(map(scores.__getitem__, words), np.float32, len(words))
        base = np.log(self.scale * len(words))
        found, evidence, best = [], 0.0, _NOTHING
        for start, stop, s in maximal_segments(own):
            surprise = self.rate * s - base
            best = max(best, surprise)
            if surprise >= -np.log(EXPECTED):
                found.append((start, stop, s, float(np.exp(-surprise))))
                evidence += surprise
        return found, evidence if found else best


_NOTHING = -20.0  # evidence of a document without a token above zero


def chance_law(tops: np.ndarray, lengths: np.ndarray) -> tuple[float, float]:
    """lambda and K of the best scores of clean documents, by maximum likelihood.

    For a given lambda the best K is N / sum(n exp(-lambda s)); lambda is the root of the derivative,
    found by bisection between bounds that keep a single strong token significant.
    """
    if not len(tops):
        return 1.0, 1.0

    def slope(rate: float) -> float:
        weight = lengths * np.exp(-rate * tops)
        return 1 / rate - tops.mean() + (tops * weight).sum() / weight.sum()

    low, high = 0.05, 20.0
    for _ in range(60):
        middle = (low * high) ** 0.5
        low, high = (middle, high) if slope(middle) > 0 else (low, middle)
    rate = (low * high) ** 0.5
    return rate, max(1e-12, len(tops) / float((lengths * np.exp(-rate * tops)).sum()))


def calibrated(evidence: np.ndarray, label: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and offset of the logistic curve; classes count by their share of all labelled ids."""
    x = np.clip(evidence, _NOTHING, 60) / 10
    n1, n0 = label.sum(), (1 - label).sum()
    weight = np.where(label == 1, share / n1, (1 - share) / n0)
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -35, 35)))
        g = np.array([(weight * (p - label) * x).sum() + 1e-4 * a, (weight * (p - label)).sum()])
        h = weight * p * (1 - p)
        hessian = np.array([[(h * x * x).sum() + 1e-4, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(hessian, g)
        size = np.abs(step).max()
        a, b = np.array([a, b]) - step / max(1.0, size)
        if size < 1e-6:
            break
    return float(max(a, 1e-3)) / 10, float(b)


def _counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """For each bucket the documents of this task that hold it, by label."""
    held = np.zeros((2, BUCKETS), np.int64)
    for frame in frames:
        for label, text in zip(frame["label"], frame["text"], strict=True):
            held[label, np.fromiter({bucket_of(t) for t in set(tokens(text))}, np.int64)] += 1
    used = np.flatnonzero(held.any(axis=0))
    for at in range(0, len(used), 50_000):
        part = used[at : at + 50_000]
        yield pd.DataFrame({"bucket": part, "n0": held[0, part], "n1": held[1, part]})


def fit(
    documents: DataFrame,
    labels: DataFrame,
    *,
    label: str = "toxic",
    per_class: int = PER_CLASS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> Model:
    """A model from at most ``per_class`` labelled documents of each label, none of them held out.

    What the driver gets is bounded: a counter pair for each bucket, and three numbers a document of
    the sample.
    """
    sample = labelled_sample(
        documents, labels, label=label, inputs=[text], per_class=per_class, doc_id=doc_id
    )
    rows = sample.rows.select("label", col(text).alias("text"))
    by_bucket = (
        rows.mapInPandas(_counts, "bucket long, n0 long, n1 long")
        .groupBy("bucket")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .toPandas()
    )
    seen = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sample.negatives + sample.positives
    share = sample.positives / total if total else 0.5
    if not seen.get(0) or not seen.get(1):
        even = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
        return Model(np.full(BUCKETS, DRIFT, np.float32), 1.0, 1.0, 0.0, even)
    negative, positive = np.zeros(BUCKETS), np.zeros(BUCKETS)
    negative[by_bucket["bucket"]], positive[by_bucket["bucket"]] = by_bucket["n0"], by_bucket["n1"]
    scores = log_odds(positive, negative, seen[1], seen[0])

    def tops(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = Scores(scores)
        for frame in frames:
            out = []
            for kind, body in zip(frame["label"], frame["text"], strict=True):
                words = tokens(body)
                own = np.fromiter(map(cache.__getitem__, words), np.float32, len(words))
                out.append((kind, len(words), max((s for *_, s in maximal_segments(own)), default=0.0)))
            yield pd.DataFrame(out, columns=["label", "n", "top"])

    best = rows.mapInPandas(tops, "label int, n long, top double").toPandas()
    clean = best[(best["label"] == 0) & (best["n"] > 0)]
    rate, scale = chance_law(clean["top"].to_numpy(), clean["n"].to_numpy(float))
    law = Model(scores, rate, scale, 1.0, 0.0)

    def evidences(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = Scores(scores)
        for frame in frames:
            yield pd.DataFrame(
                {"label": frame["label"], "evidence": [law.passages(t, cache)[1] for t in frame["text"]]}
            )

    known = rows.mapInPandas(evidences, "label int, evidence double").toPandas()
    known = known.sort_values(["evidence", "label"])
    slope, offset = calibrated(known["evidence"].to_numpy(), known["label"].to_numpy(float), share)
    return Model(scores, rate, scale, slope, offset)


def judged(model: Model, text: Column) -> Column:
    """The score of a text and its significant passages by token offsets."""

    @F.pandas_udf(f"struct<score: double, passages: array<{SEGMENT}>>")
    def found(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cache = Scores(model.by_bucket)
        for series in parts:
            scores, passages = [], []
            for body in series:
                own, evidence = model.passages(body, cache)
                x = model.slope * float(np.clip(evidence, _NOTHING, 60)) + model.offset
                scores.append(1 / (1 + float(np.exp(-np.clip(x, -35, 35)))))
                passages.append([dict(zip(("start", "stop", "score", "expected"), p, strict=True)) for p in own])
            yield pd.DataFrame({"score": scores, "passages": passages})

    return found(text)


def scored_documents(
    documents: DataFrame,
    model: Model,
    *,
    threshold: float = THRESHOLD,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents with ``held_out``, ``score``, ``predicted`` and ``passages``; columns of these
    names are replaced."""
    with_both = documents.withColumn("passages", judged(model, col(text)))
    return (
        with_both.withColumn("score", F.col("passages.score"))
        .withColumn("passages", F.col("passages.passages"))
        .withColumn("held_out", held_out(col(doc_id)))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


def accepted(documents: DataFrame, model: Model, *, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The documents that score below ``threshold``, with the columns they have, whatever those are called."""
    return documents.where(judged(model, col(text))["score"] < threshold)
