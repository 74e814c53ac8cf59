"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A document is a sparse vector x: one value for each hash bucket that its words fall into, statistics
of its structure, and numeric metadata columns. The score is

    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

which holds all pairwise interactions of rank ``factors`` in time linear in the number of values.

The model is fitted on a bounded sample (``per_class`` documents of each label) of sparse vectors
that Spark makes; its size is fixed by ``BUCKETS`` and ``factors``, so each task gets the same few
hundred kB. Scores are made where the text is, with no shuffle.

Edge cases: a null text counts as empty; an empty text is scored by its structure and metadata; a
null, negative or non-finite metadata value counts as 0, with an indicator of its own. Without
labels, or with one label only, every score is the share of label 1 (one half if there are none).
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritide.llm.common import col, held_out, labelled_sample

BUCKETS = 1 << 13
FACTORS = 8
PER_CLASS = 3000
EPOCHS = 10
BATCH = 64
#: Values that are scored at once; the memory of a task grows with it, not with its documents.
VALUES_AT_ONCE = 200_000
KEPT_WORDS = 200_000

STATISTICS = [
    "log_bytes", "log_words", "word_length", "distinct_share", "top_word_share", "upper_share",
    "letter_share", "digit_share", "symbol_share", "mark_end_share", "bare_mark_share",
    "repeated_line_share", "log_line_words", "empty",
]

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:?!'\"-()"]] = True
_SYMBOL = ~(_LETTER | _DIGIT | _SPACE | _STOP)
_SYMBOL[:32] = False


class Buckets(dict):
    """Word to hash bucket; forgets all words when it is full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        bucket = self[word] = zlib.crc32(word.encode()) % BUCKETS
        return bucket


def structure(text: str, words: list[str], counts: Counter) -> list[float]:
    """The statistics named in ``STATISTICS``, each of the order of 1."""
    data = text.encode()
    by_byte = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    seen = max(1, int(by_byte[~_SPACE].sum()))
    lines = [x for x in text.split("\n") if x.strip()]
    marks = sum(n for w, n in counts.items() if not w[-1].isalnum())
    bare = sum(n for w, n in counts.items() if not any(c.isalnum() for c in w))
    n = max(1, len(words))
    return [
        np.log1p(len(data)) / 10,
        np.log1p(len(words)) / 10,
        min(3.0, seen / n / 10),
        len(counts) / n,
        max(counts.values(), default=0) / n,
        by_byte[_UPPER].sum() / seen,
        by_byte[_LETTER].sum() / seen,
        by_byte[_DIGIT].sum() / seen,
        by_byte[_SYMBOL].sum() / seen,
        marks / n,
        bare / n,
        1 - len(set(lines)) / max(1, len(lines)),
        np.log1p(len(words) / max(1, len(lines))) / 10,
        float(not words),
    ]


def vectors(
    texts: list[str | None], metadata: list[list[float | None]], buckets: Buckets
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds, indices and values of the sparse vectors; word values have length 1 together."""
    bounds, indices, values = [0], [], []
    dense = BUCKETS + np.arange(len(STATISTICS))
    for i, text in enumerate(texts):
        text = text or ""
        words = text.split()
        counts = Counter(words)
        own = np.fromiter(map(buckets.__getitem__, counts), np.int32, len(counts))
        tf = np.log1p(np.fromiter(counts.values(), np.float32, len(counts)))
        kept, place = np.unique(own, return_inverse=True)
        tf = np.bincount(place, tf, len(kept)).astype(np.float32)
        if len(tf):
            tf /= np.sqrt((tf * tf).sum())
        extra_at, extra = [], []
        for k, column in enumerate(metadata):
            v = column[i]
            known = v is not None and np.isfinite(v) and v >= 0
            extra_at += [BUCKETS + len(STATISTICS) + 2 * k + (0 if known else 1)]
            extra += [np.log1p(v) / 10 if known else 1.0]
        indices += [kept, dense, np.array(extra_at, np.int32)]
        values += [tf, np.array(structure(text, words, counts), np.float32), np.array(extra, np.float32)]
        bounds.append(bounds[-1] + len(kept) + len(dense) + len(extra))
    if not texts:
        return np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0, np.float32)
    return (
        np.array(bounds),
        np.concatenate(indices).astype(np.int32),
        np.concatenate(values).astype(np.float32),
    )


@dataclass(frozen=True)
class Model:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, bounds: np.ndarray, indices: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Log-odds of label 1 for each vector, by the sum-of-squares identity. No vector is empty."""
        if len(bounds) == 1:
            return np.zeros(0)
        first = np.add.reduceat(self.linear[indices] * values, bounds[:-1])
        vx = self.factors[indices] * values[:, None]
        sums = np.add.reduceat(vx, bounds[:-1], axis=0)
        squares = np.add.reduceat(vx * vx, bounds[:-1], axis=0)
        return self.bias + first + 0.5 * (sums * sums - squares).sum(axis=1)


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit_vectors(
    bounds: np.ndarray, indices: np.ndarray, values: np.ndarray, label: np.ndarray, size: int
) -> Model:
    """Logistic loss, AdaGrad over shuffled batches with a fixed seed, small L2 on what is used."""
    rng = np.random.default_rng(42)
    w, v = np.zeros(size), rng.normal(0, 0.05, (size, FACTORS))
    bias, gb, gw, gv = 0.0, 1.0, np.full(size, 0.1), np.full((size, FACTORS), 0.1)
    n = len(label)
    weight = np.where(label == 1, n / max(1, 2 * label.sum()), n / max(1, 2 * (1 - label).sum()))
    for epoch in range(EPOCHS):
        rate = 0.3 / (1 + epoch) ** 0.5
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            rows = order[at : at + BATCH]
            lengths = bounds[rows + 1] - bounds[rows]
            starts = np.concatenate([[0], np.cumsum(lengths)])
            place = np.arange(starts[-1]) + np.repeat(bounds[rows] - starts[:-1], lengths)
            ix, x = indices[place], values[place].astype(float)
            vx = v[ix] * x[:, None]
            sums = np.add.reduceat(vx, starts[:-1], axis=0)
            squares = np.add.reduceat(vx * vx, starts[:-1], axis=0)
            y = bias + np.add.reduceat(w[ix] * x, starts[:-1])
            y += 0.5 * (sums * sums - squares).sum(axis=1)
            error = (logistic(y) - label[rows]) * weight[rows] / len(rows)
            e = np.repeat(error, lengths)
            used, slot = np.unique(ix, return_inverse=True)
            dw = np.bincount(slot, e * x, len(used)) + 1e-5 * w[used]
            each = (e * x)[:, None] * (np.repeat(sums, lengths, axis=0) - vx)
            dv = np.stack([np.bincount(slot, each[:, f], len(used)) for f in range(FACTORS)], axis=1)
            dv += 1e-5 * v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            gb += error.sum() ** 2
            w[used] -= rate * dw / np.sqrt(gw[used])
            v[used] -= rate * dv / np.sqrt(gv[used])
            bias -= rate * error.sum() / gb**0.5
    return Model(float(bias), w.astype(np.float32), v.astype(np.float32))


def fit(
    documents: DataFrame,
    labels: DataFrame,
    *,
    label: str = "quality",
    metadata: tuple[str, ...] = ("n_chars",),
    per_class: int = PER_CLASS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> Model:
    """A model from at most ``per_class`` labelled documents of each label, none of them held out."""
    sample = labelled_sample(
        documents, labels, label=label, inputs=[text, *metadata], per_class=per_class, doc_id=doc_id
    )
    size = BUCKETS + len(STATISTICS) + 2 * len(metadata)

    def sparse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buckets = Buckets()
        for frame in frames:
            extra = [_numbers(frame[f"m{k}"]) for k in range(len(metadata))]
            bounds, ix, x = vectors(list(frame["text"]), extra, buckets)
            yield pd.DataFrame(
                {
                    "label": frame["label"],
                    "ix": [ix[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)],
                    "x": [x[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)],
                }
            )

    inputs = sample.rows.select(
        "label",
        col(text).alias("text"),
        *[col(c).cast("double").alias(f"m{k}") for k, c in enumerate(metadata)],
    )
    found = inputs.mapInPandas(sparse, "label int, ix binary, x binary").collect()
    found.sort(key=lambda r: (zlib.crc32(r["ix"]), r["ix"], r["x"], r["label"]))
    total = sample.negatives + sample.positives
    share = sample.positives / total if total else 0.5
    label_of = np.array([r["label"] for r in found], float)
    if not len(found) or label_of.min() == label_of.max():
        even = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
        return Model(even, np.zeros(size, np.float32), np.zeros((size, FACTORS), np.float32))
    ix = [np.frombuffer(r["ix"], np.int32) for r in found]
    x = [np.frombuffer(r["x"], np.float32) for r in found]
    bounds = np.concatenate([[0], np.cumsum([len(a) for a in ix])])
    balanced = fit_vectors(bounds, np.concatenate(ix), np.concatenate(x), label_of, size)
    prior = float(np.log(share / (1 - share)))
    return Model(balanced.bias + prior, balanced.linear, balanced.factors)


def _numbers(column: pd.Series) -> list[float | None]:
    return [None if v is None or v != v else float(v) for v in column]


def score(model: Model, text: Column, metadata: list[Column]) -> Column:
    """The probability of label 1. The model goes along with the function; its size is fixed."""

    @F.pandas_udf("double")
    def scored(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        buckets = Buckets()
        for series in parts:
            texts, extra = list(series[0]), [_numbers(s) for s in series[1:]]
            out, at = np.zeros(len(texts)), 0
            while at < len(texts):
                end, held = at, 0
                while end < len(texts) and (end == at or held < VALUES_AT_ONCE):
                    held += min(BUCKETS, len(texts[end] or "") // 6) + len(STATISTICS)
                    end += 1
                block = vectors(texts[at:end], [m[at:end] for m in extra], buckets)
                out[at:end] = logistic(model.raw(*block))
                at = end
            yield pd.Series(out)

    return scored(text, *[m.cast("double") for m in metadata])


def scored_documents(
    documents: DataFrame,
    model: Model,
    *,
    metadata: tuple[str, ...] = ("n_chars",),
    threshold: float = 0.5,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents with ``held_out``, ``score`` and ``predicted``; columns of these names are
    replaced."""
    scored = documents.withColumn("score", score(model, col(text), [col(c) for c in metadata]))
    return scored.withColumn("held_out", held_out(col(doc_id))).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def accepted(
    documents: DataFrame,
    model: Model,
    *,
    metadata: tuple[str, ...] = ("n_chars",),
    threshold: float = 0.5,
    text: str = "text",
) -> DataFrame:
    """The documents that score at least ``threshold``, with the columns they have, whatever those are called."""
    return documents.where(score(model, col(text), [col(c) for c in metadata]) >= threshold)
