"""Soft-membership mixing: document rates whose expected token totals by domain match targets.

1. A naive Bayes classifier of hashed words, learnt from a table of labelled documents, gives each
   document posteriors p over the domains. Its counts come from at most ``per_domain`` documents of
   each domain; the temperature that makes the posteriors honest is the best of a few on a second
   sample of the same bound.
2. With t tokens in a document, rates r >= 0 minimise the squared misses of the domains' expected
   totals, sum_d (sum_i r_i t_i p_id - T_d)^2 / m_d, where m_d is the domain's total at rate 1. Projected
   gradient descent starts from rate 1, so that rates stay near each other. A step's gradient for a
   document is t_i times the dot product of its posteriors and the domains' misses, so a step is one
   aggregation to a few numbers, and a document's rate is replayed from the steps: nothing is kept for
   a document and nothing but totals leaves the tasks.
3. The step size comes from the largest eigenvalue of the moments of the posteriors.

Only DataFrame functions run; the driver handles numbers of domains and buckets only. A hot domain or
copies in any number are sums like others.

Labelled documents of domains without a weight are learnt as one more domain, whose target is the tokens
it has at rate 1: texts like them do not fill the targets of the others, which share out the rest.

Edge cases: a null text counts as empty; labels without a domain teach nothing; a document without words has the domains' shares as its
posteriors and no weight; a domain without labelled documents is left out, and its target is shared
among the others in proportion; without any labelled document, or without tokens, all rates are 1.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritide.llm.common import among_smallest, col, held_out, settled, table

BUCKETS = 1 << 12
PER_DOMAIN = 1500
SMOOTHING = 0.5
TEMPERATURES = [0.02, 0.05, 0.1, 0.2, 0.4, 0.7, 1.0]
STEPS = 40
PRECISION = 1e-4
#: The domain of all labelled documents whose own one has no weight; underscores follow where it is taken.
OTHER = "other"


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), lambda w: w != "")


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


@dataclass(frozen=True)
class Classifier:
    domains: list[str]
    shares: list[float]
    weights: list[list[float]]  # log-probability of a bucket, by domain, less that of the first
    temperature: float

    def posteriors(self, evidence: list[Column], temperature: float | None = None) -> Column:
        heat = self.temperature if temperature is None else temperature
        logits = [e * heat + math.log(s) for e, s in zip(evidence, self.shares, strict=True)]
        top = F.greatest(*logits) if len(logits) > 1 else logits[0]
        raw = F.transform(F.array(*logits), lambda x: F.exp(x - top))
        total = F.aggregate(raw, F.lit(0.0), lambda a, x: a + x)
        return F.transform(raw, lambda x: x / total)

    def evidence(self, own: Column) -> list[Column]:
        """The sums of the words' weights, by domain; ``own`` holds the words' buckets."""

        def total(weights: list[float]) -> Column:
            return F.aggregate(own, F.lit(0.0), lambda a, b: a + F.get(table(weights, "double"), b))

        return [F.lit(0.0), *[total(w) for w in self.weights[1:]]]


def _sample(documents: DataFrame, labelled: DataFrame, per_domain: int, doc_id: str, text: str) -> DataFrame:
    """Texts of up to ``per_domain`` documents of each domain, by the smallest hash of their id.

    ``labelled`` holds domains of a given list and one for the others only, so their counts are a few numbers."""
    known = labelled.where("id IS NOT NULL AND domain IS NOT NULL").groupBy("id").agg(F.min("domain").alias("domain"))
    near = F.lit(False)
    for r in known.groupBy("domain").agg(F.count("*").alias("n")).collect():
        near = near | ((F.col("domain") == r["domain"]) & among_smallest(F.xxhash64("id"), per_domain, r["n"]))
    order = Window.partitionBy("domain").orderBy(F.xxhash64("id"), "id")
    ids = known.where(near).withColumn("place", F.row_number().over(order)).where(F.col("place") <= per_domain)
    found = documents.select(col(doc_id).alias("id"), col(text).alias("text")).join(F.broadcast(ids), "id")
    return found.groupBy("id", "domain", "place").agg(F.min("text").alias("text"))


def classifier(
    documents: DataFrame,
    labelled: DataFrame,
    domains: list[str],
    *,
    per_domain: int = PER_DOMAIN,
    doc_id: str = "doc_id",
    text: str = "text",
) -> Classifier | None:
    """Learns from ``labelled`` (``id``, ``domain``). Odd places of the sample make the counts, even ones the
    temperature. Domains that aren't asked for are one, the last. None without labelled documents."""
    other = OTHER
    while other in domains:
        other += "_"
    named = F.when(F.col("domain").isin(domains), F.col("domain")).otherwise(other)
    wanted = labelled.where("domain IS NOT NULL").withColumn("domain", named)
    domains = [*domains, other]
    sample = settled(_sample(documents, wanted, 2 * per_domain, doc_id, text))
    totals = {r["domain"]: r["n"] for r in wanted.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    learnt = sample.where("place % 2 = 1").select("domain", F.explode(words(F.col("text"))).alias("word"))
    counts = learnt.groupBy("domain", _bucket(F.col("word")).alias("bucket")).agg(F.count("*").alias("n"))
    by_domain: dict[str, dict[int, int]] = {}
    for r in counts.collect():
        by_domain.setdefault(r["domain"], {})[r["bucket"]] = r["n"]
    present = [d for d in domains if d in by_domain]
    if not present:
        return None
    logs = []
    for d in present:
        all_words = sum(by_domain[d].values()) + SMOOTHING * BUCKETS
        logs.append([math.log((by_domain[d].get(b, 0) + SMOOTHING) / all_words) for b in range(BUCKETS)])
    weights = [[x - y for x, y in zip(own, logs[0], strict=True)] for own in logs]
    shares = [totals[d] / sum(totals[d] for d in present) for d in present]
    model = Classifier(present, shares, weights, 1.0)
    judged = sample.where("place % 2 = 0").where(F.col("domain").isin(present))
    evidence = _with_evidence(judged, model, "text")
    own = F.array_position(F.lit(present), F.col("domain")).cast("int")
    sums = [f"e{i}" for i in range(len(present))]
    losses = [
        F.avg(-F.log(F.greatest(F.element_at(model.posteriors([F.col(s) for s in sums], h), own), F.lit(1e-12)))).alias(f"h{i}")
        for i, h in enumerate(TEMPERATURES)
    ]
    # Each domain weighs by its share, not by its part of the sample.
    by = evidence.groupBy("domain").agg(*losses).collect()
    if by:
        weight = dict(zip(present, shares, strict=True))
        loss = [sum(weight[r["domain"]] * r[f"h{i}"] for r in by) for i in range(len(TEMPERATURES))]
        model = Classifier(present, shares, weights, TEMPERATURES[loss.index(min(loss))])
    return model


def _with_evidence(frame: DataFrame, model: Classifier, text: str) -> DataFrame:
    buckets = frame.withColumn("own_buckets", F.transform(words(F.col(text)), _bucket))
    sums = model.evidence(F.col("own_buckets"))
    named = {f"e{i}": e for i, e in enumerate(sums)}
    return buckets.withColumns(named | {"tokens": F.size("own_buckets").cast("long")}).drop("own_buckets")


def _replayed(steps: list[list[float]], posteriors: Column) -> Column:
    """A document's rate after the steps, each projected to rates of at least 0."""
    if not steps:
        return F.lit(1.0)
    moved = lambda rate, step: F.greatest(
        F.lit(0.0), rate - F.aggregate(F.zip_with(posteriors, step, lambda p, s: p * s), F.lit(0.0), lambda a, x: a + x)
    )
    rows = F.array(*[table(step, "double") for step in steps])
    return F.aggregate(rows, F.lit(1.0), moved)


def _largest_eigenvalue(matrix: list[list[float]]) -> float:
    """Of a symmetric matrix without negative entries, by power iteration from above."""
    v, size = [1.0] * len(matrix), 1.0
    for _ in range(100):
        w = [sum(a * b for a, b in zip(row, v, strict=True)) for row in matrix]
        size = max(w)
        v = [x / size for x in w]
    return size


@dataclass(frozen=True)
class Plan:
    domains: list[str]
    targets: list[float]
    totals: list[float]  # expected tokens by domain at the fitted rates
    steps: list[list[float]]

    @property
    def miss(self) -> float:
        """The farthest that a domain is from its target, as a part of all targets."""
        return max((abs(a - b) for a, b in zip(self.targets, self.totals, strict=True)), default=0.0) / (sum(self.targets) or 1.0)


def fitted(memberships: DataFrame, domains: list[str], weights: dict[str, float]) -> Plan:
    """The steps of projected gradient descent for ``memberships`` (``tokens``, ``posteriors``).

    A domain without a weight is to keep its tokens; the targets of the others are the weights' parts of
    all other tokens.
    """
    n = len(domains)
    p = [F.get("posteriors", F.lit(i)) for i in range(n)]
    moments = memberships.agg(
        F.sum("tokens").cast("double").alias("all"),
        *[F.sum(F.col("tokens") * p[i] * p[j]).alias(f"m{i}_{j}") for i in range(n) for j in range(i, n)],
        *[F.sum(F.col("tokens") * p[i]).alias(f"t{i}") for i in range(n)],
    ).first()
    mass = [moments[f"t{i}"] or 0.0 for i in range(n)]
    live = [i for i in range(n) if mass[i] > 0 and weights.get(domains[i], 0) >= 0]
    asked = sum(weights.get(domains[i], 0) for i in live)
    if not moments["all"] or not asked:
        return Plan(domains, mass, mass, [])
    free = moments["all"] - sum(mass[i] for i in live if domains[i] not in weights)
    targets = [mass[i] if domains[i] not in weights else free * weights[domains[i]] / asked if i in live else 0.0 for i in range(n)]
    scaled = [
        [moments[f"m{min(i, j)}_{max(i, j)}"] / math.sqrt(mass[i] * mass[j]) if i in live and j in live else 0.0 for j in range(n)]
        for i in range(n)
    ]
    size = 1 / _largest_eigenvalue(scaled)
    steps: list[list[float]] = []
    totals = mass
    for _ in range(STEPS):
        miss = [(totals[i] - targets[i]) / mass[i] if i in live else 0.0 for i in range(n)]
        if max(abs(totals[i] - targets[i]) for i in live) <= PRECISION * moments["all"]:
            break
        steps.append([size * x for x in miss])
        rate = F.col("tokens") * _replayed(steps, F.col("posteriors"))
        row = memberships.agg(*[F.sum(rate * p[i]).alias(f"t{i}") for i in range(n)]).first()
        totals = [row[f"t{i}"] or 0.0 for i in range(n)]
    plan = Plan(domains, targets, totals, steps)
    if plan.miss > PRECISION:
        warnings.warn(f"after {STEPS} steps a domain misses its target by {plan.miss:.2%} of all tokens", stacklevel=2)
    return plan


def rated(
    documents: DataFrame,
    labelled: DataFrame,
    weights: dict[str, float],
    *,
    per_domain: int = PER_DOMAIN,
    doc_id: str = "doc_id",
    text: str = "text",
) -> tuple[DataFrame, Plan]:
    """``doc_id``, ``tokens``, ``posteriors`` (in the order of the plan's domains), ``draw`` and ``rate`` for each
    row, and the plan."""
    if any(w < 0 for w in weights.values()):
        raise ValueError("target weights can't be negative")
    model = classifier(documents, labelled, list(weights), per_domain=per_domain, doc_id=doc_id, text=text)
    narrow = documents.select(
        col(doc_id).alias("doc_id"), col(text).alias("text"), drawn(col(doc_id), col(text)).alias("draw")
    )
    if model is None:
        tokens = F.size(words(F.col("text"))).cast("long").alias("tokens")
        empty = F.array().cast("array<double>").alias("posteriors")
        return narrow.select("doc_id", tokens, empty, "draw", F.lit(1.0).alias("rate")), Plan([], [], [], [])
    found = _with_evidence(narrow, model, "text")
    posteriors = model.posteriors([F.col(f"e{i}") for i in range(len(model.domains))])
    members = settled(found.select("doc_id", "tokens", posteriors.alias("posteriors"), "draw"))
    plan = fitted(members, model.domains, weights)
    return members.withColumn("rate", _replayed(plan.steps, F.col("posteriors"))), plan


def mixed(
    documents: DataFrame,
    labelled: DataFrame,
    weights: dict[str, float],
    *,
    per_domain: int = PER_DOMAIN,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The documents, each as often as its rate says (see ``copies``), with their own columns."""
    model = classifier(documents, labelled, list(weights), per_domain=per_domain, doc_id=doc_id, text=text)
    if model is None:
        return documents
    held = documents.select(
        F.struct(*[col(c) for c in documents.columns]).alias("row"),
        col(text).alias("text"),
        drawn(col(doc_id), col(text)).alias("draw"),
    )
    found = _with_evidence(held, model, "text")
    posteriors = model.posteriors([F.col(f"e{i}") for i in range(len(model.domains))])
    # Posteriors are stored with the rows: inlined into the rate they would be made again in each step.
    whole = settled(found.select("row", "tokens", posteriors.alias("posteriors"), "draw"))
    plan = fitted(settled(whole.select("tokens", "posteriors")), model.domains, weights)
    rate = _replayed(plan.steps, F.col("posteriors"))
    each = whole.withColumn("times", copies(rate, F.col("draw")))
    again = F.explode(F.sequence(F.lit(1), F.col("times")))
    return each.where("times > 0").select("row", again.alias("copy")).select("row.*")


def drawn(doc_id: Column, text: Column) -> Column:
    """A number from 0 to 1 for each row: a hash of its id, its text and its place, so repeated rows draw their own."""
    place = F.monotonically_increasing_id()
    return F.pmod(F.xxhash64(F.lit("mixing"), doc_id, text, place), F.lit(1 << 30)) / (1 << 30)


def copies(rate: Column, draw: Column) -> Column:
    """How often a document is taken: the whole part of its rate, and once more with the rest as its
    chance, if its draw is below it."""
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("int")).cast("int")


def language_labels(documents: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id") -> DataFrame:
    """``id`` and ``domain`` (the language) of the documents in the table of labels. Held-out ids aren't
    used."""
    known = labels.select(col(doc_id).alias("id")).where(~held_out(F.col("id"))).distinct()
    return documents.select(col(doc_id).alias("id"), F.col("lang").alias("domain")).join(known, "id")
