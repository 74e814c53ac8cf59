"""Classifiers, mixing and the pipeline on the smallest given tables and on odd rows."""

import numpy as np
import pytest

from pyspark.sql import functions as F
from veritide.llm import common, mixing, quality, toxicity
from veritide.llm import queries as corpus

SF_DIR = "/root/testdata/sf0.01"
ODD = "doc_id long, text string, lang string, source string, n_chars long, SCORE string, predicted string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (1, None, None, None, None, "a", "b"),
        (2, "", "en", "s", 0, None, None),
        (None, "the the the", "en", "s", -5, "a", "b"),
        (4, "word " * 60000, "en", None, 300000, "a", "b"),
        (4, "word " * 60000, "en", None, 300000, "a", "b"),
    ]
    return spark.createDataFrame(rows, ODD)


@pytest.mark.parametrize("name", ["op1_quality_classifier", "op8_toxic_passages"])
def test_held_out_accuracy(spark, name):
    label = "quality" if name.startswith("op1") else "toxic"
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    found = corpus.queries()[name](spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").toPandas()
    assert (found["predicted"] == found[label]).mean() > 0.95
    assert found["score"].between(0, 1).all()


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows_and_missing_labels(spark, odd, module):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = module.fit(odd, labels)
    found = module.scored_documents(odd, model).collect()
    assert len(found) == 5
    assert all(abs(r["score"] - 0.5) < 1e-6 for r in found)
    assert module.scored_documents(odd.limit(0), model).count() == 0


def test_linear_time_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    model = quality.Model(0.3, rng.normal(size=9), rng.normal(size=(9, 4)))
    ix, x = np.array([0, 3, 4, 8]), rng.normal(size=4)
    pairs = sum(
        model.factors[ix[a]] @ model.factors[ix[b]] * x[a] * x[b] for a in range(4) for b in range(a + 1, 4)
    )
    expected = 0.3 + model.linear[ix] @ x + pairs
    assert np.isclose(model.raw(np.array([0, 4]), ix, x)[0], expected)


def _by_brute_force(scores):
    """Maximal segments by their definition: the best one, then those left and right of it."""
    total = np.concatenate([[0], np.cumsum(scores)])
    best = max(
        ((total[j] - total[i], i - j, -i, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)),
        default=(0,),
    )
    if best[0] <= 0:
        return []
    i, j = best[3], best[4]
    left = [(a, b, s) for a, b, s in _by_brute_force(scores[:i])]
    return left + [(i, j, best[0])] + [(a + j, b + j, s) for a, b, s in _by_brute_force(scores[j:])]


def test_segments_match_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(300):
        scores = rng.normal(-0.3, 1.5, rng.integers(0, 14))
        found = toxicity.maximal_segments(scores)
        expected = _by_brute_force(scores)
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in expected]
        assert np.allclose([s for *_, s in found], [s for *_, s in expected])


def test_rates_meet_the_targets(spark):
    members = spark.createDataFrame(
        [(100, [0.9, 0.1]), (300, [0.2, 0.8]), (0, [0.5, 0.5]), (50, [1.0, 0.0])], "tokens long, posteriors array<double>"
    )
    plan = mixing.fitted(members, ["a", "b"], {"a": 0.6, "b": 0.4})
    assert np.allclose(plan.totals, plan.targets, atol=0.001 * 450)
    rates = [r[0] for r in members.select(mixing._replayed(plan.steps, members["posteriors"])).collect()]
    assert min(rates) >= 0
    far = mixing.fitted(members, ["a", "b"], {"a": 1.0, "b": 0.0})
    rates = [r[0] for r in members.select(mixing._replayed(far.steps, members["posteriors"])).collect()]
    assert rates[1] < rates[0] and min(rates) >= 0


def test_mixing_leaves_other_domains_their_tokens(spark):
    # Words a0 to a9, b0 to b9 and z0 to z9; every second document of "z" has no language.
    docs = spark.range(800).selectExpr(
        "id AS doc_id", "CASE WHEN id % 4 = 0 THEN 'a' WHEN id % 4 = 1 THEN 'b' ELSE 'z' END AS kind",
        "IF(id % 4 = 3, NULL, CASE WHEN id % 4 = 0 THEN 'a' WHEN id % 4 = 1 THEN 'b' ELSE 'z' END) AS lang",
    ).selectExpr("doc_id", "kind", "lang", "array_join(transform(sequence(1, 20), i -> concat(kind, pmod(hash(doc_id, i), 10))), ' ') AS text")
    labelled = docs.selectExpr("doc_id AS id", "lang AS domain")
    found, plan = mixing.rated(docs, labelled, {"a": 0.7, "b": 0.3})
    assert plan.domains == ["a", "b", "other"]
    assert np.allclose(plan.totals, plan.targets, atol=0.001 * 16000)
    rates = found.join(docs, "doc_id").groupBy("kind").agg(F.min("rate"), F.max("rate")).collect()
    assert {k: (round(a, 1), round(b, 1)) for k, a, b in rates} == {"a": (1.4, 1.4), "b": (0.6, 0.6), "z": (1.0, 1.0)}
    kept = mixing.mixed(docs, labelled, {"a": 0.7, "b": 0.3}).groupBy("kind").count().collect()
    assert abs(dict(kept)["z"] - 400) < 20 and abs(dict(kept)["a"] - 280) < 30
    _, same = mixing.rated(docs, labelled.where("domain < 'z'"), {"a": 0.7, "b": 0.3})
    assert same.domains == ["a", "b"]


def test_mixing_of_odd_rows(spark, odd):
    labelled = spark.createDataFrame([(2, "en")], "id long, domain string")
    found, plan = mixing.rated(odd, labelled, {"en": 0.5, "de": 0.5})
    assert found.count() == 5
    assert mixing.mixed(odd, labelled.limit(0), {"en": 1.0}).count() == 5
    assert mixing.mixed(odd.limit(0), labelled, {"en": 1.0}).count() == 0


def test_pipeline_keeps_what_its_stages_decide(spark):
    import corpus_pipeline
    from corpus_pipeline import STAGES

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    assert [name for name, _ in STAGES] == ["quality", "toxicity", "near_duplicates", "mixing", "token_ids"]
    kept = STAGES[0][1](spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    good = labels.where("quality = 1").join(docs.select("doc_id"), "doc_id").count()
    assert kept.join(labels.where("quality = 1"), "doc_id").count() >= 0.95 * good
    groups = corpus.op2_simhash_near_dedup(spark, SF_DIR).toPandas()
    single = STAGES[2][1](spark, docs, SF_DIR)
    assert sorted(r.doc_id for r in single.select("doc_id").collect()) == sorted(set(groups["component_id"]))
    last = corpus_pipeline.run(spark, SF_DIR)
    assert last.where("NOT same_text").count() == 0 and last.count() > 500


def test_hash_bound_keeps_the_smallest(spark):
    ids = spark.range(20_000).selectExpr("id", "xxhash64(id) AS hashed")
    near = ids.where(common.among_smallest(F.col("hashed"), 1000, 20_000))
    assert 2000 < near.count() < 2500
    first = lambda frame: [r.id for r in frame.orderBy("hashed", "id").limit(1000).collect()]
    assert first(near) == first(ids)
    assert ids.where(common.among_smallest(F.col("hashed"), 1000, 2250)).count() == 20_000


def test_mixing_sample_is_that_of_the_whole_table(spark):
    docs = spark.range(9000).selectExpr("id AS doc_id", "concat('w', id) AS text")
    labelled = docs.selectExpr("doc_id AS id", "if(doc_id % 9 = 0, 'b', 'a') AS domain")
    found = {(r.domain, r.id) for r in mixing._sample(docs, labelled, 200, "doc_id", "text").collect()}
    ranked = labelled.selectExpr("*", "row_number() OVER (PARTITION BY domain ORDER BY xxhash64(id), id) AS n")
    assert found == {(r.domain, r.id) for r in ranked.where("n <= 200").collect()}


def test_repeated_ids_draw_for_each_row(spark):
    labelled = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(2, 60)], "id long, domain string")
    known = [(i, "apple ant arrow" if i % 2 else "bee bear bread", "x") for i in range(2, 60)]
    docs = spark.createDataFrame(known + [(None, "apple ant arrow", "x")] * 2000, "doc_id long, text string, draw string")
    kept = mixing.mixed(docs.repartition(3), labelled, {"a": 0.2, "b": 0.8})
    found, plan = mixing.rated(docs, labelled, {"a": 0.2, "b": 0.8})
    rate = found.where("doc_id IS NULL").first()["rate"]
    assert 0.001 < rate < 0.9 and kept.columns == docs.columns
    n = kept.where("doc_id IS NULL").count()
    assert abs(n - 2000 * rate) < 6 * np.sqrt(2000 * rate * (1 - rate)) + 1


def test_stages_keep_columns_named_like_their_results(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    docs = docs.selectExpr("*", "'own' AS score", "'mine' AS passages", "'x' AS predicted", "'y' AS tokens", "7 AS draw")
    for name, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns, name
        rows = kept.select("score", "passages", "predicted", "tokens", "draw").distinct().collect()
        assert [tuple(r) for r in rows] == [("own", "mine", "x", "y", 7)], name
