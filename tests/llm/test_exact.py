"""Operators with one right answer, against brute force, libraries and round trips."""

import itertools
import random
import re
import sys
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from veritide.llm import bpe, chat, graph_ann, hamming, kd_shards, rans, simhash
from veritide.llm import queries as corpus
from veritide.llm.common import setting
from veritide.llm.components import components, with_least
from veritide.llm.vocabulary import Spec

SF_DIR = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string"
ODD = [
    (1, None, None, None, None, "x", "y"), (2, "", "en", "a", 0, None, None), (3, " \n\t", "en", "a", 3, "x", "y"),
    (None, "a b c d", "en", None, 7, "x", "y"), (5, "A b  C d", None, "a", 7, "x", "y"),
    (5, "A b  C d", None, "a", 7, "x", "y"), (6, "word " * 50000, "en", "a", 250000, "x", "y"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def texts():
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()
    return dict(rows)


def _print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def _roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash_matches_brute_force(spark, texts):
    prints = {i: _print(t) for i, t in texts.items()}
    ids = sorted(prints)
    codes = np.array([prints[i] for i in ids], np.uint64)
    near = [(ids[k], ids[j]) for k in range(len(ids)) for j in np.flatnonzero(np.bitwise_count(codes ^ codes[k]) <= 3)]
    roots = _roots(ids, near)
    found = corpus.op2_simhash_near_dedup(spark, SF_DIR).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == {i: (f"{prints[i]:016x}", roots[i]) for i in ids}


@pytest.mark.parametrize("distance", range(4))
def test_links_connect_what_is_near(spark, distance):
    rng = random.Random(distance)
    codes = {rng.getrandbits(64) for _ in range(60)} | {0, 2**64 - 1}
    for c in list(codes):
        for n in (1, 2, 3, 4):
            codes.add(c ^ sum(1 << i for i in rng.sample(range(64), n)))
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    frame = spark.createDataFrame([(c,) for c in signed], "print long")
    apart = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1")
    expected = _roots(signed, [p for p in itertools.combinations(signed, 2) if apart(*p) <= distance])
    found = [(r["hub"], r["print"]) for r in simhash.links(frame, distance).collect()]
    assert all(apart(*p) <= distance for p in found)
    assert _roots(signed, found) == expected


@pytest.mark.parametrize("distance", [1, 2, 3])
@pytest.mark.parametrize("shift", [0, 32])
def test_links_of_a_crowded_half(spark, distance, shift, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", 30)
    rng = random.Random(distance + shift)
    shared = rng.getrandbits(32) << (32 - shift)
    codes = {shared | rng.getrandbits(32) << shift for _ in range(100)}
    for c in list(codes):
        for n in (1, 2, 3, 4):
            codes.add(c ^ sum(1 << i for i in rng.sample(range(64), n)))
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    apart = lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1")
    expected = _roots(signed, [p for p in itertools.combinations(signed, 2) if apart(*p) <= distance])
    frame = spark.createDataFrame([(c,) for c in signed], "print long")
    found = [(r["hub"], r["print"]) for r in simhash.links(frame, distance).collect()]
    assert _roots(signed, found) == expected and all(apart(*p) <= distance for p in found)


def test_a_crowded_half_is_spread_over_the_tasks(spark):
    prints = spark.range(20_000).select((F.col("id") * 7919 + (5 << 40)).alias("print"))
    high = range(32, 64)
    crowded = simhash._crowded(prints, high)
    assert crowded.count() == 33 and {5 << 8, 5 << 8 ^ 1} < {r["half"] for r in crowded.collect()}
    masks = F.lit([0, *(1 << i for i in range(32))])
    met = simhash._met_at(prints.withColumn("code", F.col("print")), masks, high, crowded)
    sizes = [r["n"] for r in met.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 33 * 20_000 and max(sizes) < 1.2 * sum(sizes) / len(sizes) and len(sizes) == 4


def test_edges_of_a_hub_meet_in_parts(spark):
    edges = spark.range(1, 3001).selectExpr("0L AS a", "id AS b").unionAll(spark.range(5000, 5100).selectExpr("id AS a", "id + 1 AS b"))
    found = {(r["node"], r["root"]) for r in components(edges, "a", "b").collect()}
    assert found == {(i, 0) for i in range(1, 3001)} | {(i, 5000) for i in range(5001, 5101)}
    least = with_least(edges, "a", "b", "b", "m")
    assert least.where("m <> CASE WHEN a = 0 THEN 1 ELSE b END").count() == 0 and least.count() == 3100
    plan = least._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(a" in plan and plan.count("__part") > 4


def test_simhash_of_odd_rows(spark, odd):
    found = simhash.grouped(odd).collect()
    assert len(found) == 7
    by_id = {r.doc_id: r.component_id for r in found}
    assert by_id[1] == by_id[2] == by_id[3] == 1 and by_id[None] == 5
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect()) == [1, 5, 6]
    nameless = odd.where("doc_id IS NULL")
    assert simhash.one_of_each(nameless.unionAll(nameless)).count() == 1
    assert simhash.grouped(odd.limit(0)).count() == 0


def test_one_of_each_component_where_ids_repeat(spark):
    a, b, c, d = ("one two three four five", "red green blue black white", "north east south west", "salt sugar flour milk")
    near = a.upper()  # the same fingerprint, another text
    rows = [(0, a), (0, b), (0, c), (7, c), (3, near), (None, d), (None, d), (None, near), (None, "x y z"), (0, b), (9, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string").repartition(5)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in kept.where("doc_id < 9 OR doc_id IS NULL").collect()), key=str)
    assert found == sorted([(0, a), (0, b), (0, c), (None, d), (None, "x y z")], key=str)
    assert kept.where("doc_id = 9").count() == 1
    wrong = spark.createDataFrame([(3, near, "en"), (5, a, "en"), (5, b, "en")], docs.schema)
    assert {(r.doc_id, r.text) for r in simhash.one_of_each(wrong).collect()} == {(3, near), (5, b)}
    hot = spark.range(400).selectExpr("0L AS doc_id", "concat_ws(' ', sha(string(id)), md5(string(id)), id, id + 1) AS text")
    groups = simhash.grouped(hot).select("component_print").distinct().count()
    assert simhash.one_of_each(hot.unionAll(hot)).count() == groups > 300


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(5, 5), (None, 3)], "a long, b long")
    found = {(r.node, r.root) for r in components(edges, "a", "b").collect()}
    assert found == {(i, 0) for i in range(1, 61)}


def test_shards_are_even_and_slots_have_no_gaps(spark, texts):
    found = corpus.op3_kd_sharding(spark, "/root/testdata/sf0.1").toPandas()
    sizes = found.groupby("shard")["size"].sum()
    largest = found["size"].max()
    assert list(sizes.index) == list(range(40)) and sizes.max() - sizes.min() < 3 * largest
    for _, slots in found.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))
    some = found[found["doc_id"].isin([0, 1])].set_index("doc_id")
    first = duckdb.sql("SELECT text FROM '/root/testdata/sf0.1/documents.parquet' WHERE doc_id = 1").fetchall()[0][0]
    assert some.loc[1, "size"] == len(first.encode()) + 16
    assert some.loc[1, "text_crc32"] == zlib.crc32(first.encode())


def test_sharding_cuts_copies_and_odd_rows(spark, odd):
    found = kd_shards.sharded(odd, 3).toPandas()
    assert len(found) == 7 and found["shard"].between(0, 2).all()
    copies = spark.range(4000).selectExpr("1L AS doc_id", "'same' AS text", "'en' AS lang", "'a' AS source", "4L AS n_chars")
    sizes = kd_shards.sharded(copies, 8).groupBy("shard").count().toPandas()["count"]
    assert len(sizes) == 8 and sizes.max() - sizes.min() < 20
    assert kd_shards.sharded(odd.limit(0), 3).count() == 0


@pytest.mark.parametrize("shards,hot", [(40, 3), (8, 1)])
def test_sharding_cuts_long_equal_rows(spark, shards, hot):
    ids = spark.range(4000, numPartitions=5)
    same = F.col("id") % hot == 0
    docs = ids.select(
        F.when(~same, F.col("id")).alias("doc_id"),
        F.when(same, F.repeat(F.lit("a"), 5000)).otherwise(F.repeat(F.lit("bc"), (F.col("id") % 4000).cast("int"))).alias("text"),
        F.lit("en").alias("lang"),
        F.when(same, "s").otherwise(F.concat(F.lit("t"), F.col("id") % 7)).alias("source"),
        F.when(same, 5000).otherwise(F.col("id") % 4000 * 2).alias("n_chars"),
    )
    found = kd_shards.sharded(docs, shards).groupBy("shard").agg(F.sum("size").alias("size"), F.count("*").alias("n")).toPandas()
    assert len(found) == shards and found["n"].sum() == 4000
    assert found["size"].max() - found["size"].min() < 3 * 8016


def test_graph_search_recall_and_order(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 24)) * rng.uniform(0.5, 2, (3000, 1))
    x[2000:2400] = x[2000]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(4000, None), (4001, [0.0] * 24), (4002, [float("nan")] * 24), (4003, [1.0, None]), (None, [1.0] * 24)]
    vectors = spark.createDataFrame(rows, "id long, vector array<double>")
    before, graph_ann.SHARD_ROWS = graph_ann.SHARD_ROWS, 1000
    found = graph_ann.nearest(vectors, vectors.where("id % 20 = 0"), 10).toPandas()
    graph_ann.SHARD_ROWS = before
    assert (found.groupby("query_id").size() == 10).all() and found["query_id"].nunique() == 150
    hits = 0
    for q, part in found.groupby("query_id"):
        part = part.sort_values("rank")
        scores = x @ x[q]
        assert np.allclose(part["score"], scores[part["id"].to_numpy()], atol=1e-12) and q not in set(part["id"])
        order = [i for i in np.lexsort((np.arange(3000), -scores)) if i != q][:10]
        hits += len(set(order) & set(part["id"]))
        assert list(zip(-part["score"], part["id"])) == sorted(zip(-part["score"], part["id"]))
    assert hits >= 0.95 * 1500
    empty = vectors.limit(0)
    assert graph_ann.nearest(empty, empty, 10).count() == 0


def test_rows_of_one_id_are_rows_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(graph_ann, "SHARD_ROWS", 50)
    rng = np.random.default_rng(9)
    x = rng.normal(size=(160, 6))
    x[40:44] = x[40]
    ids = [i // 2 for i in range(160)]
    ids[40:44] = [20] * 4
    rows = list(zip(ids, x.tolist())) + [(500, [-0.0, 1.0, 0.0, 0.0, 0.0, 0.0])] * 30 + [(501, [0.0, 1.0, 0.0, 0.0, 0.0, 0.0])]
    vectors = spark.createDataFrame(rows, "id long, vector array<double>").repartition(3)
    found = graph_ann.nearest(vectors, vectors.where("id % 20 = 0"), 7).toPandas()
    expected = []
    for n, (own, v) in enumerate(rows):
        if own % 20 == 0:
            scores = sorted((-float(np.dot(u, v)), i) for m, (i, u) in enumerate(rows) if m != n)[:7]
            expected += [(own, r, i, round(-s, 9)) for r, (s, i) in enumerate(scores, 1)]
    got = sorted((r.query_id, r["rank"], r["id"], round(r.score, 9)) for _, r in found.iterrows())
    assert got == sorted(expected)


@pytest.mark.parametrize("rows,size", [(12_000, 64), (50_000, 16)])
def test_recall_on_vectors_of_free_length(spark, rows, size):
    x = np.random.default_rng(11).normal(size=(rows, size)) * np.random.default_rng(12).uniform(0.2, 3, (rows, 1))
    data = [(i, v) for i, v in enumerate(x.tolist())]
    vectors = spark.createDataFrame(data, "id long, vector array<double>").repartition(4)
    found = graph_ann.nearest(vectors, vectors.where(f"id % {rows // 150} = 0"), 20).toPandas()
    hits = total = 0
    for q, part in found.groupby("query_id"):
        scores = x @ x[q]
        scores[q] = -np.inf
        hits += (part["score"] >= np.sort(scores)[-20] - 1e-9).sum()
        total += 20
    assert total >= 150 * 20 and hits >= 0.9 * total


def test_sign_codes_take_every_component(spark):
    rng = np.random.default_rng(13)
    same = rng.normal(size=64)
    rows = [(64, same.tolist()), *((n, [*same.tolist(), *(rng.normal(size=n - 64) * 9).tolist()]) for n in (128, 129))]
    rows += [(32, same[:32].tolist()), (1, [2.0]), (0, []), (2, [1.0, None]), (3, [float("inf")]), (4, None)]
    frame = spark.createDataFrame(rows, "id long, v array<double>")
    code = {r.id: r.code for r in frame.select("id", hamming.sign_code(F.col("v")).alias("code")).collect()}
    plain = sum(1 << i for i in range(64) if same[i] > 0)
    assert code[64] % (1 << 64) == plain and code[32] % (1 << 64) == plain % (1 << 32) and code[1] == 1
    assert len({code[64], code[128], code[129]}) == 3 and [code[i] for i in (0, 2, 3, 4)] == [None] * 4


def test_encoders_match_the_library():
    library = Tokenizer.from_file(PATH)
    spec = Spec.read(PATH)
    encoder, decoder, other = bpe.Encoder(spec), bpe.Decoder(spec), rans.Library(spec)
    rng = random.Random(2)
    letters = [*" \n\t\r\x0b\x1c\x85\xa0　sdtlmvre'.,!?123abcé字\U0001f642́٣|<>", "<|endoftext|>", "  ", "'s"]
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 24)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.packed(text), "<u4").tolist() == ids, repr(text)
        assert np.frombuffer(other.packed(text), "<u4").tolist() == ids, repr(text)
        assert decoder.text(encoder.packed(text)) == library.decode(ids, skip_special_tokens=False)


def test_long_texts_match_the_library(monkeypatch):
    monkeypatch.setattr(rans, "CHUNKS_KEPT", 5000)
    library, other, rng = Tokenizer.from_file(PATH), rans.Library(Spec.read(PATH)), random.Random(4)
    words = ["the", "of", "naïve", "字字", "x" * 300, "", "\n", "a\n", "<|endoftext|>", "it's", "12", "\u3000", "Ġ", "\x1cq", "b.\nC", "q\n字\nd,", "a\n<|endoftext|>\nb"]
    for _ in range(300):
        some = words[:4] if rng.random() < 0.3 else words
        text = " ".join(rng.choice(some) for _ in range(rng.randint(0, 40)))
        assert np.frombuffer(other.packed(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("known", [True, False])
def test_texts_encoded_together_match_the_library(monkeypatch, known):
    monkeypatch.setattr(rans, "WORDS", 3)
    monkeypatch.setattr(rans, "GROUP", 7)
    library, other, rng = Tokenizer.from_file(PATH), rans.Library(Spec.read(PATH)), random.Random(8)
    if not known:  # as if no id started with a space
        other.starts = np.zeros_like(other.starts)
    letters = [*" \n\t\r\x0b\x1c\x85\xa0\u1680\u2003\u2028\u202f\u205f\u3000sdtlmvre'.,!?123abcé字\U0001f642²½Ⅷʰ|<>Ġÿ\x00", "<|endoftext|>", "  ", "'s"]
    words = ["the", "naïve", "字字", "x" * 300, "", "\n", "a\n", "it's", "12", "\u3000", "\x1cq", "b.\nC", "a\n<|endoftext|>\nb", "$$$", "of,###"]
    texts = [None, "", " ", "  ", "\n", "a ", " a", "<|endoftext|>", " <|endoftext|> "]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 24))) for _ in range(1500)]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    for some in (texts, texts[:1], [" ", "  b"], ["plain words"]):
        expected = [library.encode(t or "", add_special_tokens=False).ids for t in some]
        assert [x.tolist() for x in other.all_packed(pa.array(some, pa.string()))] == expected
    assert [x.tolist() for x in other.all_packed(pa.array(texts, pa.string()).slice(3, 9))] == [
        library.encode(t, add_special_tokens=False).ids for t in texts[3:12]
    ]


def test_a_word_of_many_texts_is_encoded_once():
    other, given = rans.Library(Spec.read(PATH)), []

    class Noted:
        def __init__(self, whole):
            self.whole = whole

        def encode_batch_fast(self, inputs, **options):
            given.extend(w for i in inputs for w in i.split())
            return self.whole.encode_batch_fast(inputs, **options)

    other.words, other.model = Noted(other.words), None  # pieces don't go to the model one by one
    made = other.all_packed(pa.array([f"x{i} the naïve word of word{chr(97 + i % 26)}" for i in range(500)]))
    assert len(made) == 500 and len(given) == len(set(given)) == 30


def test_texts_are_taken_in_slices_of_bounded_bytes(monkeypatch):
    monkeypatch.setattr(rans, "SLICE", 10)
    texts = ["a" * 4, None, "b" * 6, "c" * 25, "", "d" * 9, "éé", "e"]
    batch = pa.record_batch([pa.array(texts)], names=["text"])
    slices = [s.column("text").to_pylist() for s in rans._slices(iter([batch, batch.slice(0, 0)]))]
    assert [t for s in slices for t in s] == texts
    assert all(len(s) == 1 or sum(len((t or "").encode()) for t in s) <= 10 for s in slices) and len(slices) == 4


def test_decoded_ids_are_not_shuffled(spark, tmp_path):
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    rans.write_tokens(docs, Spec.read(PATH), str(tmp_path / "ids"), ranges=3)
    back = rans.read_tokens(spark, str(tmp_path / "ids"))
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        plan = back._sc._jvm.PythonSQLUtils.explainString(back._jdf.queryExecution(), "simple")
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert [r.doc_id for r in back.orderBy("start").collect()] == list(range(50))


def test_what_encoders_remember_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "CHUNKS_KEPT", 200_000)
    monkeypatch.setattr(bpe, "PIECES_KEPT", 200_000)
    monkeypatch.setattr(rans, "CHUNKS_KEPT", 200_000)
    encoder, other, rng = bpe.Encoder(Spec.read(PATH)), rans.Library(Spec.read(PATH)), random.Random(6)
    texts = [" ".join([rng.choice("ab字") * 30_000, *(str(rng.random()) for _ in range(3000))]) for _ in range(5)]
    for text in texts:
        assert encoder.packed(text) == other.packed(text)
        for kept in (encoder.by_chunk, encoder.by_piece, other.by_chunk):
            held = sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in [*kept.items(), *kept.older.items()])
            assert 0 < held < 420_000


def test_round_trip_keeps_clashing_columns_and_hands_on_slices(spark, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 10)
    docs = spark.createDataFrame([(1, "a b", "x", None), (2, None, "y", 3), (3, "word " * 9000, "", 4)], "doc_id long, text string, ids string, N_TOKENS long")
    spec = Spec.read(PATH)
    made = bpe.round_trip(docs.repartition(1), spec, "ids", "n_tokens", "same_text")
    assert made.columns == ["doc_id", "text", "ids", "N_TOKENS", "ids_", "n_tokens_", "same_text"]
    rows = {r.doc_id: r for r in made.collect()}
    assert [rows[i].ids for i in (1, 2, 3)] == ["x", "y", ""] and all(r.same_text for r in rows.values())
    assert rows[2].n_tokens_ == 0 and rows[3].n_tokens_ * 4 == len(rows[3].ids_)
    plain = docs.select("doc_id", bpe.encoded(F.col("text"), spec).alias("packed"))
    back = plain.select("doc_id", bpe.decoded(F.col("packed"), spec).alias("back")).collect()
    assert {r.doc_id: r.back for r in back} == {1: "a b", 2: "", 3: "word " * 9000}
    assert bpe.digests(docs.limit(0), spec).count() == 0


def test_bpe_query(spark, texts, odd):
    import hashlib

    library = Tokenizer.from_file(PATH)
    for r in corpus.op5_bpe(spark, SF_DIR).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    coded = bpe.round_trip(odd, Spec.read(PATH)).collect()
    assert [r.decoded for r in coded] == [r[1] or "" for r in ODD]


def test_rans_round_trip_and_checksums():
    rng = np.random.default_rng(3)
    for n in (1, 2, 255, 256, 5000, 700_000):
        tokens = [rng.zipf(1.3, n).clip(0, 50000).astype("<u4"), np.zeros(1, "<u4")]
        body = rans.packed([7, None], tokens)
        ids, back = rans.unpacked(body)
        assert ids == [7, None] and all((a == b).all() for a, b in zip(tokens, back, strict=True))
    for place in (5, 400, 4000, len(body) // 2 // 4, len(body) // 8):
        broken = bytearray(body)
        broken[-place] ^= 1
        with pytest.raises(ValueError):
            rans.unpacked(bytes(broken))


def test_one_block_is_decoded_from_its_checkpoint():
    rng = np.random.default_rng(8)
    flat = rng.zipf(1.2, 3 * rans.BLOCK - 7).clip(0, 50000).astype("<u4")
    body = bytearray(rans.packed([1, 2], [flat[:1000], flat[1000:]]))
    segment = rans.Segment.opened(bytes(body))
    assert (segment.block(1) == flat[rans.BLOCK : 2 * rans.BLOCK]).all()
    body[-5] ^= 1  # a word of the last block, which the others don't need
    broken = rans.Segment.opened(bytes(body))
    assert (broken.block(0) == flat[: rans.BLOCK]).all() and (broken.block(1) == segment.block(1)).all()
    with pytest.raises(ValueError):
        broken.block(2)


def test_equal_rows_are_spread_over_the_ranges(spark, tmp_path):
    ids = spark.range(9000, numPartitions=6)
    hot = F.col("id") % 3 == 0
    docs = ids.select(F.when(~hot, F.col("id")).alias("doc_id"), F.when(hot, "same").otherwise(F.col("id").cast("string")).alias("text"))
    rans.write_tokens(docs, Spec.read(PATH), str(tmp_path / "hot"), ranges=12)
    files = spark.read.parquet(str(tmp_path / "hot")).groupBy("part").agg(F.sum("n_docs").alias("n")).collect()
    assert sum(r.n for r in files) == 9000 and max(r.n for r in files) < 2 * 9000 / 12
    back = rans.read_tokens(spark, str(tmp_path / "hot")).orderBy("start").collect()
    assert [r.doc_id for r in back] == [None] * 3000 + [i for i in range(9000) if i % 3]


def test_rans_query(spark, texts, odd, tmp_path):
    library = Tokenizer.from_file(PATH)
    start, expected = 0, {}
    for i in sorted(texts):
        ids = np.array(library.encode(texts[i], add_special_tokens=False).ids + [0], "<u4")
        expected[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    found = corpus.op7_rans_tokens(spark, SF_DIR).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in found} == expected
    rans.write_tokens(odd, Spec.read(PATH), str(tmp_path / "odd"))
    back = rans.read_tokens(spark, str(tmp_path / "odd")).orderBy("start").collect()
    assert [r.doc_id for r in back] == [None, 1, 2, 3, 5, 5, 6] and back[1].n_tokens == 1
    rans.write_tokens(odd.limit(0), Spec.read(PATH), str(tmp_path / "none"))
    assert rans.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_rotation_of_odd_and_crowded_turns(spark):
    rows = [("a", 0, "system", "s"), ("a", 1, None, None), ("a", 70, "Bo", "hi"), ("a", None, "Bo", "bye"), (None, 0, "x", "y"), ("b", 0, "system", "only")]
    found = chat.rotated(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string"))
    got = {(r.conversation, r.assistant, r.part): (r.text, r["mask"]) for r in found.collect()}
    assert set(got) == {("a", "unknown", 0), ("a", "unknown", 1), ("a", "unknown", None), ("a", "Bo", 0), ("a", "Bo", 1), ("a", "Bo", None), (None, "x", 0)}
    assert got["a", "Bo", 0] == ("<|im_start|>system\ns<|im_end|>\n<|im_start|>user name=unknown\n<|im_end|>\n", [0, 0])
    assert got["a", "Bo", 1] == ("<|im_start|>assistant\nhi<|im_end|>\n", [1])
    crowded = spark.range(3000).selectExpr("1 AS conv_id", "id % 2 AS turn", "'u' AS role", "'same' AS text")
    pieces = chat.rotated(crowded).collect()
    assert sum(r.n_turns for r in pieces) == 3000 and max(r.n_turns for r in pieces) < 512
    assert all(r.text[a:b] == "same" for r in pieces for a, b in zip(r.starts, r.stops, strict=True))


def test_rotation_keeps_the_order_of_crowded_parts(spark):
    rng = random.Random(6)
    rows = [(None, rng.randrange(3), rng.choice("xyz"), f"{rng.randrange(10**6)}" * rng.randint(0, 3)) for _ in range(1500)]
    rows += [(None, 1, "x", "same")] * 700 + [("n", None, "u", str(i)) for i in range(600)]
    rows += [("e", i % 64, "u", str(i)) for i in range(256)] + [("a", 1, "u", "hi"), ("a", 70, "v", None)]
    turns = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string")
    with duckdb.connect() as db:
        db.register("conversations", turns.toArrow())
        listed = db.sql(corpus.ROTATION).fetchall()
        whole = db.sql(corpus.ROTATION.replace("// 256", "// 1000000")).fetchall()  # a part in one piece
    numbers = lambda spans: list(map(int, spans.split(",")))
    expected = {tuple(r[:3]): (r[4], r[5], numbers(r[6]), numbers(r[7]), r[8]) for r in whole}
    found = chat.rotated(turns.repartition(7)).collect()
    joined = {}
    for r in sorted(found, key=lambda r: r.piece):
        all_ = joined.setdefault((r.conversation, r.assistant, r.part), [0, "", [], [], [], []])
        at = len(all_[1])
        all_[0] += r.n_turns
        all_[1] += r.text
        all_[2] += [at + a for a in r.starts]
        all_[3] += [at + b for b in r.stops]
        all_[4] += r["mask"]
        all_[5].append((r.piece, r.n_turns))
    written = {k: (n, t, a, b, ",".join(map(str, m))) for k, (n, t, a, b, m, _) in joined.items()}
    assert written == expected
    for n, *_, pieces in joined.values():
        assert pieces == [(i, min(256, n - 256 * i)) for i in range(-(-n // 256))]

    # Piece by piece as well.
    joined = lambda spans: ",".join(map(str, spans))
    rows = [(r.conversation, r.assistant, r.part, r.piece, r.n_turns, r.text, joined(r.starts), joined(r.stops), joined(r["mask"])) for r in found]
    assert sorted(rows, key=repr) == sorted(listed, key=repr)


def test_hamming_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    codes = rng.integers(-(1 << 63), (1 << 63) - 1, 500)
    codes[100:300] = codes[100]
    codes[300:350] = codes[20] ^ (1 << rng.integers(0, 62, 50))
    rows = [(i, int(c)) for i, c in enumerate(codes)] + [(0, 2**62), (None, 5), (900, None)]
    frame = spark.createDataFrame(rows, "id long, code long")
    codes[0] = min(int(codes[0]), 2**62)
    found = hamming.top_k(frame, frame.where("id % 50 = 0"), 10).collect()
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r.query_id, []).append((r.distance, r.id))
    for q in range(0, 500, 50):
        expected = sorted((int(np.bitwise_count(np.uint64((int(c) ^ int(codes[q])) & (2**64 - 1)))), i) for i, c in enumerate(codes) if i != q)
        assert got[q] == expected[:10]
    few = frame.where("id IN (0, 50, 900)")
    assert hamming.top_k(few, few, 10).count() == 2
    assert hamming.top_k(frame.limit(0), frame.limit(0), 10).count() == 0


def test_hamming_cuts_cover_the_code():
    for entries in (0, 1, 200, 10_000, 10**6, 10**9):
        cuts = hamming._segments(entries, 10)
        assert [a + w for a, w in cuts] == [a for a, _ in cuts[1:]] + [hamming.BITS]
        assert 0 <= hamming._first_radius(cuts, entries, 10) <= hamming.WHOLE_RADIUS
    assert hamming._expected_radius(1 << 64, 1) == 0
