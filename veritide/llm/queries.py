"""The queries of these operators, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritide.llm import (
    bloom_dedup, bpe, chat, fim, graph_ann, hamming, kd_shards, mixing, prefix_trie, quality, rans, simhash, toxicity
)
from veritide.llm.common import checkpoint_folder
from veritide.llm.vocabulary import Spec

VOCABULARY = "byte_bpe_50k.json"
SHARDS = 40
NEAREST = 20
NEAREST_CODES = 10
#: Parts of all tokens that the domains, here languages, are to have.
MIX = {"en": 0.40, "de": 0.22, "fr": 0.20, "es": 0.18}

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _spec() -> Spec:
    return Spec.read(public_tokenizers.path(VOCABULARY))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = quality.fit(documents, _table(spark, sf_dir, "labels"))
    return quality.scored_documents(documents, model).select("doc_id", "held_out", "score", "predicted")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.grouped(_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op3_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.sharded(_table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector")
    )
    found = graph_ann.nearest(vectors, vectors.where("id % 20 = 0"), NEAREST)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), _spec())


def op6_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = chat.rotated(_table(spark, sf_dir, "conversations"))
    joined = {c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("starts", "stops", "mask")}
    return rendered.withColumns(joined).withColumnRenamed("conversation", "conv_id")


def op7_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(documents)}/tokens-{uuid.uuid4().hex}"
    rans.write_tokens(documents, _spec(), folder)
    return rans.read_tokens(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op8_toxic_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, _table(spark, sf_dir, "labels"))
    scored = toxicity.scored_documents(documents, model)
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


def op9_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    labelled = mixing.language_labels(documents, _table(spark, sf_dir, "labels"))
    rated, plan = mixing.rated(documents, labelled, MIX)
    at = {d: i for i, d in enumerate(plan.domains)}
    share = lambda d: F.get("posteriors", F.lit(at[d])) if d in at else F.lit(0.0)
    return rated.select(
        "doc_id",
        "tokens",
        "rate",
        mixing.copies(F.col("rate"), F.col("draw")).alias("copies"),
        *[share(d).alias(f"p_{d}") for d in MIX],
    )


def op10_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), hamming.sign_code(F.col("embedding")).alias("code")
    )
    found = hamming.top_k(codes, codes.where("id % 50 = 0"), NEAREST_CODES)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


def op11_bloom_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_dedup.verdicts(_table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.numbered(_table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(*prefix_trie.rebuilt(turns))


def queries() -> dict[str, Query]:
    own = [
        op1_quality_classifier, op2_simhash_near_dedup, op3_kd_sharding, op4_graph_neighbours, op5_bpe,
        op6_perspective_rotation, op7_rans_tokens, op8_toxic_passages, op9_soft_mixing, op10_hamming_top_k,
        op11_bloom_dedup, op12_fill_in_middle, op13_prefix_trie,
    ]
    return {q.__name__: q for q in own}


ROTATION = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(text, '') AS content,
    CASE WHEN trim(coalesce(role, '')) = '' THEN 'unknown' ELSE trim(role) END AS speaker,
    CAST(floor(turn / 64.0) AS BIGINT) AS part
  FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS assistant FROM turns WHERE speaker <> 'system'),
written AS (
  SELECT t.conv_id, p.assistant, t.part, t.turn, t.speaker, t.content,
    '<|im_start|>' || CASE WHEN t.speaker = 'system' THEN 'system' WHEN t.speaker = p.assistant THEN 'assistant'
      ELSE 'user name=' || t.speaker END || chr(10) AS head,
    CAST(t.speaker = p.assistant AS INTEGER) AS learnt
  FROM turns t JOIN people p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, assistant, part ORDER BY turn NULLS LAST, speaker, content) - 1 AS place
  FROM written),
placed AS (
  SELECT *, place // 256 AS piece, sum(length(head) + length(content) + 11) OVER (
    PARTITION BY conv_id, assistant, part, place // 256 ORDER BY place ROWS UNBOUNDED PRECEDING) AS last
  FROM numbered)
SELECT conv_id, assistant, part, CAST(piece AS BIGINT) AS piece, count(*) AS n_turns,
  string_agg(head || content || '<|im_end|>' || chr(10), '' ORDER BY place) AS text,
  string_agg(CAST(CAST(last - 11 - length(content) AS BIGINT) AS VARCHAR), ',' ORDER BY place) AS starts,
  string_agg(CAST(CAST(last - 11 AS BIGINT) AS VARCHAR), ',' ORDER BY place) AS stops,
  string_agg(CAST(learnt AS VARCHAR), ',' ORDER BY place) AS mask
FROM placed GROUP BY conv_id, assistant, part, piece
"""

#: All pairs of a query with other rows, by brute force: signs compared one by one.
HAMMING = """
WITH bits AS (SELECT vec_id, list_transform(embedding, lambda v: v > 0) AS sign FROM embeddings),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(range(1, 65), lambda i: CAST(q.sign[i] <> c.sign[i] AS INTEGER))) AS distance
  FROM bits q JOIN bits c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(distance AS INTEGER) AS distance
FROM ranked WHERE rank <= 10
"""


EXACT_DEDUP = """
WITH lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS plain FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(plain) AS text_sha256
FROM lowered WINDOW same AS (PARTITION BY plain)
"""

FILL_IN_MIDDLE = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS drawn,
    regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tokens
  FROM documents),
numbers AS (
  SELECT *, len(tokens) AS n, CAST('0x' || substr(drawn, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(drawn, 9, 8) AS BIGINT) AS h2,
    CAST('0x' || substr(drawn, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(drawn, 25, 8) AS BIGINT) AS h4
  FROM cut),
forms AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
parts AS (
  SELECT *, array_to_string(tokens[1:a], '') AS prefix, array_to_string(tokens[a + 1:b], '') AS middle,
    array_to_string(tokens[b + 1:], '') AS suffix
  FROM forms)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
    ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

#: Paths are written out, so the SQL needs memory that the query doesn't. DuckDB has no crc32: it is reckoned bit by bit.
TRIE = """
WITH items AS (
  SELECT conv_id, turn, strlen(coalesce(text, '')) AS size,
    substr(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS item
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, item) AS pos FROM items),
convs AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS base, xor(4294967295::BIGINT, list_reduce(
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)),
    lambda c, x: list_reduce([xor(c, x), 1, 1, 1, 1, 1, 1, 1, 1]::BIGINT[],
      lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END),
    4294967295::BIGINT)) % 9 AS h
  FROM own),
rebuilt AS (
  SELECT c.conv_id, o.pos, o.item, o.size FROM convs c JOIN own o ON o.conv_id = c.base AND o.pos <= c.h
  UNION ALL SELECT c.conv_id, o.pos, o.item, o.size FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h),
paths AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY pos) AS depth, size,
    string_agg(item, '') OVER (PARTITION BY conv_id ORDER BY pos) AS path
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
lengths AS (SELECT conv_id, max(depth) AS length FROM paths GROUP BY conv_id),
nodes AS (
  SELECT path, depth, any_value(size) AS size, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE length = depth), '')) AS ends_sha256
  FROM paths JOIN lengths USING (conv_id) GROUP BY path, depth),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, substr(n.path, 1, 32 * (n.depth - 1)) AS above
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = substr(n.path, 1, 32 * (n.depth - 1))),
children AS (SELECT above AS path, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY above),
counted AS (SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN children USING (path)),
subtrees AS (
  SELECT a.path, count_if(d.n_children = 0) AS n_leaves, sum((d.n_convs - 1) * d.size) AS saved_tokens
  FROM counted d JOIN paths a ON a.conv_id = d.conv_id AND a.depth <= d.depth GROUP BY a.path)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM counted JOIN subtrees USING (path)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op6_perspective_rotation": ROTATION,
        "op10_hamming_top_k": HAMMING,
        "op11_bloom_dedup": EXACT_DEDUP,
        "op12_fill_in_middle": FILL_IN_MIDDLE,
        "op13_prefix_trie": TRIE,
    }
