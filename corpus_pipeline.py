"""A corpus pipeline: quality, toxicity, near duplicates, mixing, token ids.

Each stage works on all documents that the stage before kept, written as Parquet and read again. All
but the last return the columns of ``documents``.

* quality: documents that the quality classifier rejects go.
* toxicity: documents that the toxicity scan rejects go.
* near_duplicates: one document of each group of SimHash near duplicates stays.
* mixing: a document appears as often as its fitted rate says, which may be never.
* token_ids: ids of each text, and whether decoding gives the text back.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritide.llm import bpe, mixing, quality, simhash, toxicity
from veritide.llm.common import checkpoint_folder
from veritide.llm.vocabulary import Spec

VOCABULARY = "byte_bpe_50k.json"
#: Parts of all kept tokens that each language is to have.
MIX = {"en": 0.50, "de": 0.17, "fr": 0.17, "es": 0.16}


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, _labels(spark, sf_dir))
    return quality.accepted(docs, model)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, _labels(spark, sf_dir))
    return toxicity.accepted(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labelled = mixing.language_labels(docs, _labels(spark, sf_dir))
    return mixing.mixed(docs, labelled, MIX)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    made = bpe.tokens(F.col("text"), Spec.read(public_tokenizers.path(VOCABULARY)), "ids", "n_tokens", "same_text")
    return docs.select("doc_id", "lang", "source", made.alias("made")).select(
        "doc_id", "lang", "source", "made.n_tokens", "made.ids", "made.same_text"
    )


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("token_ids", token_stage),
]

#: The stages learn models, follow links and merge symbols, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; stages are written below the shared checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_folder(docs)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
