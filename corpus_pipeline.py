"""The training-data pipeline over ``documents``: five stages, each written and read again.

All stages but the last return the columns of ``documents``, whatever their names, and keep null
and empty texts, which no stage has a reason to drop. Repeated rows and equal texts are near
copies: one stays. A null ``doc_id`` or ``lang`` is a value like any other. Texts are taken whole.
Without labels nothing is rejected, without benchmark items nothing is contaminated, without
documents there are no rows.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm import decontaminate, disclosure, kneser, lattice, set_join
from tamis.sources.staging import staging_root


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents whose perplexity is beyond their language's thresholds."""
    return kneser.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return set_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents in which a benchmark item occurs."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and what discloses it masked; ``n_chars`` follows the text."""
    masked = disclosure.sanitise(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.char_length("text").cast(dict(docs.dtypes)["n_chars"]))
    return masked


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_pieces, ids, exact)``: every text in pieces."""
    return lattice.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("SentencePiece encoding and decoding", pieces),
]

#: Hash trees, language models and piece lattices are beyond SQL; the tests hold the stages
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before wrote in the shared folder."""
    folder = f"{staging_root(spark)}/{spark.sparkContext.applicationId}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
