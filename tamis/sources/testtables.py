"""The given test tables, seen as the engine's inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.sources.corpus import read_corpus

#: Session setting: into how many partitions the raw records are dealt; as they are, if unset.
PARTITIONS = "spark.tamis.testtables.partitions"


def documents_as_raw(documents: DataFrame) -> DataFrame:
    """``documents`` as raw records, with noise for the cleaning steps.

    The noise depends on ``doc_id`` alone: NULL or too short ``content`` (the
    fallback to ``contents``), citations, the label and wide whitespace.
    """
    doc, text = F.col("doc_id"), F.col("text")
    head = F.split_part(text, F.lit("."), F.lit(1))
    noisy = F.concat(
        F.lit("Abstract "), text, F.lit(" ["), (doc % 9).cast("string"), F.lit("]  [1-3]")
    )
    content = (
        F.when(doc % 10 == 3, F.lit(None).cast("string"))
        .when(doc % 10 == 7, F.substring(text, 1, 40))
        .when(doc % 2 == 0, noisy)
        .otherwise(text)
    )
    return documents.select(
        doc.cast("string").alias("id"),
        head.alias("title"),
        content.alias("content"),
        F.concat(head, F.lit(". "), text).alias("contents"),
        (F.lit(30000000) + doc).alias("PMID"),
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records; each test table is one row group, which ``PARTITIONS`` can divide."""
    partitions = int(spark.conf.get(PARTITIONS, "0")) or None
    documents = read_corpus(spark, f"{sf_dir}/documents.parquet", ["doc_id", "text"], partitions)
    return documents_as_raw(documents.select("doc_id", "text"))


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")
