"""Stage 3: token arrays and the final column list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.functions.tokens import tokenize


def with_tokens(df: DataFrame, column: str = "main_text", output: str = "tokens") -> DataFrame:
    return df.withColumn(output, tokenize(F.col(column)))


def final_dataset(records: DataFrame, title_tokens: bool = False) -> DataFrame:
    """``id, PMID, title, main_text, tokens`` and, on request, ``title_tokens``."""
    columns = ["id", "PMID", "title", "main_text", tokenize(F.col("main_text")).alias("tokens")]
    if title_tokens:
        columns.append(tokenize(F.col("title")).alias("title_tokens"))
    return records.select(*columns)


def doc_lengths(final: DataFrame) -> DataFrame:
    """Characters (code points) and tokens (empty ones included) of each document."""
    return final.select(
        "id",
        F.length("main_text").alias("text_length"),
        F.size("tokens").alias("token_count"),
    )
