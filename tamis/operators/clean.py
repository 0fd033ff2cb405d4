"""Stage 1: raw records to clean main text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.functions import text as X


def project_raw(raw: DataFrame) -> DataFrame:
    """The five raw columns, ``PMID`` as a string."""
    return raw.select("id", "title", "content", "contents", F.col("PMID").cast("string").alias("PMID"))


def select_main_text(raw: DataFrame, min_chars: int = X.MIN_CHARS) -> DataFrame:
    """Replace the two content columns by ``main_text``."""
    chosen = X.preferred_text(F.col("content"), F.col("contents"), min_chars)
    return raw.withColumn("main_text", chosen).drop("content", "contents")


def drop_short(records: DataFrame, min_chars: int = X.MIN_CHARS) -> DataFrame:
    """Keep records whose trimmed text is longer than ``min_chars``."""
    return records.filter(X.is_long_enough(F.col("main_text"), min_chars))


def clean_stage(raw: DataFrame, min_chars: int = X.MIN_CHARS) -> DataFrame:
    """Raw records to ``id, title, PMID, main_text``.

    The length filter sees the text before cleaning, so a kept text can be
    short or empty afterwards. One narrow stage: no shuffle.
    """
    records = drop_short(select_main_text(project_raw(raw), min_chars), min_chars)
    return records.withColumn("main_text", X.clean_text(F.col("main_text")))
