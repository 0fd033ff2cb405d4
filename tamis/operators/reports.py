"""Record counts through the stages and what they say about the reduction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.functions import text as X
from tamis.operators.clean import clean_stage
from tamis.operators.dedupe import first_survivors, signed_rows, survivors
from tamis.operators.finalize import with_tokens

# Labels of the stages and of the two parts of the corpus.
STAGES = ("Initial Load", "Stage 1: Cleaned & Filtered", "Stage 2/3: Deduplicated & Final")
PARTS = ("Final LLM Data", "Records Removed (Noise, Short, Duplicates)")


def stage_counts(raw: DataFrame) -> DataFrame:
    """``initial, cleaned, final`` as one row.

    The last two are counts of the stored signed records and survivors, which parquet footers
    hold; cleaning and signing are done once for all that asks.
    """
    signed = signed_rows(clean_stage(raw))
    stages = {"initial": raw, "cleaned": signed, "final": survivors(signed)}
    counts = [df.agg(F.count(F.lit(1))).scalar().alias(name) for name, df in stages.items()]
    return raw.sparkSession.range(1).select(*counts)


def stage_flow(counts: DataFrame) -> DataFrame:
    """Three rows: stage number, stage, records."""
    rows = [
        F.struct(F.lit(i).alias("stage_no"), F.lit(label).alias("stage"), F.col(c).alias("records"))
        for i, (label, c) in enumerate(zip(STAGES, ("initial", "cleaned", "final"), strict=True))
    ]
    return counts.select(F.inline(F.array(*rows)))


def dedupe_removed(counts: DataFrame) -> DataFrame:
    """Input, survivors and removed records of the deduplication stage."""
    return counts.select(
        F.col("cleaned").alias("n_input"),
        F.col("final").alias("n_kept"),
        (F.col("cleaned") - F.col("final")).alias("n_removed"),
    )


def impact(counts: DataFrame) -> DataFrame:
    """Final and removed records with their share of the whole, in percent."""
    removed = F.col("initial") - F.col("final")
    rows = [
        F.struct(
            F.lit(label).alias("metric"),
            n.alias("records"),
            F.when(F.col("initial") > 0, n * 100 / F.col("initial")).otherwise(0.0).alias("percent"),
        )
        for label, n in zip(PARTS, (F.col("final"), removed), strict=True)
    ]
    return counts.select(F.inline(F.array(*rows)))


def reduction_rate(counts: DataFrame) -> DataFrame:
    """Initial and removed records and the rate in percent; 0 for an empty corpus."""
    removed = F.col("initial") - F.col("final")
    rate = F.when(F.col("initial") > 0, removed / F.col("initial") * 100).otherwise(0.0)
    return counts.select(
        F.col("initial").alias("n_initial"),
        removed.alias("n_removed"),
        F.round(rate, 2).alias("reduction_percent"),
    )


def clean_report(stage1: DataFrame, min_chars: int = X.MIN_CHARS) -> DataFrame:
    """Kept records that cleaning left at or below the minimum length."""
    length = F.length(F.trim("main_text"))
    return stage1.agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(length <= min_chars).alias("n_short_after_clean"),
        F.count_if(length == 0).alias("n_empty_after_clean"),
    )


def side_by_side(raw: DataFrame, rows: int = 10) -> DataFrame:
    """The first ``rows`` final documents with their text before and after cleaning.

    The ids are chosen among the survivors, so that only the sampled records are read, cleaned
    and tokenized; Spark broadcasts them by the estimate that their number gives.
    """
    cleaned = clean_stage(raw)
    final = with_tokens(first_survivors(cleaned, rows)).orderBy("id").limit(rows)
    sample = final.select("id", F.col("main_text").alias("final_text"), "tokens")
    few = raw.join(sample.select("id"), "id", "left_semi")
    before = few.select(F.col("id").cast("string").alias("id"), "title", "content")
    after = clean_stage(few).select("id", F.col("main_text").alias("clean_text"))
    return after.join(before.join(sample, "id"), "id").select(
        "id", "title", "content", "clean_text", "final_text", "tokens"
    )
