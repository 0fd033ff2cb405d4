"""The four stages over stored tables, each reading what the one before wrote."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.operators import reports, stats
from tamis.operators.clean import clean_stage
from tamis.operators.dedupe import dedupe_signature
from tamis.operators.finalize import final_dataset
from tamis.sources.corpus import read_corpus, write_report, write_stage

CLEAN_COLUMNS = ("id", "title", "PMID", "main_text")
FINAL_COLUMNS = ("id", "PMID", "title", "main_text", "tokens")


@dataclass(frozen=True)
class Layout:
    """Where the stages of one corpus lie."""

    root: str

    @property
    def cleaned(self) -> str:
        return f"{self.root}/cleaned/stage1_data"

    @property
    def deduped(self) -> str:
        return f"{self.root}/cleaned/stage2_data"

    @property
    def final(self) -> str:
        return f"{self.root}/final/dataset"

    @property
    def report(self) -> str:
        return f"{self.root}/analysis/report"


def run_clean(spark: SparkSession, raw_path: str, layout: Layout) -> None:
    write_stage(clean_stage(read_corpus(spark, raw_path)), layout.cleaned)


def run_dedupe(spark: SparkSession, layout: Layout) -> None:
    write_stage(dedupe_signature(read_corpus(spark, layout.cleaned, CLEAN_COLUMNS)), layout.deduped)


def run_tokenize(spark: SparkSession, layout: Layout) -> None:
    write_stage(final_dataset(read_corpus(spark, layout.deduped, CLEAN_COLUMNS)), layout.final)


def run_analysis(spark: SparkSession, layout: Layout) -> None:
    final = read_corpus(spark, layout.final, FINAL_COLUMNS)
    write_report(stats.analysis_report(final), layout.report)


def run_stages(spark: SparkSession, raw_path: str, root: str) -> Layout:
    """Run all four stages; an error in one ends the run before the next."""
    layout = Layout(root.rstrip("/"))
    run_clean(spark, raw_path, layout)
    run_dedupe(spark, layout)
    run_tokenize(spark, layout)
    run_analysis(spark, layout)
    return layout


def stored_counts(spark: SparkSession, raw_path: str, layout: Layout) -> DataFrame:
    """``initial, cleaned, final`` of a finished run.

    Counting a stored parquet table reads its footers only, and unlike metrics
    collected while writing it stays exact when tasks are run twice.
    """
    sources = {"initial": raw_path, "cleaned": layout.cleaned, "final": layout.final}
    counts = [spark.read.parquet(p).agg(F.count(F.lit(1))).scalar().alias(c) for c, p in sources.items()]
    return spark.range(1).select(*counts)


def stored_report(spark: SparkSession, raw_path: str, layout: Layout) -> DataFrame:
    return reports.stage_flow(stored_counts(spark, raw_path, layout))
