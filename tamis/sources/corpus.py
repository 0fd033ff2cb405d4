"""Parquet in, parquet out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tamis.sources.catalogue import stored_once

RAW_COLUMNS = ("id", "title", "content", "contents", "PMID")

# Fixed value: most rows shown in a table.
TABLE_ROWS = 500


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"input lacks the columns {missing}; it has {df.columns}")
    return df


def read_corpus(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] = RAW_COLUMNS,
    partitions: int | None = None,
) -> DataFrame:
    """Read one parquet directory or several as one scan.

    Spark cannot divide a row group among tasks. A corpus of few files with one row group each
    can be dealt into ``partitions`` files, at the price of one shuffle of its rows; that copy is
    stored once per application and read from then on.
    """
    paths = [path] if isinstance(path, str) else list(path)
    corpus = require_columns(spark.read.parquet(*paths), columns)
    if not partitions:
        return corpus
    columns = corpus.select(*columns)
    return stored_once(columns, f"dealt-{partitions}", lambda: columns.repartition(partitions))


def write_stage(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def first_rows(df: DataFrame, columns: Sequence[str], limit: int, key: str = "id") -> DataFrame:
    """The ``limit`` rows with the smallest keys, so that a rerun shows the same rows."""
    return df.select(*columns).orderBy(key).limit(limit)


def load_sample(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    limit: int = TABLE_ROWS,
    key: str = "id",
) -> DataFrame:
    """A sample for display; an empty frame when there is nothing at the path.

    Any other fault, such as a missing column, is an error.
    """
    try:
        return first_rows(read_corpus(spark, path, columns), columns, limit, key)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        schema = T.StructType([
            T.StructField(c, T.ArrayType(T.StringType()) if c == "tokens" else T.StringType())
            for c in columns
        ])
        return spark.createDataFrame([], schema)


def write_report(report: DataFrame, path: str) -> None:
    """Write a one-row report as a JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)
