"""Stored rows that later steps choose from without moving them.

A step that keeps some of many wide rows, as deduplication does, needs only a few narrow
columns to decide. Rows are therefore stored once, in a narrow pass, under a shard and a
number. The decision travels as ``(shard, row)`` and comes back as one set of bits per shard,
which the scan of the stored rows joins with: the wide side is never shuffled or sorted.

Spark joins without an exchange of a table whose files are bucketed by the key. A task writes
all its rows under one shard, a number whose bucket is known, so it writes one file, in the
order it has, and nothing has to move to make the buckets.
"""

from __future__ import annotations

import json
import math
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.sources.staging import owned_folder, remove_folder, session_setting

SHARD, ROW = "_shard", "_row"
PLACE = [SHARD, ROW]


@cache
def shard_numbers(n: int) -> tuple[int, ...]:
    """The least number of each of ``n`` buckets, as Spark deals rows to the buckets of a table."""
    spark, tried = SparkSession.active(), n * (int(math.log(n + 1)) + 8)
    while True:
        bucket = F.pmod(F.hash(F.col("id").cast("int")), F.lit(n))
        rows = spark.range(tried).groupBy(bucket.alias("b")).agg(F.min("id").alias("id")).collect()  # a row per bucket
        if len(rows) == n:
            return tuple(r["id"] for r in sorted(rows))
        tried *= 2


def store_rows(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` in one narrow pass and return the scan of it, with ``_shard`` and ``_row``.

    There are as many shards as shuffle partitions; a task's rows have one shard, and numbers
    that no other row has. The table is known to the session's catalogue under a name of its own.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbers = F.from_json(F.lit(json.dumps(shard_numbers(n))), "array<int>")  # a constant
    part = F.shiftright("_place", 33).cast("int")
    placed = df.withColumn("_place", F.monotonically_increasing_id()).withColumns(
        {SHARD: F.get(numbers, F.pmod(part, F.lit(n))), ROW: F.col("_place")}
    )
    table, path = f"{name}_{uuid.uuid4().hex}".replace("-", "_"), owned_folder(spark, name)
    # With an open file per bucket, and a task has one, rows are written as they come, unsorted.
    with session_setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "4"):
        placed.drop("_place").write.format("parquet").bucketBy(n, SHARD).option("path", path).saveAsTable(table)
    return spark.table(table)


def _known_table(stored: DataFrame):
    return stored._jdf.queryExecution().analyzed().collectLeaves().head().catalogTable().get()


def folder_of(stored: DataFrame) -> str:
    """Where a table that ``store_rows`` made lies."""
    return _known_table(stored).location().toString()


def drop_rows(spark: SparkSession, stored: DataFrame) -> None:
    """Remove a table that ``store_rows`` made, and its files."""
    path = folder_of(stored)
    spark.sql(f"DROP TABLE {_known_table(stored).identifier().quotedString()}")
    remove_folder(spark, path)


def has_bit(bits: Column, row: Column) -> Column:
    """Whether ``row`` is in ``bits``, a map from bucket numbers to Spark's bitmaps; null as no."""
    bitmap = F.element_at(bits, F.bitmap_bucket_number(row))
    at = F.bitmap_bit_position(row)
    byte = F.conv(F.hex(F.substr(bitmap, F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1


def row_sets(chosen: DataFrame) -> DataFrame:
    """``(_shard, _bits)`` of ``chosen(_shard, _row)``: one row per shard, a bit per row."""
    bucket = F.bitmap_bucket_number(ROW).alias("bucket")
    maps = chosen.groupBy(SHARD, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(ROW)).alias("bits"))
    return maps.groupBy(SHARD).agg(F.map_from_entries(F.collect_list(F.struct("bucket", "bits"))).alias("_bits"))


def pick_rows(stored: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``stored``, a scan by ``store_rows``, that ``chosen(_shard, _row)`` names.

    Only the sets of bits are shuffled: a bit per row, and a little per four thousand of them.
    The hint makes them the hashed side, so the stored rows stream by.
    """
    sets = row_sets(chosen.select(*PLACE)).withColumnRenamed(SHARD, "_of").hint("shuffle_hash")
    met = (F.col(SHARD) == F.col("_of")) & has_bit(F.col("_bits"), F.col(ROW))
    return stored.join(sets, met, "left_semi")


def first_rows_of(stored: DataFrame, chosen: DataFrame, key: str, n: int) -> DataFrame:
    """Of the rows that ``chosen(key, _shard, _row)`` names, the ``n`` with the smallest keys.

    The ``n`` places are looked up first; as a filter on the row numbers they spare the scan
    all other row groups.
    """
    rows = [r[0] for r in chosen.orderBy(key).limit(n).select(ROW).collect()]
    return stored.filter(F.col(ROW).isin(rows))
