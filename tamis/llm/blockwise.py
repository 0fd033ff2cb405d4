"""Corpus-wide answers handed back to the tasks that scan a table.

A block is what one task reads of one file. A first scan collects the distinct questions of
each block, joins answer them for the whole corpus, and the answers are written by block to
the shared folder. A second scan reads the answers of its block, so texts are never shuffled
and a task holds the answers to its own questions only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm.records import file_system
from tamis.sources.staging import owned_folder, stage_table

#: Names of helper columns beside those of a table of any columns.
ROW, BLOCK = "__row", "__block"
CUTS = "spark.sql.files.minPartitionNum"


def hold_cuts(spark: SparkSession) -> None:
    """Keep the number that the size of file splits is taken from, unless it is set."""
    if spark.conf.get(CUTS, None) is None:
        now = spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or spark.sparkContext.defaultParallelism
        spark.conf.set(CUTS, str(now))


def with_block(table: DataFrame, name: str = "block") -> DataFrame:
    """``table``, a scan of files, with the block of each row as the long column ``name``.

    Both scans must be of the same files in the same session. Files would be cut by the number
    of executors that are there when a scan is planned; the number at the first scan is kept
    for the session, so that later scans are cut alike. A block is known by its file, start and
    length: the same block always has the same rows. Rows that come from no file, as behind a
    shuffle, are an error.
    """
    hold_cuts(table.sparkSession)
    place = F.xxhash64(F.input_file_name(), F.input_file_block_start(), F.input_file_block_length())
    fault = F.raise_error(F.lit("a scan of files is needed here; store the table first")).cast("long")
    return table.withColumn(name, F.when(F.input_file_name() != "", place).otherwise(fault))


def scanned(table: DataFrame) -> DataFrame:
    """``table`` if it reads files, else the table stored."""
    return table if table.inputFiles() else stage_table(table, "scanned")


def by_block(batches: Iterator[pa.RecordBatch], name: str = "block") -> Iterator[tuple[int, pa.RecordBatch]]:
    """Batches cut where the block changes."""
    for batch in batches:
        blocks = batch[name].to_numpy()
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(blocks)) + 1, [len(blocks)])).tolist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a < b:
                yield int(blocks[a]), batch.slice(a, b - a)


def write_by_block(answers: DataFrame, table: DataFrame) -> str:
    """Write ``answers`` under their ``block`` and return the folder.

    The blocks of ``table``, the scan that asked, are listed beside them, so that a block
    without answers differs from one that was never asked. Answers to a block that is not
    listed come from a scan that was cut otherwise, and are an error.
    """
    spark, path = answers.sparkSession, owned_folder(answers.sparkSession, "by-block")
    file_system(path)  # tasks will read there; a store they cannot read should fail now
    answers.repartition("block").write.partitionBy("block").parquet(path)
    listed = stage_table(with_block(table).select("block").distinct(), "blocks")
    listed.withColumn("asked", F.lit(True)).repartition("block").write.partitionBy("block").parquet(f"{path}-asked")
    answered = spark.read.schema(answers.schema).parquet(path).select("block").distinct()
    if not answered.join(listed, "block", "left_anti").isEmpty():
        raise RuntimeError(f"the files were cut in another way since the questions were asked: {path}")
    return path


def read_block(path: str, block: int) -> pa.Table | None:
    """The answers of one block, or None if it has none; runs inside tasks.

    A block that was never asked is an error: its answers are not known to be none.
    """
    from pyarrow import fs

    store, base = file_system(path)
    if store.get_file_info(f"{base}-asked/block={block}").type == fs.FileType.NotFound:
        raise RuntimeError(f"block {block} was not asked: the files were cut in another way before ({path})")
    return read_table(f"{path}/block={block}")


def read_table(path: str) -> pa.Table | None:
    """The parquet files of a folder in the shared store, or None without any; runs inside tasks."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, base = file_system(path)
    found = store.get_file_info(fs.FileSelector(base, allow_not_found=True))
    parts = []
    for info in sorted(found, key=lambda x: x.path):
        if info.path.endswith(".parquet"):
            with store.open_input_file(info.path) as file:
                parts.append(pq.ParquetFile(file).read())
    return pa.concat_tables(parts) if parts else None


def trim_memory() -> None:
    """Hand memory that a task freed back to the machine; its worker stays, beside the steps that follow."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def _filter(path: str, columns: list[str]):
    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, dropped, once = None, np.zeros(0, np.int64), set()
        for key, part in by_block(batches, BLOCK):
            if key != block:
                block, table = key, read_block(path, key)
                flags = table["once"].to_numpy() if table is not None else np.zeros(0, bool)
                rows = table["row"].to_numpy() if table is not None else dropped[:0]
                dropped, once = rows[~flags], set(rows[flags].tolist())
                spent: set[int] = set()
            rows = part[ROW].to_numpy()
            keep = ~np.isin(rows, dropped)
            for i, row in enumerate(rows.tolist()) if once else ():
                if row in once:
                    keep[i] = row not in spent
                    spent.add(row)
            yield part.filter(pa.array(keep)).select(columns)

    return sift


def without_rows(docs: DataFrame, key: str, text: str, decided: DataFrame) -> DataFrame:
    """``docs``, a scan of files, without the rows ``decided(block, row, once)``.

    ``row`` is the hash of key and text; where ``once`` is set, the first of the block's rows
    of that hash stays. Texts are filtered where they are read.
    """
    path = write_by_block(decided.select("block", "row", "once"), docs)
    marked = with_block(docs.select("*", F.xxhash64(key, text).alias(ROW)), BLOCK)
    return marked.mapInArrow(_filter(path, docs.columns), docs.schema)
