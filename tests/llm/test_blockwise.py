import pytest
from pyspark.sql import functions as F

from tamis.llm import blockwise

FANNED = "spark.sql.leafNodeDefaultParallelism"  # stands for the executors that are there


@pytest.fixture
def docs(spark, tmp_path):
    """One file of many row groups in a session that does not say how files are cut."""
    held = spark.conf.get(blockwise.CUTS)
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.unset(blockwise.CUTS)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    spark.conf.set(FANNED, "8")
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    rows.coalesce(1).write.option("parquet.block.size", 20_000).parquet(str(tmp_path / "docs"))
    yield spark.read.parquet(str(tmp_path / "docs"))
    spark.conf.set(blockwise.CUTS, held)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)
    spark.conf.unset(FANNED)


def without_odd_rows(docs):
    rows = blockwise.with_block(docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row")))
    odd = rows.filter("doc_id % 2 = 1").select("block", "row", F.lit(False).alias("once"))
    assert rows.select("block").distinct().count() > 1
    return blockwise.without_rows(docs, "doc_id", "text", odd)


def test_scans_are_cut_alike_when_executors_come_and_go(spark, docs):
    kept = without_odd_rows(docs)
    spark.conf.set(FANNED, "3")
    assert {r.doc_id for r in kept.select("doc_id").collect()} == set(range(0, 4000, 2))


def test_a_block_that_was_not_asked_is_an_error(spark, docs):
    kept = without_odd_rows(docs)
    spark.conf.set(blockwise.CUTS, "3")
    with pytest.raises(Exception, match="was not asked"):
        kept.collect()


def test_answers_of_another_cut_are_an_error(spark, docs):
    rows = blockwise.with_block(docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row")))
    odd = blockwise.stage_table(rows.select("block", "row", F.lit(False).alias("once")), "odd")
    spark.conf.set(blockwise.CUTS, "3")
    with pytest.raises(RuntimeError, match="cut in another way"):
        blockwise.without_rows(docs, "doc_id", "text", odd)


def test_stores_are_found_by_their_scheme():
    from tamis.llm.records import file_system

    assert file_system("file:///tmp/x")[1] == "/tmp/x" and file_system("file:/tmp/x")[1] == "/tmp/x"
    assert file_system("s3a://bucket/x?region=eu-west-1")[1] == "bucket/x"
    for bad in ("/tmp/x", "viewfs://elsewhere/x"):
        with pytest.raises((ValueError, OSError)):
            file_system(bad)
