import hashlib

import pytest
from pyspark.sql import functions as F

from tamis.functions import minhash
from tamis.operators import clean, dedupe
from tamis.sources import testtables

RECORDS = "id string, title string, PMID string, main_text string"
ROWS = [
    ("3", "c", "30", "alpha beta gamma"),
    ("10", "a", "100", "Alpha beta gamma gamma"),
    ("2", "b", "20", "gamma beta alpha alpha"),
    ("5", "d", "50", "something else here"),
    ("7", "e", "70", "\n"),
    ("8", "f", "80", "\t \n"),
    ("9", None, None, ""),
    ("91", None, None, ""),
]


def by_hand(words):
    hashes = [int(hashlib.md5(w.encode()).hexdigest()[:7], 16) for w in set(words)]
    return tuple(min(((1 + h) * a + b) % minhash.PRIME for h in hashes) for a, b in minhash.COEFFICIENTS)


def test_signature_by_hand(spark):
    got = {r.id: tuple(r)[1:] for r in dedupe.minhash_signature(spark.createDataFrame(ROWS, RECORDS)).collect()}
    assert got["3"] == got["10"] == got["2"] == by_hand(["alpha", "beta", "gamma"])
    assert got["5"] == by_hand(["something", "else", "here"])
    assert got["9"] == by_hand([""])
    assert got["7"] == (None,) * 5


@pytest.mark.parametrize("partitions", [1, 37])
def test_smallest_id_survives_and_bare_texts_stay(spark, partitions):
    df = spark.createDataFrame(ROWS, RECORDS).repartition(partitions)
    kept = dedupe.dedupe_signature(df)
    assert kept.columns == df.columns
    rows = {r.id: tuple(r) for r in kept.collect()}
    assert sorted(rows) == ["10", "5", "7", "8", "9"]
    assert rows["10"] == ROWS[1]
    assert sorted(r.id for r in dedupe.dedupe_signature(kept).collect()) == sorted(rows)


def test_hashed_term_frequencies(spark):
    got = {r.id: (r.n_buckets, r.total_tf) for r in dedupe.hashing_tf_summary(spark.createDataFrame(ROWS, RECORDS)).collect()}
    assert got["10"] == (3, 4) and got["7"] == (0, 0) and got["9"] == (1, 1)


def test_spark_ml_signatures(spark):
    df = spark.createDataFrame(ROWS, RECORDS)
    first, second = (
        {r.id: tuple(r)[1:] for r in dedupe.minhash_ml(x).collect()} for x in (df, df.repartition(5))
    )
    assert first == second
    assert first["3"] == first["10"] == first["2"] != first["5"]
    assert first["7"] == (None,) * 5
    assert first != {r.id: tuple(r)[1:] for r in dedupe.minhash_ml(df, seed=7).collect()}
    assert sorted(r.id for r in dedupe.dedupe_signature_ml(df).collect()) == ["10", "5", "7", "8", "9"]


@pytest.mark.parametrize("operator", [dedupe.hashing_tf, dedupe.minhash_ml, dedupe.dedupe_signature_ml])
def test_spark_ml_splits_a_text_once(spark, operator):
    """Cleaned for the test for null and for the tokens, not for every mention of either."""
    docs = spark.range(5).select(F.col("id").alias("doc_id"), F.repeat(F.col("id").cast("string"), 60).alias("text"))
    cleaned = clean.clean_stage(testtables.documents_as_raw(docs))
    plan = operator(cleaned)._jdf.queryExecution().executedPlan().toString()
    assert plan.count(r"\s{2,}") <= 2 and plan.count("split(lower(") == 1


def test_a_null_text_has_no_spark_ml_signature(spark):
    rows = [("1", None, None, None), ("1", None, None, None), (None, None, None, "\n"), (None, None, None, "a b a")]
    got = dedupe.minhash_ml(spark.createDataFrame(rows, RECORDS)).collect()
    assert [r.id for r in got] == [None, None] and sorted(r.m0 is None for r in got) == [False, True]


def test_a_third_of_all_rows_may_be_copies(spark):
    """Map-side aggregation leaves one record per task and signature to be shuffled."""
    copies = spark.range(0, 30000, 1, 8).select(
        F.format_string("%08d", "id").alias("id"), F.lit("t").alias("title"), F.lit("1").alias("PMID"),
        F.when(F.col("id") % 3 == 0, "the same text again and again")
        .otherwise(F.format_string("a%d b%d c%d", "id", "id", "id"))
        .alias("main_text"),
    )
    kept = dedupe.dedupe_signature(copies)
    same = kept.filter(F.col("main_text").startswith("the same"))
    assert [r.id for r in same.collect()] == ["00000000"]
    assert kept.count() == 20001
