import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamis.operators import finalize, reports, stats

FINAL = "id string, main_text string, tokens array<string>"
LENGTHS = [3, 3, 4, 5, 6, 7, 8, 9, 10, 60]


@pytest.fixture(scope="module")
def final(spark):
    rows = [(str(i), "x" * n, [f"t{k % 4}" for k in range(n)]) for i, n in enumerate(LENGTHS)]
    return spark.createDataFrame(rows, FINAL).cache()


def test_equal_counts_are_ordered_by_key(spark):
    df = spark.createDataFrame([("1", "", ["b", "a", "c", "c", "", "d"])], FINAL)
    assert [tuple(r) for r in stats.top_tokens(df, 3).collect()] == [("c", 2), ("", 1), ("a", 1)]
    top = stats.top_ngrams(df, 2, 2)
    assert [tuple(r) for r in top.collect()] == [("b a", 1), ("c c", 1)]


def test_global_figures(final):
    assert tuple(stats.corpus_stats(finalize.doc_lengths(final)).first()) == (10, np.mean(LENGTHS))
    assert tuple(stats.length_metrics(finalize.doc_lengths(final)).first()) == (10, np.mean(LENGTHS), np.mean(LENGTHS))


def test_null_ids_are_not_counted(spark):
    df = spark.createDataFrame([(None, "abc", ["abc"]), ("1", "a", ["a"])], FINAL)
    assert tuple(stats.corpus_stats(finalize.doc_lengths(df)).first()) == (1, 2.0)


def test_histogram(final):
    rows = {r.bin: r for r in stats.token_histogram(finalize.doc_lengths(final)).collect()}
    wanted, edges = np.histogram(LENGTHS, bins=50)
    assert {b: r.n_docs for b, r in rows.items()} == {i: n for i, n in enumerate(wanted) if n}
    for b, r in rows.items():
        assert r.bin_start == pytest.approx(edges[b])
        assert r.log10_docs == pytest.approx(math.log10(r.n_docs), abs=1e-6)


def test_histogram_of_one_length(spark):
    df = spark.createDataFrame([("1", "", ["a"]), ("2", "", ["b"])], FINAL)
    assert [(r.bin, r.n_docs) for r in stats.token_histogram(finalize.doc_lengths(df)).collect()] == [(0, 2)]


def test_box(final):
    box = stats.token_box_stats(finalize.doc_lengths(final)).first()
    q1, q2, q3, p99 = np.percentile(LENGTHS, [25, 50, 75, 99])
    assert (box.q1, box.median, box.q3) == (q1, q2, q3)
    assert box.p99 == pytest.approx(p99) and box.axis_cap == pytest.approx(1.5 * p99)
    assert (box.lower_whisker, box.upper_whisker, box.n_outliers) == (3, 10, 1)


def test_report(final):
    report = stats.analysis_report(final, 2).first()
    assert (report.total_records, report.mean_text_length) == (10, 11.5)
    counts = [(r.token, r["count"]) for r in report.top_tokens]
    assert counts == [tuple(r) for r in stats.top_tokens(final, 2).collect()]


def counted(spark, *row):
    return spark.createDataFrame([row], "initial bigint, cleaned bigint, final bigint")


def test_reports(spark):
    counts = counted(spark, 2209839, 2209839, 2023233)
    assert tuple(reports.reduction_rate(counts).first()) == (2209839, 186606, 8.44)
    assert tuple(reports.dedupe_removed(counts).first()) == (2209839, 2023233, 186606)
    assert [r.records for r in reports.stage_flow(counts).orderBy("stage_no").collect()] == [2209839, 2209839, 2023233]
    shares = [r.percent for r in reports.impact(counts).collect()]
    assert sum(shares) == pytest.approx(100) and shares[1] == pytest.approx(8.4443, abs=1e-4)


def test_an_empty_corpus_has_rate_zero(spark):
    assert reports.reduction_rate(counted(spark, 0, 0, 0)).first().reduction_percent == 0
    assert [r.percent for r in reports.impact(counted(spark, 0, 0, 0)).collect()] == [0, 0]


def test_counts_in_one_pass(spark):
    rows = [
        ("1", "t", "same words here " * 5, None, 1),
        ("2", "t", "here same words " * 5, None, 2),
        ("3", "t", "tiny", "tiny", 3),
        ("4", "t", None, None, 4),
        ("5", "t", "\n" + "\t" * 60, None, 5),
        ("6", "t", "[1]" * 20, None, 6),
    ]
    raw = spark.createDataFrame(rows, "id string, title string, content string, contents string, PMID bigint")
    # records 1 and 2 hold the same words; 5 and 6 are both empty after cleaning
    assert tuple(reports.stage_counts(raw).first()) == (6, 4, 2)
    assert tuple(reports.stage_counts(raw.limit(0)).first()) == (0, 0, 0)


@pytest.mark.parametrize(("buckets", "first"), [(1 << 18, 64), (4, 1), (64, 3), (1, 1)])
def test_top_values_are_exact_for_any_buckets(spark, buckets, first):
    """Also with ties everywhere, and where the most frequent value shares a bucket with many rare ones."""
    import random
    from collections import Counter

    rng = random.Random(buckets)
    common = [f"c{i}" for i in range(30) for _ in range(40 - i // 3)]
    for values in (common + [f"r{i}" for i in range(2000)], [f"t{i}" for i in range(500)], ["a", "b"], [None], []):
        rng.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v string")
        counts = Counter(v for v in values if v is not None)
        wanted = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:10]
        assert [tuple(r) for r in stats.top_values(df, "v", 10, buckets, first).collect()] == wanted


def test_few_values_are_counted_exactly(spark, monkeypatch):
    """The second pass counts the values of the fullest buckets only."""
    df = spark.range(200_000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 40).otherwise(F.col("id")).cast("string").alias("v"))
    asked = []
    counted = stats._counted
    monkeypatch.setattr(
        stats, "_counted", lambda hashed, b, *rest: (asked.append(hashed.join(b, "_bucket").select("v").distinct().count()), counted(hashed, b, *rest))[1]
    )
    stats.top_values(df, "v", 10)
    assert len(asked) == 1 and asked[0] < 400
