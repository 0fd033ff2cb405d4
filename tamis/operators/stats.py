"""Corpus statistics over the final dataset.

Everything is first reduced by a hash aggregate with map-side combine; what
follows works on a token table cut to its top rows or on the table of distinct
document lengths, which the longest document bounds. The figures on lengths take
``lengths(id, text_length, token_count)``, so that no text is moved for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions.tokens import STOP_WORDS, exploded, ngrams
from tamis.operators.finalize import doc_lengths
from tamis.sources.staging import stage_scope, stage_table

# Rows of the token and n-gram reports, bins of the histogram.
TOP_TOKENS = 20
TOP_NGRAMS = 10
HISTOGRAM_BINS = 50

#: Buckets that values are counted by, and how many of the fullest are counted exactly at first.
BUCKETS, FIRST = 1 << 18, 64


def corpus_stats(lengths: DataFrame) -> DataFrame:
    return lengths.agg(F.count("id").alias("total_records"), F.avg("text_length").alias("mean_text_length"))


def length_metrics(lengths: DataFrame) -> DataFrame:
    return lengths.agg(
        F.count(F.lit(1)).alias("n_records"),
        F.avg("token_count").alias("mean_token_count"),
        F.avg("text_length").alias("mean_text_length"),
    )


def _counted(hashed: DataFrame, buckets: DataFrame, name: str, k: int) -> DataFrame:
    """The ``k`` most frequent values of the given buckets, counted exactly, stored."""
    inside = hashed.join(F.broadcast(buckets.select("_bucket")), "_bucket")  # a number per bucket at most
    counts = inside.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    return stage_table(counts.orderBy(F.desc("n"), F.asc(name)).limit(k), "top-values")


def top_values(values: DataFrame, name: str, k: int, buckets: int = BUCKETS, first: int = FIRST) -> DataFrame:
    """The ``k`` most frequent values; equal counts are ordered by the value.

    Exact, without a shuffle of all distinct values. Values are first counted by hash, a
    number per bucket. No value is more frequent than its bucket, so once ``k`` values of the
    fullest buckets are counted exactly, the least of these ``k`` counts rules out every bucket
    below it. Where other buckets reach that count, their values are counted too: with all
    counts alike that is every value, and the result is as exact.
    """
    present = values.filter(F.col(name).isNotNull())
    hashed = present.withColumn("_bucket", F.pmod(F.xxhash64(name), F.lit(buckets)))
    with stage_scope(values.sparkSession) as scope:
        sums = stage_table(hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")), "bucket-counts")
        top = _counted(hashed, sums.orderBy(F.desc("n"), "_bucket").limit(first), name, k)
        n, least = top.agg(F.count(F.lit(1)), F.min("n")).first()
        rivals = sums.filter(F.col("n") >= (least if n == k else 0))
        if rivals.count() > first:
            top = _counted(hashed, rivals, name, k)
        found = scope.keep(top, "top-values")
    return found.orderBy(F.desc("n"), F.asc(name)).limit(k)


def top_tokens(final: DataFrame, k: int = TOP_TOKENS) -> DataFrame:
    return top_values(final.select(exploded(F.col("tokens")).alias("token")), "token", k)


def top_ngrams(
    final: DataFrame, n: int = 2, k: int = TOP_NGRAMS, stop_words: tuple[str, ...] = STOP_WORDS
) -> DataFrame:
    return top_values(ngrams(final, "tokens", n, stop_words), "ngram", k)


def length_counts(lengths: DataFrame) -> DataFrame:
    """Documents per token count: one row per distinct length."""
    return lengths.groupBy("token_count").agg(F.count(F.lit(1)).alias("n"))


def token_histogram(lengths: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram of the token counts, with the count's logarithm.

    The largest value belongs to the last bin; equal extremes give bin 0.
    """
    counts = length_counts(lengths)
    bounds = counts.agg(
        F.struct(F.min("token_count").alias("lo"), F.max("token_count").alias("hi"))
    ).scalar()
    bounded = counts.withColumn("_b", bounds).select("token_count", "n", "_b.lo", "_b.hi")
    offset = (F.col("token_count") - F.col("lo")) * F.lit(bins) / (F.col("hi") - F.col("lo"))
    slot = F.when(F.col("hi") == F.col("lo"), 0).otherwise(
        F.least(F.lit(bins - 1), F.floor(offset).cast("int"))
    )
    return (
        bounded.groupBy(slot.alias("bin"), "lo", "hi")
        .agg(F.sum("n").alias("n_docs"))
        .select(
            "bin",
            (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / F.lit(bins)).alias("bin_start"),
            "n_docs",
            F.round(F.log10("n_docs"), 6).alias("log10_docs"),
        )
    )


def token_box_stats(lengths: DataFrame) -> DataFrame:
    """Quartiles, whiskers, outliers and axis cap of the token counts.

    Exact percentiles with linear interpolation, taken over the table of
    distinct lengths with their counts as weights. A whisker is the outermost
    value within one and a half interquartile ranges of the box.
    """
    counts = length_counts(lengths)
    marks = F.percentile(
        "token_count", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75), F.lit(0.99)), F.col("n")
    )
    q1, q3 = F.col("_q")[0], F.col("_q")[2]
    low, high = q1 - (q3 - q1) * 1.5, q3 + (q3 - q1) * 1.5
    inside = F.col("token_count").between(low, high)

    def mark(i: int) -> Column:
        return F.max(F.col("_q")[i])

    return counts.withColumn("_q", counts.agg(marks).scalar()).agg(
        mark(0).alias("q1"),
        mark(1).alias("median"),
        mark(2).alias("q3"),
        F.max(low).alias("lower_fence"),
        F.max(high).alias("upper_fence"),
        F.min(F.when(inside, F.col("token_count"))).alias("lower_whisker"),
        F.max(F.when(inside, F.col("token_count"))).alias("upper_whisker"),
        F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("n_outliers"),
        mark(3).alias("p99"),
        (mark(3) * 1.5).alias("axis_cap"),
    )


def analysis_report(final: DataFrame, k: int = TOP_TOKENS, lengths: DataFrame | None = None) -> DataFrame:
    """One row: records, mean text length to two decimals, top tokens in order.

    With ``lengths(id, text_length, ...)`` of the final records their texts are read for the
    tokens only.
    """
    top = top_tokens(final, k).agg(
        F.collect_list(F.struct(F.negative("n").alias("order"), "token", "n")).alias("top")
    )
    ordered = F.transform(
        F.array_sort("top"), lambda row: F.struct(row["token"].alias("token"), row["n"].alias("count"))
    )
    return corpus_stats(doc_lengths(final) if lengths is None else lengths).select(
        "total_records",
        F.round("mean_text_length", 2).alias("mean_text_length"),
        top.select(ordered).scalar().alias("top_tokens"),
    )
