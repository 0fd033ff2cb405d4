"""Whitespace tokens and n-grams."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the characters that the Java regex class \s matches.
WHITESPACE = " \t\n\x0b\f\r"

# Fixed value: an n-gram that begins with one of these words is not counted.
STOP_WORDS = ("the", "a", "an", "is", "of", "and", "in", "to", "for", "with", "on")


def tokenize(text: Column) -> Column:
    """Lower-case and split at every single whitespace character.

    Leading and inner empty tokens are kept, trailing ones dropped: the result
    of Spark ML's ``Tokenizer`` without its UDF, and NULL for NULL instead of a
    failure. Only a text that ends in whitespace, which the cheap test for it
    finds, needs trimming before the split.
    """
    trailing = reduce(or_, [F.endswith(text, F.lit(c)) for c in WHITESPACE])
    blank = F.rtrim(text, F.lit(WHITESPACE)) == ""
    trimmed = F.rtrim(F.lower(text), F.lit(WHITESPACE))
    return F.when(
        trailing,
        F.when(blank, F.array().cast("array<string>")).otherwise(F.split(trimmed, r"\s")),
    ).otherwise(F.split(F.lower(text), r"\s"))


def exploded(values: Column) -> Column:
    """One row per array element, and one NULL row for an empty array.

    For arrays that are computed, not stored: for a plain ``explode`` the
    optimizer infers a filter on the array's size and computes the array twice.
    """
    return F.explode_outer(values)


def ngrams(
    df: DataFrame, tokens: str = "tokens", n: int = 2, stop_words: tuple[str, ...] = STOP_WORDS
) -> DataFrame:
    """All ``n``-grams of a token column as rows ``ngram``, words joined by one space.

    Grams holding an empty token, or led by a stop word, are left out. The array
    is zipped with itself shifted by one, two, ... words, so a row costs no
    function call per gram; the filter runs on the unfolded words.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    words = [f"_w{i}" for i in range(n)]
    shifted = [F.slice(tokens, i + 1, F.size(tokens)).alias(w) for i, w in enumerate(words)]
    rows = df.select(F.inline_outer(F.arrays_zip(*shifted)).alias(*words))
    full = reduce(and_, [F.col(w) != "" for w in words])
    if stop_words:
        full = full & ~F.col(words[0]).isin(*stop_words)
    return rows.filter(full).select(F.concat_ws(" ", *words).alias("ngram"))
