import random

from pyspark.ml.feature import NGram, Tokenizer
from pyspark.sql import functions as F

from tamis.functions.tokens import ngrams, tokenize
from tamis.operators.finalize import doc_lengths, final_dataset


def test_edge_rows(spark):
    rows = [(" A  b\tC ",), ("",), ("\n",), (None,), (" \t\n",), ("a\n\n",), ("\x0bx",)]
    got = [r.t for r in spark.createDataFrame(rows, "s string").select(tokenize(F.col("s")).alias("t")).collect()]
    assert got == [["", "a", "", "b", "c"], [""], [], None, [], ["a"], ["", "x"]]


def test_equals_the_tokenizer_of_spark_ml(spark):
    rng = random.Random(1)
    alphabet = ["a", "B", "é", "Ü", "7", ".", " ", " ", " ", "\t", "\n", "\x0b", "\f", "\r"]
    rows = [("".join(rng.choices(alphabet, k=rng.randrange(14))),) for _ in range(3000)]
    df = Tokenizer(inputCol="s", outputCol="theirs").transform(spark.createDataFrame(rows, "s string"))
    differing = df.withColumn("ours", tokenize(F.col("s"))).filter("NOT ours <=> theirs")
    assert differing.collect() == []


def test_bigrams_skip_stop_words_and_empty_tokens(spark):
    df = spark.createDataFrame([(["the", "", "cat", "sat"],), ([],), (None,), (["one"],)], "tokens array<string>")
    assert [r.ngram for r in ngrams(df, n=2).collect()] == ["cat sat"]
    assert sorted(r.ngram for r in ngrams(df, n=1).collect()) == ["cat", "one", "sat"]
    assert ngrams(df, n=5).collect() == []


def test_ngrams_equal_spark_ml_without_the_filter(spark):
    rng = random.Random(2)
    rows = [([rng.choice("abcdef") * 2 for _ in range(rng.randrange(9))],) for _ in range(200)]
    df = spark.createDataFrame(rows, "tokens array<string>")
    for n in (2, 3, 4):
        theirs = NGram(n=n, inputCol="tokens", outputCol="g").transform(df)
        wanted = sorted(r.g for r in theirs.select(F.explode("g").alias("g")).collect())
        assert sorted(r.ngram for r in ngrams(df, n=n, stop_words=()).collect()) == wanted


def test_final_columns_and_lengths(spark):
    df = spark.createDataFrame([("1", None, "9", "Ünï  x")], "id string, title string, PMID string, main_text string")
    assert final_dataset(df).columns == ["id", "PMID", "title", "main_text", "tokens"]
    assert final_dataset(df, title_tokens=True).first().title_tokens is None
    assert tuple(doc_lengths(final_dataset(df)).first()) == ("1", 6, 3)
