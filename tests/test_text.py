from pyspark.sql import functions as F

from tamis.functions import text as X
from tamis.operators import clean, reports

RAW = "id string, title string, content string, contents string, PMID bigint"


def cleaned(spark, rows):
    return {r.id: r.main_text for r in clean.clean_stage(spark.createDataFrame(rows, RAW)).collect()}


def one(spark, function, value):
    df = spark.createDataFrame([(value,)], "t string")
    return df.select(function(F.col("t")).alias("x")).first().x


def test_cleaning_steps_in_order(spark):
    text = "a Abstract b [1] c [2-3] [4, 5] [ 6 ] Abstraction abstract d"
    assert one(spark, X.clean_text, text) == "a  b c [4, 5] ion abstract d"


def test_single_steps(spark):
    assert one(spark, X.strip_citations, "x[1]y[ 2-3 ]z[4, 5][a]") == "x y z[4, 5][a]"
    assert one(spark, X.squeeze_whitespace, "a\nb \n c\t\td") == "a\nb c d"
    assert one(spark, X.strip_label, "Abstract abstract Abstraction") == " abstract ion"
    assert one(spark, X.clean_text, None) is None


def test_choice_and_length_filter(spark):
    rows = [
        ("long", "t", "c" * 51, "other", 1),
        ("short", "t", "c" * 50, "o" * 60, 2),
        ("null", "t", None, "o" * 60, 3),
        ("gone", "t", "c" * 50, None, 4),
        ("blank", "t", " " * 60, "o" * 60, 5),
        ("fifty", "t", None, " " + "o" * 50 + " ", 6),
    ]
    assert cleaned(spark, rows) == {"long": "c" * 51, "short": "o" * 60, "null": "o" * 60}


def test_text_can_be_empty_after_cleaning(spark):
    rows = [("a", "t", "[1]" * 17, None, 1), ("b", "t", "word " * 20, None, 2)]
    assert cleaned(spark, rows)["a"] == ""
    report = reports.clean_report(clean.clean_stage(spark.createDataFrame(rows, RAW))).first()
    assert tuple(report) == (2, 1, 1)


def test_pmid_becomes_a_string(spark):
    df = clean.clean_stage(spark.createDataFrame([("a", "t", "x" * 60, None, 7)], RAW))
    assert df.columns == ["id", "title", "PMID", "main_text"]
    assert df.first().PMID == "7"
