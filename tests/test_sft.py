import hashlib
import math

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tamis.operators import chat, sft
from tamis.functions.tokens import tokenize


@pytest.mark.parametrize(("n", "expected"), [(0, 0), (1, 1), (999, 1), (1000, 1), (1001, 2), (30000, 30)])
def test_split_sizes(spark, n, expected):
    ids = spark.range(n).select(F.col("id").cast("string").alias("id"))
    got = sft.train_test_split(ids)
    assert got.filter("split = 'test'").count() == expected
    assert got.filter("split = 'train'").count() == n - expected


def test_split_takes_the_smallest_hashes_however_the_rows_lie(spark):
    ids = [str(i) for i in range(5000)]
    order = sorted(ids, key=lambda i: (hashlib.md5(f"7:{i}".encode()).hexdigest(), i))
    wanted = set(order[: math.ceil(0.03 * 5000)])
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    for n in (1, 37):
        got = sft.train_test_split(df.repartition(n), test_size=0.03, seed=7)
        assert {r.id for r in got.filter("split = 'test'").collect()} == wanted


def test_examples(spark):
    df = spark.createDataFrame([("1", "Title", "Body")], "id string, title string, main_text string")
    row = sft.sft_format(df).first()
    assert row.input_text == (
        "### Instruction:\nSummarize the following biomedical abstract.\n\n### Abstract:\nBody\n\n### Summary:\n"
    )
    assert sft.sft_text(sft.sft_format(df)).first().text == row.input_text + "Title"


def test_examples_without_title_are_dropped_and_counted(spark):
    df = spark.createDataFrame([("1", "T", "B"), ("2", None, "B")], "id string, title string, main_text string")
    dropped = Observation()
    assert [r.id for r in sft.sft_text(sft.sft_format(df), dropped).collect()] == ["1"]
    assert dropped.get == {"n_without_target": 1}


def test_presets(spark):
    df = spark.createDataFrame([("q?",)], "body string")
    got = sft.render_prompts(df, "Do it", "body", "context_response").first().prompt
    assert got == "### Instruction:\nDo it\n\n### Context:\nq?\n\n### Response:\n"
    with pytest.raises(ValueError, match="unknown preset"):
        sft.prompt("x", F.col("body"), "other")


def test_token_budget(spark):
    df = spark.createDataFrame([("a b c",), ("a b",), ("",)], "text string")
    rows = sft.token_budget(df, max_tokens=3).collect()
    assert [r.tokens for r in rows] == [["<s>", "a", "b"], ["<s>", "a", "b"], ["<s>", ""]]
    assert [r.was_truncated for r in rows] == [True, False, False]
    assert [r.n_tokens for r in rows] == [3, 3, 2]


def test_token_budget_with_another_tokenizer(spark):
    df = spark.createDataFrame([("abcd",)], "text string")
    letters = sft.token_budget(df, max_tokens=4, bos="^", tokenizer=lambda c: F.split(c, ""))
    assert letters.first().tokens == ["^", "a", "b", "c"]
    assert tokenize(F.col("text")) is not None


MESSAGES = [
    (1, 2, "assistant", "fine"), (1, 0, "system", "be kind"), (1, 1, "user", "how?"),
    (2, 0, "user", "x"), (2, 1, "tool", "hidden"), (3, 0, "tool", "hidden"),
]


CHAT = "conv_id bigint, turn bigint, role string, text string"


def joined(rows):
    """Conversations put together in the documented order."""
    texts = {}
    for r in sorted(rows, key=lambda r: (r.turn is not None, r.turn or 0, r.segment)):
        texts[r.conv_id] = texts.get(r.conv_id, "") + r.segment
    return texts


def test_chat(spark):
    df = spark.createDataFrame(MESSAGES, CHAT)
    plain = joined(chat.chat_render(df).collect())
    assert plain == {
        1: "<|system|>\nbe kind</s>\n<|user|>\nhow?</s>\n<|assistant|>\nfine</s>\n",
        2: "<|user|>\nx</s>\n",
        3: "",
    }
    asked = joined(chat.chat_render(df, add_generation_prompt=True).collect())
    assert asked == {c: t + "<|assistant|>\n" for c, t in plain.items()}


@pytest.mark.parametrize(("first", "n"), [(0, 2000), (1000, 30)])
def test_chat_is_the_same_for_every_length(spark, first, n):
    messages = [(1, first + t, "user", str(t)) for t in range(n)]
    rows = chat.chat_render(spark.createDataFrame(messages, CHAT), add_generation_prompt=True).collect()
    assert len(rows) == n
    assert joined(rows) == {1: "".join(f"<|user|>\n{t}</s>\n" for t in range(n)) + "<|assistant|>\n"}


def test_chat_with_ties_and_null_turns(spark):
    messages = [(1, None, "user", "a"), (1, None, "user", "b"), (None, 3, "user", "c"), (None, 3, "user", "d")]
    rows = chat.chat_render(spark.createDataFrame(messages, CHAT), add_generation_prompt=True).collect()
    assert joined(rows) == {
        1: "<|user|>\na</s>\n<|user|>\nb</s>\n<|assistant|>\n",
        None: "<|user|>\nc</s>\n<|user|>\nd</s>\n<|assistant|>\n",
    }
