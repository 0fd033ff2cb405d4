"""Fine-tuning examples: prompts, train/test split, token budget."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tamis.functions.tokens import tokenize
from tamis.sources.staging import stage_table

# Instruction, prompt headings, test share, token limit, first token.
SUMMARIZE = "Summarize the following biomedical abstract."
PRESETS = {
    "abstract_summary": ("Abstract", "Summary"),
    "question_answer": ("Question", "Answer"),
    "context_response": ("Context", "Response"),
}
TEST_SIZE = 0.001
MAX_TOKENS = 2048
BOS = "<s>"


def prompt(instruction: str | Column, body: Column, preset: str = "abstract_summary") -> Column:
    """Instruction, body and the heading that the model continues."""
    if preset not in PRESETS:
        raise ValueError(f"unknown preset {preset!r}; known: {sorted(PRESETS)}")
    given, wanted = PRESETS[preset]
    instruction = F.lit(instruction) if isinstance(instruction, str) else instruction
    return F.concat(
        F.lit("### Instruction:\n"), instruction,
        F.lit(f"\n\n### {given}:\n"), body,
        F.lit(f"\n\n### {wanted}:\n"),
    )


def render_prompts(
    df: DataFrame, instruction: str | Column, body: str, preset: str, output: str = "prompt"
) -> DataFrame:
    return df.withColumn(output, prompt(instruction, F.col(body), preset))


def sft_format(final: DataFrame, instruction: str = SUMMARIZE) -> DataFrame:
    """``id``, the prompt over ``main_text`` and the title as its target."""
    return final.select(
        "id",
        prompt(instruction, F.col("main_text")).alias("input_text"),
        F.col("title").alias("target_text"),
    )


def sft_text(examples: DataFrame, dropped: Observation | None = None) -> DataFrame:
    """Prompt and target as one training text.

    An example without a target cannot be trained on: it is dropped, and
    counted as ``n_without_target`` where an observation is given.
    """
    if dropped is not None:
        examples = examples.observe(
            dropped, F.count_if(F.col("target_text").isNull()).alias("n_without_target")
        )
    return examples.filter(F.col("target_text").isNotNull()).select(
        "id", F.concat("input_text", "target_text").alias("text")
    )


def count_without_target(examples: DataFrame) -> DataFrame:
    """One row: all examples, and those without a target, which ``sft_text`` drops."""
    return examples.agg(
        F.count(F.lit(1)).alias("n_examples"),
        F.count_if(F.col("target_text").isNull()).alias("n_without_target"),
    )


def split_cut(df: DataFrame, key: str, test_size: float, seed: int) -> DataFrame:
    """One row ``(hash, key)``: the last test row in the order of ``(md5(seed:key), key)``.

    Exact selection without a global sort. Rows are counted per four leading
    hash digits, then, where the cut falls, per four more; this leaves about
    one row in four billion to be ranked. Each histogram has at most 65,536 rows.
    """
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key)))
    keys = df.select(hashed.alias("hash"), F.col(key).alias("key"))
    keys = keys.withColumns({"d1": F.substring("hash", 1, 4), "d2": F.substring("hash", 5, 4)})
    keys = stage_table(keys, "split-keys")
    upto = Window.orderBy("digits").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()

    def where_it_falls(histogram: DataFrame) -> DataFrame:
        running = histogram.withColumn("_upto", F.sum("n").over(upto))
        return running.filter(
            (F.col("_upto") >= F.col("wanted")) & (F.col("_upto") - F.col("n") < F.col("wanted"))
        ).withColumn("wanted", F.col("wanted") - F.col("_upto") + F.col("n"))

    first = keys.groupBy(F.col("d1").alias("digits")).agg(F.count(F.lit(1)).alias("n"))
    wanted = F.ceil(F.sum("n").over(everything) * F.lit(test_size))
    first = where_it_falls(first.withColumn("wanted", wanted))
    first = F.broadcast(first.select(F.col("digits").alias("d1"), "wanted"))
    second = (
        keys.join(first, "d1")
        .groupBy("d1", "wanted", F.col("d2").alias("digits"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    second = where_it_falls(second)
    second = F.broadcast(second.select("d1", F.col("digits").alias("d2"), "wanted"))
    rank = F.row_number().over(Window.orderBy("hash", "key"))
    ranked = keys.join(second, ["d1", "d2"]).withColumn("_rank", rank)
    return ranked.filter(F.col("_rank") == F.col("wanted")).select("hash", "key")


def train_test_split(
    df: DataFrame, key: str = "id", test_size: float = TEST_SIZE, seed: int = 42
) -> DataFrame:
    """Append ``split``: exactly ``ceil(test_size * n)`` rows are ``test``.

    The choice depends on the seed and the keys only, not on partitioning.
    """
    cut = split_cut(df, key, test_size, seed).select(F.struct("hash", "key")).scalar()
    place = F.struct(
        F.md5(F.concat(F.lit(f"{seed}:"), F.col(key))).alias("hash"), F.col(key).alias("key")
    )
    return df.withColumn("split", F.when(place <= cut, "test").otherwise("train"))


def token_budget(
    df: DataFrame,
    column: str = "text",
    max_tokens: int = MAX_TOKENS,
    bos: str = BOS,
    tokenizer: Callable[[Column], Column] = tokenize,
) -> DataFrame:
    """Append ``tokens`` with a leading ``bos``, cut to ``max_tokens`` in all.

    ``tokenizer`` maps a text column to an array column; an Arrow UDF around a
    subword model fits as well as the built-in whitespace tokens.
    """
    return (
        df.withColumn("_all", tokenizer(F.col(column)))
        .withColumns({
            "tokens": F.concat(F.array(F.lit(bos)), F.slice("_all", 1, max_tokens - 1)),
            "was_truncated": F.size("_all") > max_tokens - 1,
        })
        .withColumn("n_tokens", F.size("tokens"))
        .drop("_all")
    )
