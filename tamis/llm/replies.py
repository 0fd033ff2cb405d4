"""Chat formatting of reply trees, in DataFrame expressions only.

Messages point to the message they answer. Root-to-leaf paths are found by iterative
self-joins that double the distance each round, ranked by score, and each chosen path is
written as one conversation. Turns are marked ``### role: text</turn>``; inside roles and
texts the control characters are escaped, so that a marker can only be a marker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.sources.staging import stage_table

END = "</turn>\n"
#: Escapes, in order of application; undone in reverse order.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"))


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def jumps(messages: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Jump tables and ``(id, depth, total)`` of every message that has a root above it.

    Table k is ``(id, up)``: the message 2^k steps above. A parent that is not there counts as
    none. Messages on or below a cycle of parents never reach a root and are left out. Only
    messages that have not reached their root take part in the next round.
    """
    known = messages.select(F.col("id").alias("known"))
    state = messages.select("id", "parent", "score").join(known, F.col("parent") == F.col("known"), "left")
    state = stage_table(
        state.select("id", F.col("known").alias("up"), F.lit(1).cast("long").alias("depth"),
                     F.coalesce("score", F.lit(0.0)).cast("double").alias("total")), "jump-0",
    )
    reached, open_ = state.filter("up is null"), state.filter("up is not null")
    tables, limit = [], max(1, state.count()).bit_length() + 1
    while not open_.isEmpty() and len(tables) < limit:
        tables.append(open_.select("id", "up"))
        above = reached.unionByName(open_).select(
            F.col("id").alias("up"), F.col("up").alias("far"),
            F.col("depth").alias("more"), F.col("total").alias("gain"),
        )
        step = open_.join(above, "up")
        state = stage_table(
            step.select(
                "id", F.col("far").alias("up"),
                (F.col("depth") + F.col("more")).alias("depth"), (F.col("total") + F.col("gain")).alias("total"),
            ),
            f"jump-{len(tables)}",
        )
        reached, open_ = reached.unionByName(state.filter("up is null")), state.filter("up is not null")
    return tables, reached.drop("up")


def best_paths(messages: DataFrame, paths: int = 1) -> DataFrame:
    """``(conv, path, id, step)``: the messages of the ``paths`` best branches per conversation.

    Branches are ranked by the sum of their scores, then length, then id of the leaf.
    ``step`` counts from the root.
    """
    tables, reached = jumps(messages)
    answered = messages.select(F.col("parent").alias("id")).distinct()
    leaf = reached.join(answered, "id", "left_anti").join(messages.select("id", "conv"), "id")
    order = Window.partitionBy("conv").orderBy(F.desc("total"), F.desc("depth"), "id")
    chosen = leaf.withColumn("path", F.row_number().over(order)).filter(F.col("path") <= paths)
    walk = stage_table(chosen.select("conv", "path", "id", F.col("depth").alias("step")), "walk")
    for k in reversed(range(len(tables))):
        up = walk.join(tables[k], "id").select("conv", "path", F.col("up").alias("id"), F.col("step") - F.lit(2**k))
        walk = stage_table(walk.union(up), f"walk-{k}")
    return walk


def format_paths(messages: DataFrame, paths: int = 1) -> DataFrame:
    """``(conv, path, n_turns, formatted, loss)``, one row per chosen branch.

    ``messages`` has ``id, parent, conv, role, text, score``; ids are unique. ``loss`` holds
    the half-open code-point spans of the assistants' texts, which training scores. Null
    roles and texts are empty, null scores zero, null conversations one conversation; further
    columns are ignored; no messages give no rows.
    """
    walk = best_paths(messages, paths)
    role, text = (escape(F.coalesce(F.col(c), F.lit(""))) for c in ("role", "text"))
    role = F.replace(role, F.lit(":"), F.lit("\\c"))
    head = F.concat(F.lit("### "), role, F.lit(": "))
    said = walk.join(messages.select("id", "role", "text"), "id").select(
        "conv", "path", "step", (F.col("role") == "assistant").alias("scored"),
        F.char_length(head).alias("lead"), F.concat(head, text, F.lit(END)).alias("said"),
    )
    upto = Window.partitionBy("conv", "path").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.char_length("said").cast("long")).over(upto)
    said = said.withColumn("end", end - F.lit(len(END)))
    start = F.col("end") + len(END) - F.char_length("said") + F.col("lead")
    turn = F.struct("step", "said", F.when(F.col("scored"), F.struct(start.alias("start"), F.col("end"))).alias("loss"))
    turns = F.sort_array(F.collect_list(turn))
    return (
        said.groupBy("conv", "path")
        .agg(turns.alias("turns"))
        .select(
            "conv", "path", F.size("turns").cast("long").alias("n_turns"),
            F.array_join(F.transform("turns", lambda t: t["said"]), "").alias("formatted"),
            F.filter(F.transform("turns", lambda t: t["loss"]), lambda s: s.isNotNull()).alias("loss"),
        )
    )


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as ``array<struct<role, text>>``."""
    parts = F.filter(F.split(formatted, END), lambda t: t != "")

    def turn(part: Column) -> Column:
        role = F.substring_index(F.substr(part, F.lit(5)), ":", 1)
        text = F.substr(part, F.char_length(role) + F.lit(7))
        return F.struct(
            unescape(F.replace(role, F.lit("\\c"), F.lit(":"))).alias("role"), unescape(text).alias("text")
        )

    return F.transform(parts, turn)


def loss_text(formatted: Column, loss: Column) -> Column:
    """What the loss mask covers, unescaped and joined."""
    return F.array_join(
        F.transform(
            loss,
            lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))),
        ),
        "",
    )


def as_messages(conversations: DataFrame) -> DataFrame:
    """Rows of ``(conv_id, turn, role, text)`` as trees: every turn answers the one before it.

    Turns are ordered by number (null first), then role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = conversations.select("conv_id", "turn", "role", "text", F.row_number().over(order).alias("n"))
    name = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    return numbered.select(
        F.concat(name, F.lit("/"), "n").alias("id"),
        F.when(F.col("n") > 1, F.concat(name, F.lit("/"), F.col("n") - 1)).alias("parent"),
        F.col("conv_id").alias("conv"), "role", "text", F.lit(0.0).alias("score"),
    )
