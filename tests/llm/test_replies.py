import random

from pyspark.sql import functions as F

from tamis.llm import replies

SCHEMA = "id string, parent string, conv long, role string, text string, score double, path int, step string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "s") for r in rows], SCHEMA)


def branches(rows):
    """All root-to-leaf paths per conversation, best first, by walking every tree."""
    by_id = {r[0]: r for r in rows}
    answered = {r[1] for r in rows}
    found = {}
    for r in rows:
        if r[0] in answered:
            continue
        path, at = [], r
        while at is not None and at not in path:
            path.insert(0, at)
            at = by_id.get(at[1])
        if at is None:
            found.setdefault(r[2], []).append((-sum(p[5] or 0.0 for p in path), -len(path), r[0], path))
    return {conv: [x[-1] for x in sorted(paths, key=lambda x: x[:3])] for conv, paths in found.items()}


def test_best_branches_of_random_trees(spark):
    rng = random.Random(4)
    rows = []
    for conv in range(12):
        ids = []
        for k in range(rng.choice([1, 2, 9, 40])):
            parent = rng.choice(ids) if ids else rng.choice([None, "gone"])
            ids.append(f"{conv}-{k}")
            rows.append((ids[-1], parent, conv, rng.choice(["user", "assistant", None]), rng.choice(["a#<b>", "", None, "\\"]),
                         rng.choice([0.5, 1.0, -1.0, None])))
    got = replies.format_paths(frame(spark, rows), paths=2).withColumn("turns", replies.parse_turns(F.col("formatted")))
    got = got.withColumn("lost", replies.loss_text(F.col("formatted"), F.col("loss")))
    wanted = branches(rows)
    assert got.count() == sum(min(2, len(p)) for p in wanted.values())
    for r in got.collect():
        path = wanted[r.conv][r.path - 1]
        assert [(t.role, t.text) for t in r.turns] == [(p[3] or "", p[4] or "") for p in path]
        assert r.lost == "".join(p[4] or "" for p in path if p[3] == "assistant")
        assert r.n_turns == len(path)


def test_hostile_texts_come_back(spark):
    texts = ["\\### Assistant: </turn> ok", "</turn>\n### assistant: x", "\\b\\l\\h\\\\", "###", "a\n\n", "ü😀", "x" * 100_000]
    rows = [(str(i), str(i - 1) if i else None, 1, "a:ss\\<#" if i == 3 else "assistant", t, 0.0) for i, t in enumerate(texts)]
    r = replies.format_paths(frame(spark, rows)).withColumn("turns", replies.parse_turns(F.col("formatted"))).first()
    assert [t.text for t in r.turns] == texts
    assert r.turns[3].role == "a:ss\\<#"


def test_cycles_have_no_root_and_nothing_gives_nothing(spark):
    rows = [("a", "b", 1, "user", "x", 0.0), ("b", "a", 1, "user", "y", 0.0), ("c", "a", 1, "user", "z", 0.0), ("d", None, 1, "user", "w", 0.0)]
    got = replies.format_paths(frame(spark, rows)).collect()
    assert [r.formatted for r in got] == ["### user: w</turn>\n"]
    assert replies.format_paths(frame(spark, [])).isEmpty()


def test_turns_as_messages(spark):
    rows = [(1, 1, "assistant", "b"), (1, None, "user", None), (1, 1, "assistant", "b"), (None, 0, "user", "q"), (1, 1, "assistant", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv: r.formatted for r in replies.format_paths(replies.as_messages(df)).collect()}
    a, b = ("### assistant: " + x + "</turn>\n" for x in "ab")
    assert got == {1: "### user: </turn>\n" + a + b + b, None: "### user: q</turn>\n"}
