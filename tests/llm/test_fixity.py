import hashlib
import random
from collections import Counter

import pytest

from tamis.llm import fixity

SCHEMA = "key long, record string"


def placed(rows):
    """Places and hashes of the records of one replica."""
    hashed = [(k, r, hashlib.sha256(r.encode()).hexdigest()) for k, r in rows]
    out, at = [], 0
    for position, (k, r, h) in enumerate(sorted(hashed, key=lambda x: (x[0] is not None, x[0] or 0, x[2]))):
        size = len(r.encode())
        out.append((k, position, at, at + size, h))
        at += size
    return out


def wanted(one, two):
    """By the definition: within a key, equal records cancel out, then differing ones are paired in order."""
    a, b = placed(one), placed(two)
    out = []
    for key in {r[0] for r in a + b}:
        mine, theirs = ([r for r in t if r[0] == key] for t in (a, b))
        spare = []
        for rows, others in ((mine, theirs), (theirs, mine)):
            there, left = Counter(r[4] for r in others), []
            for r in rows:
                there[r[4]] -= 1
                if there[r[4]] < 0:
                    left.append(r)
            spare.append(left)
        lost, gained = spare
        out += [(*r, "intact") for r in mine if r not in lost]
        out += [(*r, "corrupt" if i < len(gained) else "missing") for i, r in enumerate(lost)]
        out += [(*r, "extra") for r in gained[len(lost) :]]
    return sorted(out, key=repr)


def audit(spark, one, two, fanout=3, schema=SCHEMA):
    frames = [spark.createDataFrame(x, schema).repartition(3) for x in (one, two)]
    return sorted((tuple(r) for r in fixity.audit(*frames, fanout=fanout).collect()), key=repr)


@pytest.mark.parametrize("fanout", [4, 256])
def test_every_kind_of_damage_is_located(spark, fanout):
    rng = random.Random(fanout)
    rows = [(k * k - 40, f"récord {k} " + "x" * rng.randrange(40)) for k in range(50)]
    hurt = []
    for i, (k, r) in enumerate(rows):
        if i in (0, 17):
            hurt.append((k, r.replace("r", "y", 1)))  # same length
        elif i == 20:
            hurt.append((k, r[3:]))
        elif i == 21:
            hurt.append((k, r + " and more"))
        elif i == 30:
            hurt += [(k, r), (k, r)]
        elif i == 40:
            hurt += [(k, r), (k + 1, "between")]
        elif i != 5:
            hurt.append((k, r))
    found = audit(spark, rows, hurt, fanout)
    assert found == wanted(rows, hurt)
    assert Counter(r[-1] for r in found) == {"intact": 45, "corrupt": 4, "missing": 1, "extra": 2}
    assert {r[0] for r in found if r[-1] == "missing"} == {5 * 5 - 40}  # the lost one, and not those behind it
    assert {r[-1] for r in audit(spark, rows, rows, fanout)} == {"intact"}


def test_random_replicas(spark):
    rng = random.Random(4)
    for _ in range(2):
        make = lambda n: [(rng.choice([None, *range(-3, 9), 10**15]), rng.choice(["a", "b", "cc", "", "d" * 9])) for _ in range(n)]
        one, two = make(40), make(30)
        assert audit(spark, one, two, 1 << 16) == wanted(one, two)


def test_empty_replicas(spark):
    rows = [(k, f"record {k}") for k in range(20)]
    for one, two in ((rows, rows[:13]), (rows[:4], rows), (rows, []), ([], rows), ([], [])):
        assert audit(spark, one, two) == wanted(one, two)


def test_keys_that_are_no_numbers(spark):
    rows = [(f"https://h/{k}", f"record {k}") for k in range(30)] + [(None, "x")]
    hurt = [(k, r + "!" if r == "record 7" else r) for k, r in rows if r != "record 9"]
    found = {r[0]: r[-1] for r in audit(spark, rows, hurt, 16, "key string, record string")}
    assert found == {k: {"record 7": "corrupt", "record 9": "missing"}.get(r, "intact") for k, r in rows}


def test_nulls_ties_and_repeats(spark):
    pages = [(None, None, None, 1), (1, "u", "", 1), (1, "u", "", 1), (1, "v", "b", 2), (2, None, "x" * 100_000, 3)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, key int")
    records = fixity.warc_records(df)
    assert records.columns == ["key", "record"] and records.filter("record is null").isEmpty()
    rows = [tuple(r) for r in records.collect()]
    assert audit(spark, rows, list(reversed(rows)), 2) == wanted(rows, rows)
    assert audit(spark, rows, rows[1:4], 2) == wanted(rows, rows[1:4])


def test_only_differing_branches_are_compared(spark, monkeypatch):
    rows = [(k, f"record {k}") for k in range(64)]
    hurt = [(k, r + "!") if k == 63 else (k, r) for k, r in rows if k != 20]
    ours, theirs = (fixity.placed_records(spark.createDataFrame(x, SCHEMA)) for x in (rows, hurt))
    height = fixity.height_for([ours, theirs], 4)
    trees = [fixity.merkle_tree(fixity.leaves(t), height, 4) for t in (ours, theirs)]
    assert [level.count() for level in trees[0]] == [64, 16, 4, 1]
    sizes = []
    stage = fixity.stage_table
    monkeypatch.setattr(fixity, "stage_table", lambda df, name: (table := stage(df, name), sizes.append(table.count()))[0])
    assert {r.node for r in fixity.damaged(*trees, 4).collect()} == {20, 63}
    assert sizes == [1, 2, 2, 2]
