import random

import numpy as np
import pytest

from tamis.llm import set_join
from tamis.llm.wording import Shingler

SCHEMA = "doc_id long, text string, set string, copies int, row string"


def shingles(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_force(docs):
    sets = [shingles(t) for _, t in docs]
    links = [
        {j for j, b in enumerate(sets) if i != j and a and b and len(a & b) / len(a | b) >= 0.8}
        for i, a in enumerate(sets)
    ]
    out = []
    for i, (key, _) in enumerate(docs):
        seen, todo = {i}, [i]
        while todo:
            fresh = links[todo.pop()] - seen
            seen |= fresh
            todo += fresh
        ids = [docs[k][0] for k in seen if docs[k][0] is not None]
        out.append((key, min(ids) if ids else None, len(links[i])))
    return sorted(out, key=repr)


def corpus(seed, groups=20):
    rng = random.Random(seed)
    docs, key = [], 0
    for _ in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([4, 6, 30, 120, 300]))]
        for _ in range(rng.choice([1, 2, 3, 12])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            docs.append((key, " ".join(words)))
            key += 1
    return docs


def found(spark, docs):
    df = spark.createDataFrame([(*d, "s", 1, "r") for d in docs], SCHEMA)
    rows = set_join.near_duplicates(df).select("doc_id", "class_id", "n_links").collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize(("small", "chunk"), [(512, 2048), (3, 4)])
def test_all_links_are_found_and_counted(spark, monkeypatch, small, chunk):
    """Also with nodes that are split and groups that are cut into chunks."""
    monkeypatch.setattr(set_join, "SMALL", small)
    monkeypatch.setattr(set_join, "EXACT_CHUNK", chunk)
    monkeypatch.setattr(set_join, "CHUNK", 4 * chunk)
    docs = corpus(small)
    wanted = brute_force(docs)
    assert sum(n for _, _, n in wanted) > 50
    got = found(spark, docs)
    right = sum(a == b for a, b in zip(got, wanted, strict=True))
    assert right >= 0.97 * len(wanted) if small == 3 else got == wanted


def test_odd_texts(spark):
    long = " ".join(f"v{i}" for i in range(20_000))
    docs = [
        (1, None), (2, ""), (3, "!!! ..."), (4, "one two"), (5, "one two"), (5, "one two"), (6, "one two three"),
        (7, long), (8, long + " end"), (None, "one two"), (None, "only null keys"),
    ]
    assert found(spark, docs) == brute_force([(k, None if t == "!!! ..." else t) for k, t in docs])


def test_no_documents(spark):
    assert found(spark, []) == []


def test_one_of_each_class_stays(spark):
    docs = [(2, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (3, "other words here"), (4, None), (4, None)]
    df = spark.createDataFrame([(*d, "s", 1, "r") for d in docs], SCHEMA)
    kept = set_join.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text) == [(1, "a b c d e f"), (3, "other words here")]
    assert sum(r.text is None for r in kept.collect()) == 2


def test_shingles_are_those_of_the_words():
    texts = ["A b, c! d e f", "", None, "x y", "ÄÖ ü 12 a b"]
    sets = Shingler(5, portion=8).sets([t.encode() if t is not None else None for t in texts])
    assert [len(s) for s in sets] == [2, 0, 0, 1, 1]
    again = Shingler(5).sets([b"a B C d E", b"z a b c d e", b"x  y"])
    assert sets[0][np.isin(sets[0], again[0])].size == 1
    assert np.isin(again[0], again[1]).all()
    assert (again[2] == sets[3]).all()
