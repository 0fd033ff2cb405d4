import random
import re

import pytest

from tamis.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, items int, n_hit string"
ITEMS = "item_id long, text string, doc_id int"


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [(m[0], m.span()) for m in WORD.finditer(lower)]


def brute_force(text, items, width=10):
    said = words(text)
    hit, found = set(), set()
    for name, item in items:
        run = [w for w, _ in words(item)]
        size = min(width, len(run))
        for i in range(len(run) - size + 1) if run else ():
            for k in range(len(said) - size + 1):
                if [w for w, _ in said[k : k + size]] == run[i : i + size]:
                    hit |= set(range(k, k + size))
                    if name is not None:
                        found.add(str(name))
    spans = []
    for k in sorted(hit):
        a, b = said[k][1]
        if k - 1 in hit:
            spans[-1][1] = b
        else:
            spans.append([a, b])
    return len(said), len(hit), sorted(found), [tuple(s) for s in spans], bool(hit)


@pytest.mark.parametrize("piece", [500_000, 50])
def test_hits_and_spans(spark, monkeypatch, piece):
    """Also when the items need several automata."""
    monkeypatch.setattr(decontaminate, "PIECE_CHARS", piece)
    rng = random.Random(1)
    vocabulary = ["a", "B", "ça", "É", "x1", "Zz"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 9, 10, 14]))) for i in range(12)] + [(50, None), (51, "..."), (None, text(4)), (3, text(12))]
    docs = [(i, text(rng.choice([0, 5, 40]))) for i in range(30)]
    docs += [(100 + i, f"«{text(3)}» {items[i][1]} {text(3)}") for i in range(12)] + [(None, None), (7, items[2][1]), (7, items[2][1])]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], DOCS)
    got = decontaminate.find_items(df, spark.createDataFrame([(*b, 1) for b in items], ITEMS)).collect()
    assert len(got) == len(docs)
    wanted = sorted((d[0] is not None, d[0] or 0, *brute_force(d[1], items)) for d in docs)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_hit, r["items"], [tuple(s) for s in r.spans], r.contaminated) for r in got) == wanted


def test_long_texts_and_empty_tables(spark):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten", 1)], ITEMS)
    long = "word " * 200_000 + "One, TWO three four five six seven eight nine ten!"
    df = spark.createDataFrame([(1, long, 1, "x"), (2, "one two", 1, "x")], DOCS)
    got = {r.doc_id: (r.n_words, r.n_hit) for r in decontaminate.find_items(df, items).collect()}
    assert got == {1: (200_010, 10), 2: (2, 0)}
    clean = decontaminate.keep_clean(df, items)
    assert clean.columns == df.columns and [tuple(r) for r in clean.collect()] == [(2, "one two", 1, "x")]
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.find_items(df, none).filter("contaminated").isEmpty()
    assert decontaminate.find_items(spark.createDataFrame([], DOCS), items).isEmpty()
