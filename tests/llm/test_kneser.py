import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tamis.llm import kneser
from tamis.sources.staging import stage_table

SCHEMA = "doc_id long, text string, lang string, n_tokens int, row string, block string"
LABELS = "doc_id long, quality int, toxic int, lang string"


def discounts(counts):
    n = [sum(c == i for c in counts) for i in range(5)]
    y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else None
    out = [0.0]
    for i in (1, 2, 3):
        d = i - (i + 1) * y * n[i + 1] / n[i] if y is not None and n[i] else 0.5
        out.append(min(max(d, 0.0), float(i)))
    return lambda c: out[min(c, 3)]


def brute_force(bigrams, size):
    """Interpolated modified Kneser-Ney by its formulas: a function of (previous, word)."""
    d = discounts(bigrams.values())
    before = Counter(w for _, w in bigrams)
    e = discounts(before.values())
    total, rest = sum(before.values()), sum(e(c) for c in before.values())
    continuation = {w: (c - e(c)) / total + rest / total / size for w, c in before.items()}
    contexts = defaultdict(dict)
    for (u, w), c in bigrams.items():
        contexts[u][w] = c

    def p(u, w):
        seen = contexts[u]
        back = sum(d(c) for c in seen.values()) / sum(seen.values())
        return (seen[w] - d(seen[w])) / sum(seen.values()) + back * continuation[w]

    return p


def test_the_tables_are_those_of_the_formulas(spark):
    rng = np.random.default_rng(1)
    pairs = Counter((int(a), int(b)) for a, b in rng.zipf(1.6, (4000, 2)) % 30)
    rows = [(lang << 32 | u << 16 | w, c * (lang + 1)) for lang in (0, 1) for (u, w), c in pairs.items()]
    sizes = spark.createDataFrame([(0, 40), (1, 40)], "lang long, size long")
    known, contexts, _ = kneser.train(spark.createDataFrame(rows, "key long, c long"), sizes)
    got = {r.key: r.logp for r in known.collect()}
    for lang in (0, 1):
        p = brute_force({k: c * (lang + 1) for k, c in pairs.items()}, 40)
        for u, w in pairs:
            assert got[lang << 32 | u << 16 | w] == pytest.approx(math.log(p(u, w)))
    assert contexts.filter("backoff < 0 or backoff > 1").isEmpty()


def corpus(n=300):
    rng = np.random.default_rng(7)
    common = ["the", "of", "and", "to", "in", "is", "it", "on"]
    docs, labels = [], []
    for k in range(n):
        bad = k % 10 == 0
        words = [
            (f"Qx{rng.integers(10**6)}%%" if bad else f"w{rng.integers(4000)}") if bad or rng.random() < 0.4 else rng.choice(common)
            for _ in range(rng.integers(60, 200))
        ]
        docs.append((k, " ".join(words), "en"))
        labels.append((k, 0 if bad else 1, 0))
    return docs, labels


def frames(spark, docs, labels):
    table = stage_table(spark.createDataFrame([(*d, 1, "r", "b") for d in docs], SCHEMA), "docs")
    return table, spark.createDataFrame([(*x, "zz") for x in labels], LABELS)


def test_bad_texts_are_rejected_and_good_ones_kept(spark):
    docs, labels = corpus()
    odd = [(1000, None, "en"), (1001, "", "en"), (1002, "word", "en"), (1003, "und so", "de"), (1004, "no language", None),
           (None, "no key at all", "en"), (1, docs[1][1], "en"), (1005, "x" * 200_000, "en")]
    table, marks = frames(spark, docs + odd, [*labels, (1000, None, None), (None, 1, 0)])
    rows = kneser.score(table, marks).collect()
    assert len(rows) == len(docs) + len(odd)
    rejected = {r.doc_id for r in rows if r.rejected}
    bad = {k for k, q, _ in labels if q == 0}
    assert len(rejected & bad) >= 0.9 * len(bad)
    assert len({r for r in rejected if r is not None and r < 1000} - bad) <= 0.03 * len(docs)
    assert not {1000, 1001, 1003, 1004} & rejected
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1000].n_tokens == 0 and by_id[1003].threshold is None
    kept = kneser.keep_good(table, marks)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in rows} - rejected


def test_without_documents_or_labels(spark):
    docs, labels = corpus(20)
    table, none = frames(spark, docs, [])
    assert kneser.score(table, none).filter("rejected").isEmpty()
    empty, marks = frames(spark, [], labels)
    assert kneser.score(empty, marks).isEmpty()


def test_blocks_ask_in_rounds(spark, monkeypatch):
    """A round stores the answers of its own blocks only; their number changes no result."""
    docs, labels = corpus(120)
    source = spark.createDataFrame([(*d, 1, "r", "b") for d in docs], SCHEMA).repartition(12)
    table, stored = stage_table(source, "docs"), []
    marks = spark.createDataFrame([(*x, "zz") for x in labels], LABELS)
    store = kneser.write_by_block

    def counted(answers, docs):
        if "backoff" not in answers.columns:
            stored.append({r.block for r in answers.select("block").distinct().collect()})
        return store(answers, docs)

    monkeypatch.setattr(kneser, "write_by_block", counted)
    found = [sorted(map(tuple, kneser.score(table, marks).drop("block").collect()))]
    assert len(stored) == kneser.ROUNDS and len(set.union(*stored)) == sum(map(len, stored))
    assert max(map(len, stored)) < len(set.union(*stored))
    monkeypatch.setattr(kneser, "ROUNDS", 1)
    found.append(sorted(map(tuple, kneser.score(table, marks).drop("block").collect())))
    assert len(found[0]) == 120
    for a, b in zip(*found, strict=True):
        assert a[:4] == b[:4] and a[4:6] == pytest.approx(b[4:6]) and a[6] == b[6]


def test_workers_hand_memory_back(monkeypatch):
    trimmed = []
    monkeypatch.setattr(kneser, "trim_memory", lambda: trimmed.append(1))
    batch = pa.RecordBatch.from_pydict({"block": [1], "lang": ["en"], "text": ["a b a b"]})
    (counts,) = kneser._train(iter([batch]))
    assert sorted(counts["c"].to_pylist()) == [1, 1, 2] and len(trimmed) == 1
    (asked,) = kneser._asker(None)(iter([batch]))
    assert asked.num_rows == 3 and len(trimmed) == 2  # two words and the start


def test_shapes():
    words = ["word,", "WORD!!", "Word", "wOrd", "42", "--", "a%%%", "A", "é"]
    assert [kneser.shape_of(w) for w in words] == [0, 1, 2, 3, 4, 6, 6, 2, 0]


def test_every_word_keeps_its_identity_at_any_size(spark):
    """A rare word seen in trusted text costs less than one of its shape that never was there."""
    docs, labels = corpus()
    filler = [(5000 + k, "the of and to in is it on " * 40, "en") for k in range(200)]
    docs = [(k, f"{text} the zanzibar" if k in (11, 12, 13, 14, 15, 16, 17) else text, "en") for k, text, _ in docs]
    asked = [(9000, "the zanzibar", "en"), (9001, "the zanzibor", "en")]
    table, marks = frames(spark, docs + filler + asked, [*labels, *((k, 1, 0) for k, _, _ in filler)])
    by_id = {r.doc_id: r.perplexity for r in kneser.score(table, marks).collect()}
    assert by_id[9000] < by_id[9001]
    assert kneser.Words().bigrams(["en"], ["a b"])[2].tolist() != kneser.Words().bigrams(["de"], ["a b"])[2].tolist()
