import hashlib
import random
import zlib

import numpy as np
import pytest

from tamis.llm import periodic, queries

SCHEMA = "doc_id long, text string, key string, runs int"


def brute_force(words):
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    row, runs = np.array([numbers[w] for w in words], np.int64), []
    for q in range(1, len(row) // 3 + 1):
        equal = np.concatenate(([0], row[q:] == row[:-q], [0])).astype(np.int8)
        starts, ends = np.flatnonzero(np.diff(equal) == 1), np.flatnonzero(np.diff(equal) == -1)
        for s, e in zip(starts.tolist(), (ends + q).tolist(), strict=True):
            if e - s >= max(24, 3 * q) and not any((row[s : e - p] == row[s + p : e]).all() for p in range(1, q)):
                runs.append((s, e - s, q))
    return sorted(runs)


def collapsed(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in dropped]


def noisy(rng):
    n = rng.choice([0, 3, 23, 24, 25, 60, 150, 500])
    words = [str(rng.randrange(rng.choice([1, 2, 3, 10, 1000]))) for _ in range(n)]
    for _ in range(rng.randint(0, 4) if n > 5 else 0):
        a = rng.randrange(n)
        q, length = rng.randint(1, max(1, (n - a) // 3)), rng.randint(1, n - a)
        for i in range(a, a + length):
            words[i] = words[a + (i - a) % q]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_are_those_of_brute_force(seed):
    rng = random.Random(seed)
    docs = [noisy(rng) for _ in range(150)]
    for i in range(0, 150, 7):
        texts = [" ".join(words).encode() for words in docs[i : i + 7]]
        for (split, runs), words in zip(periodic.document_runs(texts), docs[i : i + 7], strict=True):
            assert runs == brute_force(words)
            assert [w.decode() for w in periodic.without_repeats(split, runs)] == collapsed(words, runs)


@pytest.mark.parametrize("period", [1, 7, 8, 9, 15, 16, 17, 31, 32, 63, 64, 65, 200])
def test_every_period_and_phase(period):
    rng = random.Random(period)
    for shift in range(0, 40, 3):
        unit = [str(x) for x in rng.sample(range(10**6), period)]
        length = max(24, 3 * period)
        run = [unit[i % period] for i in range(length)]
        for words, found in ((run, [(shift, length, period)]), (run[:-1], [])):
            text = " ".join([f"a{i}" for i in range(shift)] + words + ["z"]).encode()
            assert next(iter(periodic.document_runs([text])))[1] == found


def test_the_transform_is_a_convolution():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, periodic.PRIME, (3, 16)).astype(np.uint64) for _ in range(2))
    product = periodic.transform(a) * periodic.transform(b) % periodic.MODULUS
    got = periodic.inverse(product)
    for k in range(3):
        for i in range(16):
            assert int(got[k, i]) == sum(int(a[k, j]) * int(b[k, (i - j) % 16]) for j in range(16)) % periodic.PRIME


def test_a_wrong_seed_is_refused():
    words = np.array([1, 2, 3, 4, 5, 6, 7, 8] * 3 + [9], np.int64)
    extender = periodic.Extender(words)
    assert extender.stretches(np.array([0]), np.array([7]), 8) == []
    assert extender.stretches(np.array([0]), np.array([8]), 8) == [(8, 0, 24)]
    assert extender.exactly(3, 8) == (0, 24)


def test_a_collision_of_prefix_sums_is_noticed(monkeypatch):
    """With sums that call everything equal, the words themselves still decide."""
    monkeypatch.setattr(periodic.Extender, "equal", lambda self, at, length, distance: np.ones(len(at), bool))
    words = [*"abcdefgh" * 4, "x", *"ij" * 20, "y", *"abcdefgh"]
    found = next(iter(periodic.document_runs([" ".join(words).encode()])))[1]
    assert found == brute_force(words) == [(0, 32, 8), (33, 40, 2)]


def test_one_word_many_times_costs_one_extension(monkeypatch):
    asked = []
    stretches = periodic.Extender.stretches
    monkeypatch.setattr(
        periodic.Extender, "stretches", lambda self, at, d, size: (asked.append(len(at)), stretches(self, at, d, size))[1]
    )
    assert next(iter(periodic.document_runs([b"a " * 30_000])))[1] == [(0, 30_000, 1)]
    assert sum(asked) < 30_000 * 3


def test_odd_texts(spark):
    loop = "x y z " * 20
    rows = [(1, None), (2, ""), (3, " \t\r\n\x0b\x0c "), (4, loop), (4, loop), (None, loop), (5, "é é " * 30), (6, "w " * 24), (7, "w " * 23)]
    df = spark.createDataFrame([(*r, "k", 0) for r in rows], SCHEMA)
    got = {(r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in periodic.find_runs(df).collect()}
    run = ((0, 60, 3),)
    assert got == {
        (1, 0, (), ""), (2, 0, (), ""), (3, 0, (), ""), (4, 60, run, "x y z"), (None, 60, run, "x y z"),
        (5, 30, ((0, 30, 1),), "é é"), (6, 24, ((0, 24, 1),), "w"), (7, 23, (), " ".join(["w"] * 23)),
    }
    assert periodic.find_runs(df).count() == len(rows)
    assert periodic.find_runs(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in queries.QUERIES["op13_periodic_runs"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for doc in docs:
        words = [w.decode() for w in (doc.text or "").encode().split()]
        n, h = len(words), zlib.crc32(str(doc.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute_force(words)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
        row = found[doc.doc_id]
        assert row.n_runs == len(runs)
        assert (row.start, row.length, row.period) == best
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == sha("".join(f"{s},{m},{q}\n" for s, m, q in runs))
        assert row.collapsed_sha256 == sha(" ".join(collapsed(words, runs)))
