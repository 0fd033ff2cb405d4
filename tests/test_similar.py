"""The banded near-duplicate search against its definition and brute force."""

import hashlib
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tamis.functions import minhash
from tamis.operators import clusters, similar

SCHEMA = "id string, tokens array<string>"


def jaccard_distance(a, b):
    common = len(a & b)
    return 1 - common / (len(a) + len(b) - common)


def brute_force(docs, max_distance=0.1):
    sets = {i: set(t) for i, t in docs if t}
    return {
        (a, b): jaccard_distance(sets[a], sets[b])
        for a, b in combinations(sorted(sets), 2)
        if jaccard_distance(sets[a], sets[b]) <= max_distance
    }


def minima(words):
    hashes = {int(hashlib.md5(w.encode()).hexdigest()[:7], 16) for w in words}
    pairs = minhash.coefficient_pairs(similar.BANDS * similar.ROWS)
    return [min(((h + 1) * a + b) % minhash.PRIME for h in hashes) for a, b in pairs]


def leader_pairs(docs, max_distance=0.1):
    """The pairs by definition: each document with the similar leaders of its bands."""
    signed = {i: minima(t) for i, t in docs if t}
    sets = {i: set(t) for i, t in docs if t}
    leaders = {}
    for i, values in sorted(signed.items()):
        for k in range(similar.BANDS):
            leaders.setdefault((k, *values[k * similar.ROWS : (k + 1) * similar.ROWS]), i)
    found = {}
    for i, values in signed.items():
        for k in range(similar.BANDS):
            a = leaders[(k, *values[k * similar.ROWS : (k + 1) * similar.ROWS])]
            if a != i and jaccard_distance(sets[a], sets[i]) <= max_distance:
                found[a, i] = jaccard_distance(sets[a], sets[i])
    return found


def components(docs, pairs):
    root = {i: i for i, _ in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {(i, find(i)) for i in root}


def edited(rng, words, vocabulary, edits):
    words = set(words)
    for _ in range(edits):
        if rng.random() < 0.5 and len(words) > 1:
            words.discard(rng.choice(sorted(words)))
        else:
            words.add(rng.choice(vocabulary))
    return sorted(words)


def corpus(seed, n_groups=25, sizes=(1, 5, 9, 10, 12, 19, 20, 28, 40, 60, 90, 150)):
    """Groups of texts with few edits, half of them on shared boilerplate."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    boilerplate = [f"common{i}" for i in range(100)]
    docs = [("bare", []), ("blank", [""])]
    for g in range(n_groups):
        size = rng.choice(sizes)
        if g % 2:
            base = rng.sample(boilerplate, min(size, 100) * 3 // 4) + rng.sample(vocabulary, size // 4 + 1)
        else:
            base = rng.sample(vocabulary, size)
        for c in range(rng.randint(1, 9)):
            words = edited(rng, base, vocabulary, rng.randint(0, max(1, size // 9)))
            rng.shuffle(words)
            docs.append((f"{rng.randrange(10**6):06d}-{g}-{c}", words))
    return docs


@pytest.mark.parametrize(("seed", "max_distance"), [(1, 0.1), (2, 0.1), (7, 0.3)])
def test_pairs_are_the_similar_leaders(spark, seed, max_distance):
    docs = corpus(seed, n_groups=15)
    found = similar.near_dup_pairs(spark.createDataFrame(docs, SCHEMA), max_distance)
    wanted = leader_pairs(docs, max_distance)
    assert len(wanted) > 10
    assert {(r.id_a, r.id_b): r.distance for r in found.collect()} == wanted


def test_recall_at_similarity_of_nine_tenths(spark):
    """Of the pairs within 0.1, clusters hold nearly all together (370 of 374 when written).

    The rest are pairs whose bands have unlike leaders.
    """
    docs = corpus(5, n_groups=40)
    cluster = dict(clusters.dedupe_clusters(spark.createDataFrame(docs, SCHEMA)).collect())
    pairs = brute_force(docs)
    together = sum(cluster[a] == cluster[b] for a, b in pairs)
    assert len(pairs) > 50 and together >= 0.97 * len(pairs)


def test_clusters_merge_chains_and_keep_bare_documents(spark):
    words = [f"t{i}" for i in range(60)]
    chain = [(f"c{k}", words[k * 2 : k * 2 + 30]) for k in range(4)]
    docs = [*chain, ("e1", []), ("e2", []), ("n", None), ("x1", ["a", "b"]), ("x2", ["b", "a", "a"])]
    got = dict(clusters.dedupe_clusters(spark.createDataFrame(docs, SCHEMA)).collect())
    wanted = dict(components([(i, t) for i, t in docs], brute_force([(i, t or []) for i, t in docs])))
    assert got == wanted
    assert got["x2"] == "x1" and got["e1"] == "e1" and got["e2"] == "e2" and got["n"] == "n"
    close = [(f"c{k}", words[k : k + 30]) for k in range(5)]
    got = dict(clusters.dedupe_clusters(spark.createDataFrame(close, SCHEMA)).collect())
    assert set(got.values()) == {"c0"}


def test_survivors_are_stable(spark):
    docs = spark.createDataFrame(corpus(11, n_groups=10), SCHEMA)
    kept = clusters.keep_cluster_heads(docs, clusters.dedupe_clusters(docs))
    again = clusters.keep_cluster_heads(kept, clusters.dedupe_clusters(kept))
    ids = sorted(r.id for r in kept.collect())
    assert len(ids) == len(set(ids))
    assert sorted(r.id for r in again.collect()) == ids
    for n in (1, 37):
        spread = docs.repartition(n)
        other = clusters.keep_cluster_heads(spread, clusters.dedupe_clusters(spread))
        assert sorted(r.id for r in other.collect()) == ids


def on_one_template(rng, n):
    """A template of 200 words, half of the texts with 5 and half with 13 words replaced."""
    base = [f"t{i}" for i in range(200)]
    docs = []
    for i in range(n):
        words = list(base)
        for k in rng.sample(range(200), 5 if i % 2 else 13):
            words[k] = f"own{i}-{k}"
        docs.append((f"{i:05d}", words))
    return docs


def unlike_on_boilerplate(rng, n):
    """90 shared words and 12 own ones: no two texts are similar."""
    return [(f"{i:05d}", [f"b{k}" for k in range(90)] + [f"o{i}-{k}" for k in range(12)]) for i in range(n)]


@pytest.mark.parametrize("n", [1600, 6400])
@pytest.mark.parametrize("make", [on_one_template, unlike_on_boilerplate])
def test_comparisons_grow_with_the_documents(spark, monkeypatch, make, n):
    docs = make(random.Random(3), n)
    compared = []
    measure = similar.with_distance

    def counting(pairs, sets):
        compared.append(pairs.count())
        return measure(pairs, sets)

    monkeypatch.setattr(similar, "with_distance", counting)
    df = spark.createDataFrame(docs, SCHEMA).repartition(8)
    found = similar.similar_sets(similar.token_sets(df).sets)
    assert sum(compared) <= similar.BANDS * n
    if make is unlike_on_boilerplate:
        assert found.filter("a <> b").isEmpty()


def test_agrees_with_the_lsh_join_of_spark_ml(spark):
    """Spark ML's approximate join finds no pair that the exact search lacks."""
    from pyspark.ml.feature import HashingTF, MinHashLSH

    docs = [d for d in corpus(13, n_groups=12) if d[1]]
    df = spark.createDataFrame(docs, SCHEMA)
    features = HashingTF(inputCol="tokens", outputCol="features", numFeatures=1 << 18).transform(df)
    model = MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=5, seed=1).fit(features)
    joined = model.approxSimilarityJoin(features, features, 0.1 + 1e-9, "distance")
    approximate = {
        (r.a, r.b)
        for r in joined.select(F.col("datasetA.id").alias("a"), F.col("datasetB.id").alias("b")).collect()
        if r.a < r.b
    }
    exact = set(brute_force(docs))
    assert approximate <= exact
    assert len(approximate) >= 0.9 * len(exact)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    nodes = [f"n{i:03d}" for i in range(120)]
    edges = [tuple(rng.sample(nodes, 2)) for _ in range(70)]
    edges += list(zip(nodes[:40], nodes[1:41], strict=True))
    rng.shuffle(edges)
    got = clusters.connected_components(spark.createDataFrame(edges, "a string, b string"))
    touched = sorted({n for e in edges for n in e})
    assert {tuple(r) for r in got.collect()} == components([(n, None) for n in touched], edges)


def test_components_of_nothing(spark):
    assert clusters.connected_components(spark.createDataFrame([], "a string, b string")).isEmpty()


def on_templates(rng, n_groups=6):
    """Groups on shared templates whose members differ by about as many words as the distance allows."""
    docs = []
    for g in range(n_groups):
        base = [f"t{g}-{k}" for k in range(rng.choice((9, 10, 11, 19, 20, 40, 101)))]
        for i in range(14):
            words = list(base)
            for k in rng.sample(range(len(base)), rng.randint(0, max(1, len(base) // 10))):
                if rng.random() < 0.5:
                    words[k] = f"own{g}-{i}-{k % 3}"
                else:
                    words.append(f"more{g}-{k % 4}")
            docs.append((f"{rng.randrange(10**6):06d}-{g}-{i}", words))
    return docs


@pytest.mark.parametrize(
    ("docs", "max_distance"),
    [
        (corpus(5, n_groups=40), 0.1), (corpus(21, n_groups=20), 0.3), (corpus(22, n_groups=15), 0.0),
        (on_templates(random.Random(1)), 0.1), (on_templates(random.Random(2)), 0.2),
        (on_one_template(random.Random(3), 60), 0.1), (unlike_on_boilerplate(random.Random(3), 60), 0.1),
    ],
)
def test_every_pair_and_no_other_is_listed(spark, docs, max_distance):
    found = similar.all_pairs(spark.createDataFrame(docs, SCHEMA), max_distance).collect()
    wanted = brute_force(docs, max_distance + similar.EPSILON)
    assert {(r.id_a, r.id_b): r.distance for r in found} == wanted
    assert len(found) == len(wanted)
    got = dict(clusters.dedupe_clusters(spark.createDataFrame(docs, SCHEMA), max_distance).collect())
    assert got == dict(components(docs, wanted))


def test_pairs_below_unlike_leaders_are_linked(spark):
    """Two similar texts whose bands are all led by texts that are like neither are one cluster."""
    rng = random.Random(0)
    docs = []
    for name, n in [*((f"{i:04d}", 18) for i in range(100)), ("x1", 5), ("x2", 5)]:
        words = [f"t{k}" for k in range(200)]
        for k in rng.sample(range(200), n):
            words[k] = f"own-{name}-{k}"
        docs.append((name, words))
    wanted = brute_force(docs, 0.1 + similar.EPSILON)
    assert list(wanted) == [("x1", "x2")] and leader_pairs(docs) == {}
    got = dict(clusters.dedupe_clusters(spark.createDataFrame(docs, SCHEMA)).collect())
    assert got["x2"] == "x1" and got == dict(components(docs, wanted))
    df = spark.createDataFrame(docs, SCHEMA)
    kept = clusters.keep_cluster_heads(df, clusters.dedupe_clusters(df))
    assert sorted(r.id for r in kept.collect()) == sorted({*got} - {"x2"})


def test_a_text_without_an_id_hides_no_pair(spark):
    words = [f"w{k}" for k in range(30)]
    docs = [(None, words), ("a", words), ("b", [*words, "more"]), ("c", ["x"])]
    found = similar.all_pairs(spark.createDataFrame(docs, SCHEMA)).collect()
    assert [(r.id_a, r.id_b) for r in found] == [("a", "b")]


def test_groups_of_one_root_are_not_compared(spark):
    """On a template corpus few pairs are left for the links between the groups that leaders made."""
    docs = [d for i, d in enumerate(on_one_template(random.Random(3), 800)) if i % 2]
    sets = similar.token_sets(spark.createDataFrame(docs, SCHEMA)).sets
    keyed = similar.part_keys(sets)
    roots = sets.select("rep", F.lit("00000").alias("root"))
    assert similar.candidates(keyed, roots).isEmpty()
    assert similar.candidates(keyed).count() == 400 * 399 // 2
