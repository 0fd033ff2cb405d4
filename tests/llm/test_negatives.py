import numpy as np
import pytest
from pyspark.sql import functions as F

from tamis.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, row string, dims int, anchor string"


def brute_force(rows, anchors, positives=5, hard=3, band=(50, 95)):
    taken = [
        (i, np.floor(256 * np.array(v, np.float32).astype(np.float64)).astype(int).tolist(), label)
        for i, v, label in rows
        if None not in (i, label) and v and None not in v and np.isfinite(v).all()
    ]
    out = []
    for a, (i, v, label) in enumerate(taken):
        if not anchors(i):
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(v, w, strict=True)), j, other, b)
            for b, (j, w, other) in enumerate(taken) if len(w) == len(v)
        )
        for s, j, other, _ in [x for x in scored if x[2] == label and x[3] != a][:positives]:
            inside = [x for x in scored if x[2] != label and band[0] * -s <= 100 * -x[0] <= band[1] * -s]
            out += [(i, j, rank + 1, x[1], -s, -x[0]) for rank, x in enumerate(inside[:hard])]
    return sorted(out)


def mined(spark, rows, condition, **options):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    found = negatives.mine_negatives(df, condition, **options)
    assert found.dtypes == [
        ("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
        ("positive_score", "bigint"), ("negative_score", "bigint"),
    ]
    return sorted(map(tuple, found.collect()))


def random_rows(seed, n, dims):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dims))
    vectors = (centres[np.arange(n) % 4] + rng.normal(size=(n, dims)) * 0.8) / dims**0.5
    return [(k, vectors[k].astype(np.float32).tolist(), int(rng.integers(3))) for k in range(n)]


@pytest.mark.parametrize(("blocks", "dims"), [((8192, 16384), 16), ((3, 17), 13)])
def test_blocks_give_what_brute_force_gives(spark, blocks, dims):
    rows = random_rows(dims, 160, dims)
    rows += [(1000 + k, rows[k % 5][1], k % 3) for k in range(25)]  # equal vectors, equal scores
    wanted = brute_force(rows, lambda i: i % 10 == 0)
    assert wanted
    assert mined(spark, rows, F.col("vec_id") % 10 == 0, blocks=blocks) == wanted


def test_scores_are_inner_products():
    rng = np.random.default_rng(3)
    for low, high, dims in ((-200, 200, 64), (0, 5, 7), (-1, 1, 8), (-(1 << 27) + 1, 1 << 27, 64), (-128, 128, 1)):
        codes, anchor = rng.integers(low, high, (50, dims)), rng.integers(low, high, dims)
        got = negatives.scores(negatives.subset_sums(anchor), negatives.planes(codes))
        assert got.tolist() == [sum(int(x) * int(y) for x, y in zip(c, anchor, strict=True)) for c in codes]


def test_tables_hold_all_subsets():
    anchor = np.array([3, -5, 7, 11, -13, 17, 19, -23, 29])
    sums = negatives.subset_sums(anchor)
    assert sums.shape == (2, 256)
    assert all(sums[0, m] == sum(anchor[k] for k in range(8) if m >> k & 1) for m in range(256))
    assert sums[1, 1] == 29 and sums[1, 2] == 0


def test_odd_rows_take_no_part(spark):
    good = [1.0, 0.5]
    rows = [
        (0, good, 1), (1, good, 1), (2, [0.8, 0.4], 2), (3, None, 2), (4, [], 2), (5, [None, 1.0], 2), (6, [float("nan"), 1.0], 2),
        (7, [float("inf"), 1.0], 2), (8, [0.7, 0.4], None), (None, [0.7, 0.4], 2), (9, [0.8, 0.4, 0.0], 2), (10, [0.0, 0.0], 1),
        (2, [0.8, 0.4], 2), (0, good, 1),
    ]
    assert mined(spark, rows, F.col("vec_id") == 0) == brute_force(rows, lambda i: i == 0)
    assert mined(spark, [(0, [1e30, 1.0], 1), *rows[1:]], F.col("vec_id") == 1)


def test_a_negative_or_zero_positive(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [-0.5, 0.0], 1), (2, [0.0, 1.0], 1), (3, [-0.4, 0.0], 2), (4, [0.0, -1.0], 2)]
    assert mined(spark, rows, F.col("vec_id") == 0) == brute_force(rows, lambda i: i == 0) == [(0, 2, 1, 4, 0, 0)]


def test_nothing_to_mine(spark):
    assert mined(spark, [], F.col("vec_id") == 0) == []
    rows = random_rows(1, 10, 4)
    assert mined(spark, rows, F.col("vec_id") == 77) == []
    assert mined(spark, rows, F.lit(None).cast("boolean")) == []
