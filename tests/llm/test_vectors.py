import numpy as np
import pytest

from tamis.llm import metric_join

SCHEMA = "vec_id long, embedding array<double>, node string, links int"


def brute_force(rows, threshold=0.9):
    ok = {}
    for i, (_, v) in enumerate(rows):
        if v and None not in v and np.isfinite(v).all() and np.linalg.norm(v) > 0:
            ok[i] = np.array(v)
    linked = {i: set() for i in range(len(rows))}
    for i in ok:
        for j in ok:
            if i != j and len(ok[i]) == len(ok[j]):
                if ok[i] @ ok[j] / (np.linalg.norm(ok[i]) * np.linalg.norm(ok[j])) >= threshold:
                    linked[i].add(j)
    component = {}
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            fresh = linked[todo.pop()] - seen
            seen |= fresh
            todo += fresh
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        component[i] = min(ids) if ids else None
    return sorted(((rows[i][0], len(linked[i]), component[i], rows[i][0] == component[i]) for i in range(len(rows))), key=repr)


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    return sorted((tuple(r) for r in metric_join.near_vectors(df, **options).collect()), key=repr)


@pytest.mark.parametrize(("cell", "chunk"), [(4096, 4096), (12, 7)])
def test_cells_and_chunks_give_all_links(spark, cell, chunk):
    rng = np.random.default_rng(cell)
    centres = rng.normal(size=(6, 8))
    rows = [(k, (centres[k % 6] + rng.normal(size=8) * rng.choice([0.05, 0.2, 0.6])).tolist()) for k in range(150)]
    rows += [(1000 + k, rows[k % 3][1]) for k in range(30)]  # copies
    assert found(spark, rows, cell=cell, chunk=chunk) == brute_force(rows)


def test_odd_vectors_link_with_nothing(spark):
    good = [1.0, 2.0, 3.0]
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 2.0]), (5, [float("nan"), 1.0, 1.0]),
        (6, [float("inf"), 1.0, 1.0]), (7, good), (8, [2.0, 4.0, 6.0]), (8, [2.0, 4.0, 6.0]), (9, [1.0, 2.0]),
        (None, good), (10, [-1.0, -2.0, -3.0]), (None, [5.0, -1.0, 0.0]),
    ]
    assert found(spark, rows) == brute_force(rows)


def test_the_threshold_itself_links(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.8, 0.6]), (3, [0.6, 0.8])]
    assert found(spark, rows, threshold=0.8) == brute_force(rows, 0.8)


def test_no_vectors(spark):
    assert found(spark, []) == []
    assert found(spark, [(3, None)]) == [(3, 0, 3, True)]
