import numpy as np
from pyspark.sql import functions as F

from sievework.llm.ann import search

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=10):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float32).astype(np.float64)
    out = {}
    for i in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, d)) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), d[j]) for j in order]
    return out


def test_recall_and_order(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[500:1500] = x[0]  # a third of all rows
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    odd = [(None, [1.0] * 16, 0), (4000, None, 0), (4100, [0.0] * 16, 0), (4200, [float("nan")] * 16, 0), (4300, [1.0, None] * 8, 0)]
    got = {}
    for r in search(spark.createDataFrame(rows + odd, SCHEMA), F.col("id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want, hit = brute(rows), 0
    assert set(got) == set(want)
    for q, w in want.items():
        g = sorted(got[q])
        assert [r for r, _, _ in g] == list(range(1, 11))
        assert [(s, v) for _, v, s in g] == sorted((s, v) for _, v, s in g)
        hit += len({v for _, v, _ in g} & {v for v, _ in w})
    assert hit >= 0.9 * 10 * len(want)
    assert [v for _, v, _ in sorted(got[0])] == [v for v, _ in want[0]]


def test_repeated_rows_of_equal_vectors(spark):
    same = [1.0, 0.0]
    rows = [(0, same, 1)] * 11 + [(i, same, 1) for i in range(1, 21)] * 2 + [(50, [0.0, 1.0], 1)]
    got = sorted(tuple(r) for r in search(spark.createDataFrame(rows, SCHEMA), F.col("id") % 100 == 0).collect())
    assert got == [(0, i, i, 0.0) for i in range(1, 11)]


def test_every_length_is_searched(spark):
    rows = [(0, [1.0], 1), (1, [1.0, 0.0], 1), (2, [3.0], 1), (100, [0.0, 1.0], 1), (200, [1.0, 1.0, 1.0], 1), (5, [0.0, 2.0], 1)]
    got = sorted(tuple(r) for r in search(spark.createDataFrame(rows, SCHEMA), F.col("id") % 100 == 0).collect())
    assert got == [(0, 1, 2, 2.0), (100, 1, 5, 1.0), (100, 2, 1, 2**0.5)]


def test_small_and_empty(spark):
    rows = [(0, [1.0, 0.0], 1), (7, [0.0, 1.0], 1), (3, [0.0, 1.0], 1)]
    got = [tuple(r) for r in search(spark.createDataFrame(rows, SCHEMA), F.col("id") % 100 == 0).collect()]
    assert sorted(got) == [(0, 1, 3, 2**0.5), (0, 2, 7, 2**0.5)]
    assert search(spark.createDataFrame([], SCHEMA), F.col("id") % 100 == 0).count() == 0
