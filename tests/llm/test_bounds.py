"""What a task, the driver or a broadcast holds does not grow: repeated ids, heavy buckets, many vector lengths, sets that share half a name."""

import numpy as np
from pyspark.sql import functions as F

from sievework.llm import ann, jaccard, labelled


def neighbours(df):
    return sorted(tuple(r) for r in df.collect())


def test_heavy_buckets_are_joined_where_they_are_too_many(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 8))
    x[:700] = x[0] + rng.normal(size=(700, 8)) * 1e-3  # one bucket over a block
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    few = neighbours(ann.search(vectors, F.col("id") % 100 == 0))
    monkeypatch.setattr(ann, "HEAVY", 0)
    assert neighbours(ann.search(vectors, F.col("id") % 100 == 0)) == few and len(few) == 150


def test_fifty_vector_lengths(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=1 + i % 50).tolist()) for i in range(1000)]
    got = {}
    for q, rank, v, score in neighbours(ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 100 == 0)):
        got.setdefault(q, []).append((rank, v))
    for q in range(0, 1000, 100):
        own = [(np.linalg.norm(np.array(v) - np.array(rows[q][1])), i) for i, v in rows if len(v) == len(rows[q][1]) and i != q]
        want = [i for _, i in sorted(own)[:10]]
        assert [r for r, _ in sorted(got[q])] == list(range(1, 11))
        assert len({v for _, v in got[q]} & set(want)) >= 9


def test_an_id_in_very_many_rows_trains_once(spark):
    docs = spark.range(100_000).selectExpr("CAST(1 AS LONG) AS doc_id", "concat('text ', id % 5000) AS text").union(spark.createDataFrame([(3, "other"), (3, None), (4, "")], "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1), (3, 0), (4, 1), (None, 1)], "doc_id long, toxic int")
    seen = labelled.fitted(docs, labels, F.col("toxic"), lambda texts, ys, shares: (texts, ys, shares))
    again = labelled.fitted(docs.repartition(7), labels, F.col("toxic"), lambda texts, ys, shares: (texts, ys, shares))
    assert len(seen[0]) == 2 and "other" in seen[0] and sorted(seen[1]) == [0, 1] and seen == again


def test_sets_that_share_half_a_name(spark):
    schema = "doc_id long, row long, sid long, check long, n long, sketch binary"
    rows = [(3, 1, 7, 1, 5, b"a"), (2, 2, 7, 1, 5, b"a"), (4, 3, 7, 2, 6, b"b"), (9, 4, 8, 1, 4, b"c"), (None, 5, 8, 1, 4, b"c")]
    got = {(r.set_a, r.set_b): r for r in jaccard.classes_of(spark.createDataFrame(rows, schema)).collect()}
    assert {k: (r.doc_id, r.row, r.n_copies) for k, r in got.items()} == {(7, 1): (2, 2, 2), (7, 2): (4, 3, 1), (8, 1): (9, 4, 2)}
    assert len({r.sid for r in got.values()}) == 3 and got[8, 1].sid == 8
    alone = jaccard.classes_of(spark.createDataFrame(rows[3:], schema)).collect()
    assert [(r.sid, r.doc_id) for r in alone] == [(8, 9)]
