"""Nearest neighbours against brute force."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from sensorflow.llm import ann


def _frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((30, 24)) * 2
    x = (centres[rng.integers(0, 30, 4000)] + rng.standard_normal((4000, 24))).astype(np.float32)
    df = _frame(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)]).withColumn("rank", F.lit("clash"))
    got: dict = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0, k=10).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 4000, 20))
    x = x.astype(float)
    right = 0
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        right += len({v for v, _ in found} & set(np.argsort(-s, kind="stable")[:10].tolist()))
        assert len(found) == 10 and all(abs(score - s[v]) < 1e-9 for v, score in found)
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)
    assert right / (10 * len(got)) >= 0.9


def test_ties_copies_and_odd_rows(spark):
    same = [1.0, 2.0, 0.5]
    rows = [(i, same, 0) for i in range(60)] + [(100, None, 0), (120, [0.0, 0.0, 0.0], 0), (140, [1.0, None, 1.0], 0), (160, [float("nan"), 1.0, 1.0], 0),
                                              (180, [1.0], 0), (200, [float("inf"), 0.0, 0.0], 0), (None, same, 0), (20, same, 0), (61, [3.0, 0.0, 0.0], 1)]
    got: dict = {}
    for r in ann.search(_frame(spark, rows), F.col("vec_id") % 20 == 0, k=5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {0: [1, 2, 3, 4, 5], 20: [0, 1, 2, 3, 4], 40: [0, 1, 2, 3, 4]}


def test_all_ties_with_the_last_count():
    rng = np.random.default_rng(5)
    q = np.array([[1.0, 0.5, 0.25, 0.0]])
    base = rng.standard_normal((400, 4))
    base[:, 0] = 0.1 - 0.5 * base[:, 1] - 0.25 * base[:, 2]  # distinct vectors, inner products equal but for rounding
    base[390:, 0] += 1
    score = np.array([ann._exact(q[0], v[None, :])[0] for v in base])
    got = ann.nearest(np.array([10**6]), q, np.arange(400), base, 20).iloc[0]
    assert list(got["ids"]) == sorted(range(400), key=lambda i: (-score[i], i))[:20]
    whole = np.floor(base * 8)  # exact ties
    whole[:, 0] = 1 - 0.5 * whole[:, 1] - 0.25 * whole[:, 2]
    assert list(ann.nearest(np.array([10**6]), q, np.arange(400), whole, 20).iloc[0]["ids"]) == list(range(20))


def test_few_and_no_rows(spark):
    df = _frame(spark, [(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (2, [-1.0, 0.0], 0)])
    assert [(r["rank"], r["vec_id"]) for r in ann.search(df, F.col("vec_id") == 0).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert ann.search(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert ann.search(df, F.lit(False)).count() == 0
    assert ann.search(_frame(spark, [(0, [1.0], 0)]), F.lit(True)).count() == 0


def test_partition_is_balanced():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((512, 8))
    label = ann.partition(ann.neighbours(x, x, 8, np.arange(512)), 8, rng)
    assert sorted(np.bincount(label)) == [64] * 8
