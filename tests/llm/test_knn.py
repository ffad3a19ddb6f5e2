import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import knn

SCHEMA = "vec_id long, embedding array<float>, label int, id int, v string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], SCHEMA)


def plain(rows, k, modulus):
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i in sorted({i for i, _ in ok if i % modulus == 0}):
        q = min(v for j, v in ok if j == i)
        scores = sorted(((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in ok if j != i))[:k]
        out += [(i, n, j, -s) for n, (s, j) in enumerate(scores, 1)]
    return sorted(out)


def clustered(n, d, seed, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    x = centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, d))
    return [(int(i), [float(a) for a in v]) for i, v in zip(rng.permutation(n), x.astype(np.float32), strict=True)]


@pytest.mark.parametrize("spread,pivots,per_task,block", [(0.05, 12, 8, 100), (1.0, 5, 1000, 40), (0.3, 1, 4, 1000)])
def test_against_all_pairs(spark, spread, pivots, per_task, block):
    rows = clustered(400, 7, 3, spread)
    got = knn.top_k(table(spark, rows), F.col("vec_id") % 10 == 0, pivots=pivots, queries_per_task=per_task, vectors_per_task=block)
    assert sorted(map(tuple, got.collect())) == plain(rows, 5, 10)


def test_bounds_prune_clustered_data():
    pivots = np.array([[0.0, 0, 0], [100, 0, 0], [0, 100, 0]])
    nearest = np.tile(np.arange(1.0, 7), (3, 1))
    low, high = knn.limits(pivots, np.full(3, 5.0), nearest, np.array([True, True, False]), 5)
    assert low[0, 1] > 50 and high[0, 0] < 50 and not (low[2] <= high[2]).any()


def test_ties_nulls_and_repeats(spark):
    rows = [(i, [0.5, 0.25]) for i in range(30)] + [(30, None), (31, [None, 1.0]), (32, [float("nan"), 1.0]), (40, [float("inf"), 0.0])]
    rows += [(None, [1.0, 1.0]), (50, [0.5]), (51, []), (60, [-1.0, -1.0]), (60, [-1.0, -1.0]), (7, [0.5, 0.25])]
    got = knn.top_k(table(spark, rows), F.col("vec_id") % 10 == 0, pivots=3, queries_per_task=2, vectors_per_task=7)
    assert sorted(map(tuple, got.collect())) == plain(rows, 5, 10)


def test_fewer_than_k_and_large_numbers(spark):
    rows = [(0, [3e6, 1.0]), (1, [-2e6, 5.0]), (10, [1e6, 1e6])]
    got = knn.top_k(table(spark, rows), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, got.collect())) == plain(rows, 5, 10)


def test_empty(spark):
    assert knn.top_k(table(spark, []), F.col("vec_id") % 10 == 0).count() == 0
    assert knn.top_k(table(spark, [(1, [1.0])]), F.col("vec_id") % 10 == 0).count() == 0
    assert knn.top_k(table(spark, [(10, [1.0])]), F.col("vec_id") % 10 == 0).count() == 0
