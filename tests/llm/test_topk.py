import math
import random

import pytest
from pyspark.sql import functions as F

from barworks.llm import topk


def slow(rows, every, k):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in ok if c != q)
        out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def ours(spark, rows, every, k, **sizes):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % every == 0, k, **sizes).collect())


@pytest.mark.parametrize("sizes", [{}, {"candidates": 40, "queries": 3}])
def test_matches_brute_force(spark, sizes):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(40)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(30)]  # ties beyond k
    assert ours(spark, rows, 10, 5, **sizes) == slow(rows, 10, 5)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, [None, 1.0]), (None, [1.0, 1.0]),
            (5, []), (6, [0.5]), (7, [1.0, 2.0, 3.0]), (8, [1e12, -1e12]), (8, [1e12, -1e12]), (9, [-0.0005, 0.0])]
    assert ours(spark, rows, 1, 10) == slow(rows, 1, 10)
    assert ours(spark, [], 1, 10) == []


def test_bounds_drop_candidates():
    import numpy as np

    rng = np.random.default_rng(0)
    vectors = np.floor(1024 * rng.normal(size=(64, 500)))
    vectors[:, 3] = vectors[:, 4] = vectors[:, 5]
    cuts = [0, 16, 32, 48, 64]
    norms = topk._rest_norms(vectors, cuts)
    at, score = topk.best(vectors[:, 5], 5, vectors, np.arange(500), norms, [n[5] for n in norms], cuts, 2)
    assert at.tolist() == [3, 4] and score[0] == vectors[:, 5] @ vectors[:, 5]
