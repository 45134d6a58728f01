import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import topk


def brute(rows, k=5):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in ok:
        if i % 50 == 0:
            queries[i] = min(v, queries.get(i, v))
    out = []
    for q, v in queries.items():
        found = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in ok if i != q and len(v) == len(w))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return sorted(out)


def run(spark, rows, k=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).withColumn("rank", F.lit(1))
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, k).collect())


def vectors(n, dim, seed, scale=lambda r: 1.0):
    r = random.Random(seed)
    out = []
    for i in range(n):
        s = scale(r)
        out.append((i, [float(np.float32(r.gauss(0, 1) * s)) for _ in range(dim)]))
    return out


@pytest.mark.parametrize("case", ["plain", "skewed lengths", "clustered"])
def test_matches_brute_force(spark, monkeypatch, case):
    monkeypatch.setattr(topk, "CANDIDATES", 64)
    monkeypatch.setattr(topk, "QUERIES", 4)
    monkeypatch.setattr(topk, "SEEDS", 40)
    if case == "clustered":  # cosines near 1: pruned by coordinates
        rows = [(i, [x + (5.0 if j == i % 3 else 0) for j, x in enumerate(v)]) for i, v in vectors(500, 6, 2, lambda r: 0.3)]
    else:
        rows = vectors(500, 8, 1, (lambda r: math.exp(r.gauss(0, 1))) if case == "skewed lengths" else (lambda r: 1.0))
    rows += [(1000 + i, rows[50][1]) for i in range(100)]  # ties: one vector in a hundred rows
    assert run(spark, rows) == brute(rows)


def test_coordinate_pruning_keeps_all_that_reach_the_threshold():
    r = np.random.default_rng(5)
    c = r.integers(-40, 40, (3000, 5)) + np.array([300, 0, 0, 0, 0])
    q = r.integers(-40, 40, (20, 5)) + np.array([250, 30, 0, 0, 0])
    norm = lambda x: np.sqrt((x.astype(float) ** 2).sum(axis=1))
    score = q @ c.T
    theta = np.sort(score, axis=1)[:, -5].astype(float)
    got = list(topk.search_group(np.arange(20) + 10_000, q, norm(q), theta, np.arange(3000), c, norm(c), 5))
    want = [(10_000 + i, int(j), int(score[i, j])) for i in range(20) for j in np.lexsort((np.arange(3000), -score[i]))[:5]]
    assert sorted(got) == sorted(want)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [0.5, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (None, [1.0, 1.0]),
            (5, [1.0]), (6, []), (50, []), (7, [0.0, 0.0]), (8, [-1.0, 0.3]), (8, [-1.0, 0.3]), (100, [0.0, 0.0]), (150, [3.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, [(50, [1.0])]) == []


def test_large_components_are_exact():
    q, c = np.array([[2 ** 40, 3]]), np.array([[2 ** 20, 1], [2 ** 30, -1]])
    assert topk.products(q, c).tolist() == [[2 ** 60 + 3, 2 ** 63 - 1]]
