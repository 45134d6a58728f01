import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import negatives


def brute(rows):
    ok = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
          if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    anchors = {}
    for i, v, label in ok:
        if i % 100 == 0:
            anchors[i] = min((label, v), anchors.get(i, (label, v)))
    out = []
    for a, (label, v) in anchors.items():
        score = [(sum(x * y for x, y in zip(v, w, strict=True)), i, other) for i, w, other in ok if len(w) == len(v)]
        positives = sorted(((-s, i) for s, i, other in score if other == label and i != a))[:5]
        for p, i in ((-p, i) for p, i in positives):
            fit = sorted((-s, j) for s, j, other in score if other != label and 30 * p <= 100 * s <= 90 * p)[:10]
            out += [(a, i, n + 1, j, p, -s) for n, (s, j) in enumerate(fit)]
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = df.select("*", *[F.lit("x").alias(c) for c in ("v", "id", "rank", "anchor", "window", "score")])
    return sorted(tuple(r) for r in negatives.mine(df, F.col("vec_id") % 100 == 0).collect())


def vectors(n, dim, seed, labels=3, shift=0.0):
    r = random.Random(seed)
    return [(i, [float(np.float32(r.gauss(shift, 1))) for _ in range(dim)], r.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("shift", [0.0, 0.8])
def test_matches_brute_force(spark, monkeypatch, shift):
    monkeypatch.setattr(negatives, "BLOCK", 150)
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    monkeypatch.setattr(negatives, "DEPTH", 2)
    rows = vectors(900, 6, 1, shift=shift)
    got = run(spark, rows)
    assert got == brute(rows) and len(got) > 50


def test_hot_vector_and_hot_label(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 64)
    rows = vectors(300, 5, 3, shift=0.5)
    rows += [(1001 + i, rows[7][1], 1) for i in range(150)]  # a third of the rows is one vector with one label
    rows += [rows[9]] * 5 + [(100, rows[100][1], rows[100][2])] * 3
    assert run(spark, rows) == brute(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (None, [1.0, 1.0], 1), (5, [1.0, 1.0], None),
            (6, [1.0, 1.9], 1), (7, [0.5, 1.0], 2), (8, [0.4, 1.0], 2), (9, [1.0], 1), (10, [], 2), (100, [], 2), (11, [], 2), (12, [], 3),
            (200, [0.0, 0.0], 4), (13, [1.0, 1.0], 4), (300, [-1.0, 0.3], 5), (14, [1.0, 0.3], 5), (15, [-1.0, 0.1], 6), (400, [1.0, 1.0], 7)]
    got = run(spark, rows)
    assert got == brute(rows) and any(a == 200 for a, *_ in got)
    assert run(spark, []) == []
    assert run(spark, [(100, [1.0], 1)]) == []


def test_large_components(spark):
    rows = [(i, [x * 2.0 ** 20 for x in v], label) for i, v, label in vectors(150, 4, 8, shift=0.5)]
    assert run(spark, rows) == brute(rows)


def test_search_stops_before_the_end():
    r = np.random.default_rng(1)
    v = r.integers(-5, 6, (4000, 4))
    v[:40] += 400
    block = negatives.Lists(np.arange(4000), np.zeros(4000), v)
    seen = []
    scores = block._scores
    block._scores = lambda at, a: (seen.append(len(at)), scores(at, a))[1]
    best = negatives.Best(5)
    block.search(np.array([1, 2, 3, 4]), np.ones(4000, bool), [best])
    want = v @ np.array([1, 2, 3, 4])
    assert best.ids.tolist() == np.lexsort((np.arange(4000), -want))[:5].tolist() and sum(seen) < 400
