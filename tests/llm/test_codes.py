import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import codes


def brute(rows):
    """All of it in plain Python integers, one dimension at a time."""
    ok = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows
          if v and len(v) % 8 == 0 and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for d in {len(v) for _, v, _ in ok}:
        own, w = [(i, v, label) for i, v, label in ok if len(v) == d], d // 8
        first = {}
        for i, v, _ in own:
            first[i] = min(v, first.get(i, v))
        smallest = [first[i] for i in sorted(first, key=lambda i: (i is None, i))[:16]]
        code, error = [[] for _ in own], [0] * len(own)
        book = []
        for p in range(8):
            part = [v[p * w:(p + 1) * w] for _, v, _ in own]
            entries = [v[p * w:(p + 1) * w] for v in smallest]
            for step in range(7):
                far = [[sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in entries] for x in part]
                best = [f.index(min(f)) for f in far]
                if step < 6:
                    for e in set(best):
                        mine = [x for x, b in zip(part, best, strict=True) if b == e]
                        entries[e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
            for k, b in enumerate(best):
                code[k].append(f"{b:02x}")
                error[k] += far[k][b]
            book += [c for e in entries for c in e]
        sha = hashlib.sha256(",".join(map(str, book)).encode()).hexdigest()
        out += [(i, "".join(c), e, label, sha) for (i, _, label), c, e in zip(own, code, error, strict=True)]
    most = 2 ** 63 - 1
    by_label = {}
    for _, _, e, label, _ in out:
        by_label[label] = by_label.get(label, 0) + min(e, most)
    return sorted([(i, c, min(e, most), min(by_label[label], most), s) for i, c, e, label, s in out], key=repr)


def run(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    df = df.select("*", *[F.lit("x").alias(c) for c in ("v", "code", "error", "part", "dim", "__label")])
    return sorted(map(tuple, codes.compress(df).collect()), key=repr)


def vectors(n, dim, seed, scale=0.2):
    r = random.Random(seed)
    return [(i, [r.gauss(0, scale) for _ in range(dim)], r.choice([None, 0, 1, 2])) for i in range(n)]


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(codes, "TILE", 37)
    monkeypatch.setattr(codes, "FIRST", 40)
    assert run(spark, vectors(300, 16, 1)) == brute(vectors(300, 16, 1))


@pytest.mark.parametrize("first", [10, 512])
def test_hot_vector_and_ties(spark, monkeypatch, first):
    monkeypatch.setattr(codes, "FIRST", first)
    rows = vectors(120, 8, 2)
    rows += [(1000 + i, rows[3][1], 1) for i in range(60)] + [rows[5]] * 4  # a third is one vector, one row stands five times
    rows += [(2000, [0.0] * 8, 2), (2001, [-1.0 / 4096] * 8, 2)]  # between two entries as near as each other
    assert run(spark, rows) == brute(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [1.0] * 7 + [None], 1), (3, [nan] * 8, 1), (4, [inf] * 8, None), (5, [], 1), (6, [1.0] * 7, 1), (None, [0.5] * 8, None),
            (None, [0.25] * 8, 3), (7, [-0.1] * 8, None), (8, [0.1 * i for i in range(16)], 3), (9, [0.2 * i for i in range(16)], 3)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
    assert run(spark, [(5, [], 1)]) == []


def test_huge_components(spark):
    rows = vectors(40, 8, 4) + [(100 + i, [v * 10.0 ** (2 * i) for v in (1.0, -2.0, 3.0, -4.0, 5.0, -6.0, 7.0, -8.0)], 9) for i in range(6)]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("most", [10, 2 ** 24, 2 ** 26, 2 ** 30, 2 ** 40, 2 ** 62])
def test_limb_products_are_exact(most):
    r = random.Random(most)
    x = [[r.randint(-most, most) for _ in range(8)] for _ in range(9)]
    y = [[r.randint(-most, most) for _ in range(8)] for _ in range(5)]
    got = codes.dots(np.array(x, np.int64), np.array(y, np.int64))
    assert got.tolist() == [[sum(a * b for a, b in zip(u, v, strict=True)) for v in y] for u in x]
    bits = (53 - 3) // 2
    parts = codes.limbs(np.array(x, np.int64), bits)
    assert all(np.abs(p).max() < 2 ** bits for p in parts)
    assert (sum(p.astype(np.int64).astype(object) * (1 << (bits * i)) for i, p in enumerate(parts)) == np.array(x, object)).all()
