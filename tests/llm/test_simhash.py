import re

import numpy as np
import xxhash

from sluice.llm import queries, simhash
from sluice.llm.components import components


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    runs = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(pairs):
    """Least id of each (id, fingerprint)'s component."""
    fps = sorted({f for _, f in pairs})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    arr = np.array(fps, np.uint64)
    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= 3):
            root[find(f)] = find(fps[j])
    least = {}
    for i, f in pairs:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return [(i, f"{f:016x}", least.get(find(f))) for i, f in pairs]


def test_query_matches_brute_force(spark, tables, documents):
    want = brute_components([(r["doc_id"], brute_fingerprint(r["text"])) for r in documents.collect()])
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in queries.op2_simhash(spark, tables).collect()]
    assert sorted(got) == sorted(want)


def _clusters(n, seed=3):
    r = np.random.default_rng(seed)
    centres = r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + r.integers(0, 2, n, dtype=np.uint64)
    out = [int(c) for c in centres]
    for c in out[:n // 4]:
        for _ in range(6):
            x = c
            for b in r.choice(64, r.integers(1, 6), replace=False):
                x ^= 1 << int(b)
            out.append(x)
    # a tight group: many fingerprints on few bits
    out += [int(centres[0]) ^ int(x) for x in range(128)]
    return sorted(set(out))


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_are_complete(spark):
    fps = _clusters(400)
    arr = np.array(fps, np.uint64)
    want = set()
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= 3):
            if i < j:
                want.add(frozenset((_signed(fps[i]), _signed(fps[j]))))
    nodes = spark.createDataFrame([(_signed(f),) for f in fps], "fp long")
    for distance in (3,):
        rows = simhash.links(nodes, distance).collect()
        assert len(rows) == len(want) and {frozenset((r["u"], r["v"])) for r in rows} == want


def test_thresholds_add_up_and_cost_least():
    fps = np.array(_clusters(60), np.uint64).view(np.int64)
    bits = simhash._bits(fps)
    both, total = bits.T.astype(float) @ bits, len(fps)
    for m in simhash.GROUPINGS:
        groups = simhash.group_bits(both, total, m)
        assert sorted(b for g in groups for b in g) == list(range(64))
        near = []
        for g in groups:
            tables = []
            for c in simhash._chunks(g):
                h = np.bincount(simhash._gather(bits, c), minlength=1 << len(c)) / total
                v = np.arange(len(h))
                tables.append(np.stack([sum(h[v ^ x] for x in xs) for xs in simhash._masks(len(c), 3)], axis=1))
            near.append(tables)
        p = simhash.Plan(groups, near, total, 3)
        u, cost = p.thresholds(bits)
        assert (u.sum(axis=1) == 4).all()
        every = p.costs(bits)
        picked = sum(every[np.arange(len(u)), g, u[:, g]] for g in range(m))
        assert np.allclose(picked, cost)
        if m == 2:
            assert np.allclose(cost, np.min([every[:, 0, k] + every[:, 1, 4 - k] for k in range(5)], axis=0))


def test_components_of_chains_stars_and_rings(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1000, i) for i in range(1001, 1400)]
    ring = [(2000 + i, 2000 + (i + 1) % 33) for i in range(33)]
    rows = components(spark.createDataFrame([*chain, *star, *ring, (5, 5)], "u long, v long")).collect()
    got = {r["node"]: r["root"] for r in rows}
    want = {i: 100 for i in range(101, 161)} | {i: 1000 for i in range(1001, 1400)} | {i: 2000 for i in range(2001, 2033)}
    assert got == want and len(rows) == len(want)
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_edges(spark, edge, empty):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    want = brute_components([(i, brute_fingerprint(t)) for i, t in rows])
    got = [(r["doc_id"], f"{r['fp'] & (1 << 64) - 1:016x}", r["component_id"]) for r in simhash.near_duplicates(edge).collect()]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.fingerprint(b"a\xc3\x89 B") == brute_fingerprint("aÉ b")
