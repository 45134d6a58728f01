"""SimHash near-duplicates: fingerprints, and links within a few bits by the generalised pigeonhole principle.

Fingerprints are cut into m groups of bits. If two differ in at most t bits, then for any thresholds u_i >= 0 with
sum u_i = t + 1 some group differs in fewer than u_i bits (u_i = 0: the group isn't probed). The bits of a group are
chosen to be correlated; each fingerprint gets thresholds of its own, by dynamic programming on estimated counts of
candidates; m is the one of least estimated cost. Every choice is complete, so estimates change the work, never the
links."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, only, written
from .components import components

SEED = 42
BITS = 64
#: Numbers of bit groups that are weighed against each other.
GROUPINGS = (2, 3, 4, 5)
#: A group's histogram is kept for runs of at most this many bits.
CHUNK_BITS = 11


def fingerprint(raw: bytes | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text, as an unsigned integer (0 if it has no word)."""
    words = raw.lower().split() if raw else []
    if not words:
        return 0
    if len(words) < shingle:
        runs = [b" ".join(words)]
    else:
        runs = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(s, SEED) for s in runs), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at:at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), shingle: int = 3) -> DataFrame:
    """``keep`` columns of every row and ``fp``, its fingerprint as a signed long. Null and empty texts have 0."""
    kept = docs.select(F.col(text).alias("__text"), *[F.col(c) for c in keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(raw, shingle) for raw in as_bytes(batch.column(0))], np.uint64).view(np.int64)
            yield pa.record_batch([*[batch.column(i + 1) for i in range(len(keep))], pa.array(fp)], names=[*keep, "fp"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[1:])
    return kept.mapInArrow(run, f"{fields}, fp bigint")


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.view(np.uint8).reshape(len(fps), 8), axis=1, bitorder="little")


def _co_occurrence(nodes: DataFrame) -> np.ndarray:
    """How often two bits are set together, over all fingerprints: a table of 4,096 sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS))
        for batch in batches:
            b = _bits(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)).astype(np.float32)
            both += b.T @ b
        i, j = np.indices(both.shape)
        yield pa.record_batch({"i": pa.array(i.ravel(), pa.int32()), "j": pa.array(j.ravel(), pa.int32()),
                               "n": pa.array(both.ravel().astype(np.int64))})

    out = np.zeros((BITS, BITS))
    for i, j, n in nodes.select("fp").mapInArrow(run, "i int, j int, n bigint").groupBy("i", "j").agg(F.sum("n")).collect():
        out[i, j] = n
    return out


def group_bits(both: np.ndarray, total: int, m: int) -> list[list[int]]:
    """m groups of nearly equal width; each starts with the free bit of most correlation to free bits and takes
    the free bit that correlates most with the group."""
    p = np.diag(both) / max(total, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    r = np.abs((both / max(total, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(r, 0)
    free, groups = list(range(BITS)), []
    for g in range(m):
        width = BITS // m + (g < BITS % m)
        group = [max(free, key=lambda b: (r[b, free].sum(), -b))]
        free.remove(group[0])
        while len(group) < width:
            b = max(free, key=lambda b: (r[b, group].sum(), -b))
            group.append(b)
            free.remove(b)
        groups.append(sorted(group))
    return groups


def _chunks(group: list[int]) -> list[list[int]]:
    n = -(-len(group) // CHUNK_BITS)
    return [list(c) for c in np.array_split(group, n)]


def _gather(bits: np.ndarray, chunk: list[int]) -> np.ndarray:
    return bits[:, chunk].astype(np.int64) @ (1 << np.arange(len(chunk)))


def _histograms(nodes: DataFrame, groupings: dict[int, list[list[int]]]) -> dict[tuple[int, int, int], np.ndarray]:
    """Counts of the values of every run of bits, over all fingerprints (at most 2,048 a run)."""
    runs = {(m, g, k): c for m, gs in groupings.items() for g, group in enumerate(gs) for k, c in enumerate(_chunks(group))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {key: np.zeros(1 << len(c), np.int64) for key, c in runs.items()}
        for batch in batches:
            b = _bits(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
            for key, c in runs.items():
                counts[key] += np.bincount(_gather(b, c), minlength=1 << len(c))
        for (m, g, k), n in counts.items():
            v = np.flatnonzero(n)
            yield pa.record_batch({"m": pa.array([m] * len(v), pa.int32()), "g": pa.array([g] * len(v), pa.int32()),
                                   "k": pa.array([k] * len(v), pa.int32()), "v": pa.array(v, pa.int32()), "n": pa.array(n[v])})

    out = {key: np.zeros(1 << len(c), np.int64) for key, c in runs.items()}
    for m, g, k, v, n in (nodes.select("fp").mapInArrow(run, "m int, g int, k int, v int, n bigint")
                          .groupBy("m", "g", "k", "v").agg(F.sum("n")).collect()):
        out[m, g, k][v] = n
    return out


def _masks(width: int, most: int) -> list[list[int]]:
    return [[sum(1 << b for b in c) for c in combinations(range(width), d)] for d in range(most + 1)]


@dataclass(frozen=True)
class Plan:
    """Groups of bits, and per run of bits how many fingerprints lie at each distance from a value."""

    groups: list[list[int]]
    near: list[list[np.ndarray]]
    total: int
    distance: int

    def costs(self, bits: np.ndarray) -> np.ndarray:
        """(fingerprint, group, u): signatures to probe plus candidates to verify, estimated, if the group's
        threshold is u - 1 bits. Runs of a group count as independent."""
        out = np.zeros((len(bits), len(self.groups), self.distance + 2))
        for g, group in enumerate(self.groups):
            at = np.zeros((len(bits), self.distance + 1))
            at[:, 0] = 1.0
            for chunk, near in zip(_chunks(group), self.near[g], strict=True):
                part = near[_gather(bits, chunk)]
                at = np.stack([sum(at[:, i] * part[:, d - i] for i in range(d + 1)) for d in range(self.distance + 1)], axis=1)
            probes = np.cumsum([len(x) for x in _masks(len(group), self.distance)])
            out[:, g, 1:] = probes + self.total * np.cumsum(at, axis=1)
        return out

    def thresholds(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """u for every fingerprint and group, and the least cost, by dynamic programming over groups."""
        cost, budget = self.costs(bits), self.distance + 1
        best = np.full((len(bits), budget + 1), np.inf)
        best[:, 0] = 0
        taken = []
        for g in range(len(self.groups)):
            ways = np.stack([np.stack([best[:, s - u] + cost[:, g, u] if u <= s else np.full(len(bits), np.inf)
                                       for u in range(budget + 1)], axis=1) for s in range(budget + 1)], axis=1)
            taken.append(ways.argmin(axis=2))
            best = ways.min(axis=2)
        u, left = np.zeros((len(bits), len(self.groups)), np.int64), np.full(len(bits), budget)
        for g in reversed(range(len(self.groups))):
            u[:, g] = taken[g][np.arange(len(bits)), left]
            left = left - u[:, g]
        return u, best[:, budget]


def plan(nodes: DataFrame, distance: int = 3) -> Plan:
    """Bit groups and estimates from all fingerprints; of the numbers of groups, the one of least total cost."""
    total = nodes.count()
    both = _co_occurrence(nodes)
    groupings = {m: group_bits(both, total, m) for m in GROUPINGS}
    counts = _histograms(nodes, groupings)
    plans = {}
    for m, groups in groupings.items():
        near = []
        for g, group in enumerate(groups):
            tables = []
            for k, chunk in enumerate(_chunks(group)):
                h = counts[m, g, k] / max(total, 1)
                v = np.arange(len(h))
                tables.append(np.stack([sum(h[v ^ x] for x in xs) if xs else np.zeros(len(h)) for xs in _masks(len(chunk), distance)], axis=1))
            near.append(tables)
        plans[m] = Plan(groups, near, total, distance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost = dict.fromkeys(plans, 0.0)
        for batch in batches:
            b = _bits(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
            for m, p in plans.items():
                cost[m] += float(p.thresholds(b)[1].sum())
        yield pa.record_batch({"m": pa.array(list(cost), pa.int32()), "cost": pa.array(list(cost.values()), pa.float64())})

    costs = dict(nodes.select("fp").mapInArrow(run, "m int, cost double").groupBy("m").agg(F.sum("cost")).collect())
    return plans[min(plans, key=lambda m: (costs.get(m, 0.0), m))]


def links(nodes: DataFrame, distance: int = 3) -> DataFrame:
    """``(u, v)`` for every two different fingerprints of ``nodes(fp)`` at most ``distance`` bits apart.

    A fingerprint probes, per group, every value within its threshold; the others are found under their own
    value; the join verifies the distance. Pairs need one direction only, as each probe is complete."""
    p = plan(nodes, distance)
    masks = [sum(1 << b for b in g) for g in p.groups]
    flips = [[[sum(1 << g[b] for b in range(len(g)) if x >> b & 1) for x in xs] for xs in _masks(len(g), distance)] for g in p.groups]
    flips = [[np.array(xs, np.uint64) for xs in g] for g in flips]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(every), 2048):
                fps = every[at:at + 2048]
                u, _ = p.thresholds(_bits(fps))
                for g, mask in enumerate(masks):
                    for d, xs in enumerate(flips[g]):
                        q = fps[u[:, g] > d]
                        if len(q) == 0:
                            continue
                        step = max(1, (1 << 16) // len(q))
                        for i in range(0, len(xs), step):
                            key = ((q.view(np.uint64) & np.uint64(mask))[:, None] ^ xs[None, i:i + step]).ravel().view(np.int64)
                            yield pa.record_batch({"g": pa.array(np.full(len(key), g, np.int32)), "key": pa.array(key),
                                                   "q": pa.array(np.repeat(q, len(xs[i:i + step])))})

    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    index = nodes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("g", "key"))
    probes = nodes.select("fp").mapInArrow(probe, "g int, key bigint, q bigint").alias("a")
    near = F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= distance
    return (probes.join(index.alias("b"), (F.col("a.g") == F.col("b.g")) & (F.col("a.key") == F.col("b.key"))
                        & (F.col("q") < F.col("fp")) & near)
            .select(F.col("q").alias("u"), F.col("fp").alias("v")).distinct())


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3, distance: int = 3) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row: the fingerprint, and the least doc_id of its component.

    Rows of one fingerprint are one node, so copies are never paired. Null and empty texts have fingerprint 0 and
    link like any other. A null doc_id is never a component's least unless the component has no other (then null).
    Repeated rows each get their row. An empty table gives an empty result."""
    rows = written(fingerprints(only(docs, [text, doc_id]), text, (doc_id,), shingle), "fingerprints")
    return label(rows, doc_id, distance)


def label(rows: DataFrame, doc_id: str = "doc_id", distance: int = 3) -> DataFrame:
    """``rows(doc_id, fp, ...)`` with ``component_id`` and ``root`` (the component's least fingerprint)."""
    nodes = written(rows.groupBy("fp").agg(F.min(doc_id).alias("least")), "nodes")
    member = written(components(links(nodes, distance)), "members")
    rooted = nodes.join(member, nodes.fp == member.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select(F.col("fp").alias("f"), "root", "component_id")
    return rows.join(named, rows.fp == F.col("f"), "left").drop("f")
