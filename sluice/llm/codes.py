"""Compression of vectors to codes: one codebook per part of the vector, fitted and applied in exact integers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written
from .topk import scaled, usable

PARTS, ENTRIES, ROUNDS, FACTOR = 8, 16, 6, 4096
MOST = 2 ** 63 - 1
#: Rows that one matrix product takes, and rows of least ids that are looked at first for the codebooks' beginning.
TILE, FIRST = 8192, 512


def largest(x: np.ndarray) -> int:
    """The largest size of an integer in an array."""
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """``x`` (integers) as float64 arrays with x = sum of limb[i] * 2^(bits * i); the last limb holds the sign."""
    out = []
    while True:
        if largest(x) < 1 << (bits - 1):
            return [*out, x.astype(np.float64)]
        low = x & ((1 << bits) - 1)
        out.append(low.astype(np.float64))
        x = (x - low) >> bits


def dots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices.

    Components are split in limbs so narrow that no sum of limb products reaches 2^53; every pair of limbs is one float64 matrix product, and
    the products, shifted to their place, are added up in int64. What could leave int64 is added up in Python's integers (dtype object)."""
    width = max(1, x.shape[1])
    if not x.size or not y.size:
        return np.zeros((len(x), len(y)), np.int64)
    bits = (53 - (width - 1).bit_length()) // 2
    kind = np.int64 if largest(x) * largest(y) * width < 2 ** 62 else object
    total = np.zeros((len(x), len(y)), kind)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(limbs(y, bits)):
            part = (a @ b.T).astype(np.int64)
            total += (part.astype(kind) if kind is object else part) * (1 << (bits * (i + j)))
    return total


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every row of ``x`` the place of the nearest entry (squared distance, ties to the first) and that distance."""
    dot = dots(x, entries)
    most = max(largest(x), largest(entries))
    kind = np.int64 if 4 * most * most * max(1, x.shape[1]) < 2 ** 62 else object
    square = lambda m: (m.astype(kind) * m.astype(kind)).sum(axis=1)
    left = square(entries)[None, :] - 2 * dot.astype(kind)
    best = left.argmin(axis=1)  # the first of the least
    return best, square(x) + left[np.arange(len(x)), best]


def _vectors(batch: pa.RecordBatch, column: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By dimension: the places of a batch's vectors and the vectors as a matrix."""
    lists = batch.column(column)
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
    n = np.diff(ends, prepend=0)
    out = {}
    for d in np.unique(n):
        at = np.flatnonzero(n == d)
        out[int(d)] = at, flat[((ends - n)[at][:, None] + np.arange(d)[None, :])].reshape(len(at), d)
    return out


def _sums(rows: DataFrame, books: dict[int, np.ndarray]) -> DataFrame:
    """(dim, part, entry, n, total): count and componentwise sum of the parts of each codebook entry. Tasks add up their own
    rows first, so what is shuffled is a codebook a task."""
    schema = "dim int, part int, entry int, n bigint, total array<decimal(38,0)>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {d: (np.zeros(b.shape, object), np.zeros(b.shape[:2], np.int64)) for d, b in books.items()}
        for batch in batches:
            for d, (_, v) in _vectors(batch, 0).items():
                total, n = totals[d]
                for at in range(0, len(v), TILE):
                    tile = v[at:at + TILE]
                    for p in range(PARTS):
                        x = tile[:, p * (d // PARTS):(p + 1) * (d // PARTS)]
                        best, _ = nearest(x, books[d][p])
                        n[p] += np.bincount(best, minlength=len(books[d][p]))
                        for e in np.unique(best):
                            total[p, e] += _total(x[best == e])
        for d, (total, n) in totals.items():
            if n.sum():
                at = np.argwhere(n)
                yield pa.record_batch([pa.array([d] * len(at), pa.int32()), pa.array(at[:, 0], pa.int32()), pa.array(at[:, 1], pa.int32()),
                                       pa.array([int(n[p, e]) for p, e in at], pa.int64()),
                                       pa.array([[Decimal(int(s)) for s in total[p, e]] for p, e in at], pa.list_(pa.decimal128(38, 0)))],
                                      names=["dim", "part", "entry", "n", "total"])

    parts = rows.select("v").mapInArrow(run, schema)
    cells = parts.select("dim", "part", "entry", "n", F.posexplode("total").alias("place", "total"))
    cells = cells.groupBy("dim", "part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"))
    return cells.groupBy("dim", "part", "entry").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("place", "total"))).alias("total"))


def _total(x: np.ndarray) -> np.ndarray:
    """Componentwise sum as Python integers."""
    if largest(x) * len(x) < 2 ** 62:
        return x.sum(axis=0).astype(object)
    return x.astype(object).sum(axis=0)



def kept_rows(vectors: DataFrame, vec_id: str, vector: str, keep: tuple[str, ...]) -> DataFrame:
    """Usable rows with their scaled vector ``v``. Vectors that can't be cut in equal parts take no part."""
    return (vectors.where(usable(F.col(vector))).where((F.size(vector) > 0) & (F.size(vector) % PARTS == 0))
            .select(F.col(vec_id).alias("__id"), scaled(F.col(vector), FACTOR).alias("v"), *[F.col(c) for c in keep]))


def first_books(rows: DataFrame) -> dict[int, np.ndarray]:
    """By dimension: the parts of the vectors of the smallest ids (null last; of a repeated id the least vector), as many as ENTRIES."""
    dims = [r[0] for r in rows.select(F.size("v")).distinct().collect()]
    books = {}
    for d in sorted(dims):
        of_dim = rows.where(F.size("v") == d).select("__id", "v")
        order = (F.asc_nulls_last("__id"), F.asc("v"))
        least = {}
        for r in (top := of_dim.orderBy(*order).limit(FIRST).collect()):
            least.setdefault(r["__id"], r["v"])
        if len(least) < ENTRIES and len(top) == FIRST:  # few ids in very many rows
            least = dict(map(tuple, of_dim.groupBy("__id").agg(F.min("v").alias("v")).orderBy(*order).limit(ENTRIES).collect()))
        own = list(least.values())[:ENTRIES]
        books[d] = np.array(own, np.int64).reshape(len(own), PARTS, d // PARTS).swapaxes(0, 1).copy()
    return books


def fit(rows: DataFrame, rounds: int = ROUNDS) -> dict[int, np.ndarray]:
    """Codebooks by dimension, each (part, entry, component): every round assigns all parts to their nearest entries and moves
    each used entry to the floor of its parts' mean. The driver holds codebooks alone."""
    books = first_books(rows)
    for _ in range(rounds):
        for r in _sums(rows, books).collect():
            books[r["dim"]][r["part"], r["entry"]] = [int(x["total"]) // r["n"] for x in r["total"]]
    return books


def digest(book: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def encode(rows: DataFrame, books: dict[int, np.ndarray], keep: tuple[str, ...] = ()) -> DataFrame:
    """(__id, code, error, codebooks_sha256) and ``keep`` columns: the entry of every part, two hex digits each, and the sum of the
    squared distances (a sum above the long range stops at its end)."""
    digests = {d: digest(b) for d, b in books.items()}
    picked = rows.select("v", "__id", *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, error = np.empty(batch.num_rows, object), np.zeros(batch.num_rows, np.int64)
            sha = np.empty(batch.num_rows, object)
            for d, (where, v) in _vectors(batch, 0).items():
                for at in range(0, len(v), TILE):
                    tile, to = v[at:at + TILE], where[at:at + TILE]
                    best, far = zip(*[nearest(tile[:, p * (d // PARTS):(p + 1) * (d // PARTS)], books[d][p]) for p in range(PARTS)], strict=True)
                    code[to] = [bytes(x).hex() for x in np.stack(best, axis=1).astype(np.uint8)]
                    total = sum(f.astype(object) for f in far) if any(f.dtype == object or int(f.max()) >= 2 ** 59 for f in far) else sum(far)
                    error[to] = [min(int(x), MOST) for x in total] if total.dtype == object else total
                sha[where] = digests[d]
            yield pa.record_batch([*batch.columns[1:], pa.array(code, pa.string()), pa.array(error), pa.array(sha, pa.string())],
                                  names=["__id", *keep, "code", "error", "codebooks_sha256"])

    fields = [*picked.schema.fields[1:], T.StructField("code", T.StringType()), T.StructField("error", T.LongType()), T.StructField("codebooks_sha256", T.StringType())]
    return picked.mapInArrow(run, T.StructType(fields))


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row with a usable vector.

    A component x counts as floor(4096 * x) (beyond the long range: its end); vectors are cut in 8 parts with a codebook of up to 16 entries each, which
    begins as the vectors of the smallest ids and is moved in 6 rounds. Rows whose vector is null, empty, not divisible in 8
    parts, or holds null or non-finite components take no part; vectors of another dimension have codebooks of their own.
    Null ids are coded too and come last among the ids, repeated rows are coded each; fewer ids than 16 give fewer entries.
    ``label_error`` is the sum of ``error`` over the rows of the same label (null ones together; beyond the long range: its end). Further
    columns are ignored. No usable row gives no rows."""
    rows = written(kept_rows(vectors.withColumns({"__label": F.col(label)}), vec_id, vector, ("__label",)), "vectors")
    coded = written(encode(rows, fit(rows), ("__label",)), "coded")
    by_label = coded.groupBy("__label").agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST).cast("decimal(38,0)")).cast("long").alias("label_error"))
    by_label = written(by_label.select(F.col("__label").alias("__of"), "label_error"), "label-errors")
    return coded.join(by_label, F.col("__label").eqNullSafe(F.col("__of"))).select(F.col("__id").alias(vec_id), "code", "error", "label_error", "codebooks_sha256")
