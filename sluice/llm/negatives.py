"""Hard negatives of anchor vectors by Fagin's threshold algorithm."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import written
from .codes import largest
from .topk import scaled, usable

#: Rows whose sorted lists are made at a time; anchors that go to the tasks at a time.
BLOCK, ANCHORS = 8192, 8192
#: Sorted access goes to this depth first, then so many times deeper at each step.
DEPTH, DEEPER = 16, 2
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these percentages of the positive's score.
LOW, HIGH = 30, 90


class Lists:
    """A block of vectors with one list per dimension, sorted by component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable").astype(np.int32)  # per dimension, from the least component
        self.values = np.take_along_axis(vectors, self.order, 0)
        self.largest = largest(vectors)

    def search(self, anchor: np.ndarray, allowed: np.ndarray, windows: list[Best]) -> None:
        """Offers every allowed row to the windows, from the lists' good ends inward.

        Dimension j is read from its largest component if the anchor's is positive, from its least if it is negative, and not at
        all if it is 0. After each step every row that was met is scored whole (random access); no row that was not met scores
        more than the threshold, the anchor's product with the components last read. A window is done once that falls
        strictly below its kth score, or below its lower end; the search ends when all are."""
        n, dims = len(self.ids), np.flatnonzero(anchor)
        kind = np.int64 if self.largest * largest(anchor) * max(1, len(anchor)) < 2 ** 62 else object
        sides = anchor[dims] > 0
        a = anchor.astype(kind)
        seen, depth, before = np.zeros(n, bool), DEPTH, 0
        while True:
            depth = min(depth, n)
            if len(dims):
                top, bottom = dims[sides], dims[~sides]
                met = np.concatenate([self.order[n - depth:n - before, top].ravel(), self.order[before:depth, bottom].ravel()])
                last = np.where(sides, self.values[n - depth, dims], self.values[depth - 1, dims])
                threshold = int((a[dims] * last.astype(kind)).sum())
            else:  # a zero anchor scores 0 with every row
                met, threshold, depth = np.arange(n), 0, n
            fresh = np.zeros(n, bool)
            fresh[met] = True
            fresh &= ~seen
            seen |= fresh
            at = np.flatnonzero(fresh & allowed)
            if len(at):
                score = self._scores(at, a)
                for w in windows:
                    w.offer(score, self.ids[at])
            if depth == n or all(w.done(threshold) for w in windows):
                return
            before, depth = depth, depth * DEEPER

    def _scores(self, at: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        if anchor.dtype == object:
            return self.vectors[at].astype(object) @ anchor
        return self.vectors[at] @ anchor


class Best:
    """The k best (score, id) with a score from ``low`` to ``high`` (None: open), ties to the smaller id."""

    def __init__(self, k: int, low: int | None = None, high: int | None = None):
        self.k, self.low, self.high = k, low, high
        self.score, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def offer(self, score: np.ndarray, ids: np.ndarray) -> None:
        floor = self.low
        if len(self.score) == self.k:
            floor = int(self.score[-1]) if floor is None else max(floor, int(self.score[-1]))
        ok = np.ones(len(score), bool)
        if floor is not None:
            ok &= score >= floor
        if self.high is not None:
            ok &= score <= self.high
        if not ok.any():
            return
        score, ids = np.concatenate([self.score, score[ok]]), np.concatenate([self.ids, ids[ok]])
        best = np.lexsort((ids, -score))[:self.k]
        self.score, self.ids = score[best], ids[best]

    def done(self, threshold: int) -> bool:
        return (self.low is not None and threshold < self.low) or (len(self.score) == self.k and threshold < self.score[-1])


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), len(flat) // max(1, len(column)))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Lists]:
    """Blocks of up to BLOCK rows of one dimension; a task holds one batch and one open block per dimension."""
    held: dict[int, list[tuple]] = {}
    for batch in batches:
        size = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
        for d in np.unique(size):
            rows = batch.filter(pa.array(size == d))
            own = held.setdefault(int(d), [])
            own.append((rows.column(0).to_numpy(), rows.column(1).to_numpy(), _matrix(rows.column(2))))
            while sum(len(x[0]) for x in own) >= BLOCK:
                joined = [np.concatenate(x) for x in zip(*own, strict=True)]
                yield Lists(*[x[:BLOCK] for x in joined])
                own[:] = [tuple(x[BLOCK:] for x in joined)]
    for own in held.values():
        joined = [np.concatenate(x) for x in zip(*own, strict=True)]
        if len(joined[0]):
            yield Lists(*joined)


def _searched(rows: DataFrame, asked: DataFrame, same_label: bool, k: int) -> DataFrame:
    """(anchor, window, id, score): what each candidate partition has for every window of the anchors, at most k a window.

    ``asked``: anchor, label, v, windows (array of (window, low, high)). Anchors go to the tasks in groups of about ANCHORS,
    each group through the whole candidate table, whose rows are never shuffled; a task keeps its windows over all its blocks, so their kth
    scores rise from block to block."""
    spark = rows.sparkSession
    n = asked.count()
    groups = max(1, -(-n // ANCHORS))
    out = None
    for g in range(groups):
        part = asked if groups == 1 else asked.where(F.pmod(F.xxhash64("anchor"), F.lit(groups)) == g)
        table = spark.sparkContext.broadcast(part.select("anchor", "label", "v", "windows").toArrow())

        def run(batches: Iterator[pa.RecordBatch], table=table) -> Iterator[pa.RecordBatch]:
            own: dict[int, list] = {}
            for r in table.value.to_pylist():
                ends = [Best(k, w["low"], w["high"]) for w in r["windows"]]
                own.setdefault(len(r["v"]), []).append((r["anchor"], r["label"], np.array(r["v"], np.int64), [w["window"] for w in r["windows"]], ends))
            for block in _blocks(batches):
                for anchor, label, v, _, windows in own.get(block.vectors.shape[1], ()):
                    allowed = (block.labels == label) & (block.ids != anchor) if same_label else block.labels != label
                    if allowed.any():
                        block.search(v, allowed, windows)
            for anchors in own.values():
                found = [(anchor, name, w) for anchor, _, _, names, windows in anchors for name, w in zip(names, windows, strict=True) if len(w.ids)]
                for at in range(0, len(found), 1000):
                    some = found[at:at + 1000]
                    size = [len(w.ids) for _, _, w in some]
                    score = np.concatenate([w.score for _, _, w in some])
                    score = np.array([max(-2 ** 63, min(2 ** 63 - 1, int(x))) for x in score], np.int64) if score.dtype == object else score
                    yield pa.record_batch([pa.array(np.repeat([x[0] for x in some], size)), pa.array(np.repeat([x[1] for x in some], size)),
                                           pa.array(np.concatenate([w.ids for _, _, w in some])), pa.array(score)], names=["anchor", "window", "id", "score"])

        found = written(rows.select("id", "label", "v").mapInArrow(run, "anchor bigint, window bigint, id bigint, score bigint"), "found")
        out = found if out is None else out.unionByName(found)
    best = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every anchor and each of its 5 best rows of the
    same label, the 10 best rows of another label whose score is 30 to 90 percent of that row's.

    A score is the inner product with the anchor of components floor(256 * x) (beyond the long range: its end; so too a
    score); ties go to the smaller id, fewer rows where there are fewer.
    Rows whose id, label or vector is null, or whose vector holds null or non-finite components, take no part; only vectors of
    equal dimension are compared. Repeated rows are candidates each; of a repeated anchor id the least (label, vector) is the
    anchor, and rows of its id aren't its positives. Further columns are ignored. No usable row gives no rows."""
    clean = (vectors.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & usable(F.col(vector)))
             .select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), scaled(F.col(vector)).alias("v"), is_anchor.alias("is_anchor")))
    clean = written(clean, "labelled")
    anchors = clean.where("is_anchor").groupBy("id").agg(F.min(F.struct("label", "v")).alias("a")).select(F.col("id").alias("anchor"), "a.*")
    anchors = written(anchors, "anchors")
    nothing = F.lit(None).cast("long")
    everything = F.array(F.struct(F.lit(0).cast("long").alias("window"), nothing.alias("low"), nothing.alias("high")))
    positives = written(_searched(clean, anchors.withColumn("windows", everything), True, POSITIVES)
                        .select("anchor", F.col("rank").cast("long").alias("window"), F.col("id").alias("positive"), F.col("score").alias("positive_score")), "positives")
    p = F.col("positive_score").cast("decimal(38,0)")
    low, high = F.ceil(p * LOW / 100), F.floor(p * HIGH / 100)
    asked = (positives.where("positive_score >= 0")  # below zero, 30 percent is more than 90
             .select("anchor", F.struct("window", low.cast("long").alias("low"), high.cast("long").alias("high")).alias("w"))
             .groupBy("anchor").agg(F.sort_array(F.collect_list("w")).alias("windows")).join(anchors, "anchor"))
    found = _searched(clean, written(asked, "windows"), False, NEGATIVES)
    return found.join(positives, ["anchor", "window"]).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
