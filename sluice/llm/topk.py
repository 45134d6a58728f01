"""Exact top-k by inner product over length buckets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from .common import written

#: Length classes are this fine: vectors of one class differ in length by at most about 3 %.
CLASSES_PER_E = 32
#: Candidates and queries of one task's group; a class with more candidates is dealt to several groups.
CANDIDATES, QUERIES = 8192, 4096
#: The longest vectors, that give every query its first threshold.
SEEDS = 1024
#: From this local cosine threshold on, candidates are pruned by coordinates, below it by length.
BY_COORDINATE = 0.6
#: Coordinates that a query prunes by: its largest.
FOCUS = 3
LEAST = -(2 ** 63) + 1


def scaled(vector: Column, factor: int = 256) -> Column:
    """floor(factor * x) of every component as long; components beyond the long range stop at its ends."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long"))


def usable(vector: Column) -> Column:
    """True for a vector that is not null and holds only finite components."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (
        F.abs(x.cast("double")) < float("inf")))


def products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact integer inner products, stopped at the ends of the long range."""
    if queries.size == 0 or candidates.size == 0:
        return np.zeros((len(queries), len(candidates)), np.int64)
    bound = float(np.abs(queries.astype(np.float64)).max()) * float(np.abs(candidates.astype(np.float64)).max()) * queries.shape[1]
    if bound < 2.0 ** 53:  # every partial sum is exact in a double
        return np.rint(queries.astype(np.float64) @ candidates.T.astype(np.float64)).astype(np.int64)
    if bound < 2.0 ** 62:
        return queries @ candidates.T
    exact = queries.astype(object) @ candidates.T.astype(object)
    return np.clip(exact, LEAST, 2 ** 63 - 1).astype(np.int64)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    at = np.arange(len(score))
    if len(score) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return at[np.lexsort((ids[at], -score[at]))[:k]]


def search_group(q_ids, q, q_len, theta, c_ids, c, c_len, k: int) -> Iterator[tuple[int, int, int]]:
    """(query, candidate, score) of what of one bucket can be among a query's k best.

    theta is a score that k candidates are known to reach (-inf if unknown), so nothing below it counts. A candidate of
    length l reaches it only if l * |q| >= theta, and then only with a cosine of at least theta / (|q| * l)."""
    order = np.argsort(-c_len, kind="stable")
    c_ids, c, c_len = c_ids[order], c[order], c_len[order]
    unit = c / np.maximum(c_len, 1e-300)[:, None]
    longest = c_len[0]
    q_unit = q / np.maximum(q_len, 1e-300)[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where(theta > 0, theta / (q_len * longest), 0.0)
    whole = []
    for i in range(len(q)):
        if local[i] < BY_COORDINATE or local[i] > 1 + 1e-9:
            whole.append(i)
            continue
        keep = np.ones(len(c), bool)
        reach = np.arccos(min(1.0, local[i]))
        for f in np.argsort(-np.abs(q_unit[i]), kind="stable")[:FOCUS]:
            # the angle between a candidate and q is at most `reach`, so their angles to axis f differ by no more
            angle = np.arccos(np.clip(q_unit[i, f], -1.0, 1.0))
            low, high = np.cos(min(np.pi, angle + reach)), np.cos(max(0.0, angle - reach))
            keep &= (unit[:, f] >= low - 1e-9) & (unit[:, f] <= high + 1e-9)
        at = np.flatnonzero(keep)
        if len(at):
            yield from _taken(q_ids[i], theta[i], c_ids[at], products(q[i:i + 1], c[at])[0], k)
    for tile in range(0, len(whole), 256):
        rows = np.array(whole[tile:tile + 256])
        with np.errstate(divide="ignore", invalid="ignore"):
            shortest = np.where(theta[rows] > 0, theta[rows] / q_len[rows] * (1 - 1e-9), 0.0)
        ends = np.searchsorted(-c_len, -np.nan_to_num(shortest, nan=0.0), side="right")
        if not ends.max():
            continue
        score = products(q[rows], c[:ends.max()])
        for j, i in enumerate(rows):
            yield from _taken(q_ids[i], theta[i], c_ids[:ends[j]], score[j, :ends[j]], k)


def _taken(q_id: int, theta: float, ids: np.ndarray, score: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    ok = np.flatnonzero((score >= theta) & (ids != q_id))
    if len(ok):
        for at in _best(score[ok], ids[ok], k):
            yield int(q_id), int(ids[ok[at]]), int(score[ok[at]])


def _stack(column: pd.Series, width: int) -> np.ndarray:
    return np.array(column.tolist(), np.int64).reshape(len(column), width)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best candidates by integer inner product of the scaled vectors, ties
    to the smaller id; fewer where there are fewer.

    A query's candidates are all rows but those of its own id. Rows whose id is null, or whose vector is null or holds
    null or non-finite components, take no part; only vectors of equal dimension are compared (an empty vector scores 0
    against empty ones). Repeated rows are candidates each; of a repeated query id the least vector is the query. No
    usable row gives no rows. Further columns are ignored."""
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    rows = (vectors.where(F.col(vec_id).isNotNull() & usable(F.col(vector)))
            .select(F.col(vec_id).cast("long").alias("id"), is_query.alias("is_query"), scaled(F.col(vector)).alias("v"))
            .withColumn("len", length).withColumn("dim", F.size("v"))
            .withColumn("class", F.when(F.col("len") > 0, F.floor(F.log("len") * CLASSES_PER_E)).otherwise(F.lit(-1)).cast("int")))
    rows = written(rows, "vectors")
    seeds = rows.orderBy(F.desc("len"), "id").select("id", "v", "dim").limit(SEEDS).collect()
    by_dim = {}
    for d in {s["dim"] for s in seeds}:
        own = [s for s in seeds if s["dim"] == d]
        by_dim[d] = (np.array([s["id"] for s in own], np.int64), np.array([s["v"] for s in own], np.int64).reshape(len(own), d))
    first = rows.sparkSession.sparkContext.broadcast(by_dim)  # SEEDS vectors

    def threshold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            theta = np.full(len(batch), -np.inf)
            for d, part in batch.groupby("dim"):
                ids, table = first.value.get(d, (np.empty(0, np.int64), None))
                at = batch.index.get_indexer(part.index)
                for j in range(0, len(part) if len(ids) else 0, 256):
                    score = products(_stack(part["v"][j:j + 256], d), table)
                    for i, s in enumerate(score):
                        s = np.sort(s[ids != part["id"].iloc[j + i]])
                        if len(s) >= k:
                            theta[at[j + i]] = s[-k]
            yield batch.assign(theta=theta)

    queries = rows.where("is_query").groupBy("id").agg(F.min(F.struct("v", "len", "dim")).alias("q")).select("id", "q.*")
    schema = T.StructType([*queries.schema.fields, T.StructField("theta", T.DoubleType())])
    queries = written(queries.mapInPandas(threshold, schema), "queries")
    n_queries = queries.count()
    q_blocks = max(1, -(-n_queries // QUERIES))
    # one row a dimension and length class: lengths span at most 1,500 powers of e
    classes = written(rows.groupBy("dim", "class").agg(F.max("len").alias("longest"), F.ceil(F.count(F.lit(1)) / CANDIDATES).cast("int").alias("blocks")), "classes")
    asked = (queries.withColumn("q_block", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(q_blocks)).cast("int")).alias("q")
             .join(classes.alias("c"), (F.col("q.dim") == F.col("c.dim")) & (
                 (F.col("theta") <= 0) | (F.col("c.longest") * F.col("q.len") * (1 + 1e-9) >= F.col("theta"))))
             .select("q.id", "q.v", "q.len", "q.dim", "theta", "q_block", "class", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")))
    visited = asked.select("dim", "class", "q_block").distinct()
    candidates = (rows.join(classes.select("dim", "class", "blocks"), ["dim", "class"])
                  .withColumn("block", F.pmod(F.xxhash64(F.lit(2), "id", "v"), F.col("blocks")).cast("int"))
                  .join(visited, ["dim", "class"]).select("id", "v", "len", "dim", "class", "block", "q_block"))

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            d = int(key[0])
            out = list(search_group(left["id"].to_numpy(np.int64), _stack(left["v"], d), left["len"].to_numpy(float), left["theta"].to_numpy(float),
                                    right["id"].to_numpy(np.int64), _stack(right["v"], d), right["len"].to_numpy(float), k))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    candidates = candidates.toDF(*candidates.columns)
    by = ["dim", "class", "block", "q_block"]
    found = asked.groupBy(*by).cogroup(candidates.groupBy(*by)).applyInPandas(run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
