"""Deterministic global numbering and fixed-size batches without a single-partition window.

A global ``row_number() over (order by key)`` sends every row to one task. Here rows are range-partitioned by
the full key, sorted inside their partition and written once to the shared folder together with their partition and
their place in it. A running sum over the partitions (one row each) gives every partition its offset, and offset plus
place is the rank.

Split points are Spark's own, from an unbiased sample of full keys, so any orderable key works, there are as many ranges
as the data needs, and rows that tie in the leading key are split by the rest of it. They differ between two evaluations;
as the written table is the only one that is read, every later evaluation and every retry agrees. The place of a row in the
input ends the key, so rows that are equal in it are split as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sizing import counted, is_scan, materialised

_POS_BITS = 33  # monotonically_increasing_id = partition_index << 33 | row position
ROWS_PER_RANGE = 2_000_000


def global_rank(df: DataFrame, order_by: list[str], rank_col: str = "rank",
                partitions: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """Add a dense 1-based rank in ``order_by`` order (keys should be unique for a total order; a row's place in the input
    comes last in the key, so equal keys are split too). ``keep`` names the columns that are written and returned with the
    rank, all of them by default."""
    spark = df.sparkSession
    keys = [k if isinstance(k, str) else k._jc.toString() for k in order_by]
    if is_scan(df):  # the sample and the ranges read the files
        once, rows = df, None
    else:  # they read this, not what made it
        once, rows = counted(df, "rank-input")
    n = partitions
    if n is None:
        rows = once.count() if rows is None else rows
        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_RANGE))
    once = once.withColumn("_place", F.monotonically_increasing_id())
    ranged = once.repartitionByRange(n, *keys, "_place").sortWithinPartitions(*keys, "_place").drop("_place")
    part = F.spark_partition_id().cast("long")
    cols = df.columns if keep is None else keep
    placed = materialised(ranged.select(*cols, part.alias("_range"), (
        F.monotonically_increasing_id() - F.shiftleft(part, _POS_BITS)).alias("_pos")), "rank-ranges")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range: rows / ROWS_PER_RANGE. The hint, as Spark takes an aggregate for as large as its input and would shuffle the rows
    offsets = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"))
    ranked = placed.join(F.broadcast(offsets), "_range").withColumn(rank_col, F.col("_off") + F.col("_pos") + 1)
    return ranked.select(*cols, rank_col)


def batch_ids(df: DataFrame, size: int, order_by: list[str | Column] | None = None,
              batch_col: str = "batch_id") -> DataFrame:
    """Number rows into batches of at most ``size``.

    With ``order_by`` the batches are deterministic (``(rank - 1) // size``).
    Without it rows are batched inside their own partition (no shuffle), the
    fast path when only "at most N per batch" matters.
    """
    if size <= 0:
        raise ValueError("batch size must be positive")
    if order_by:
        ranked = global_rank(df, order_by, "_rank")
        return ranked.withColumn(batch_col, F.floor((F.col("_rank") - 1) / size).cast("long")) \
                     .withColumnRenamed("_rank", "batch_rank")
    part = F.spark_partition_id().cast("long")
    local = F.monotonically_increasing_id() - F.shiftleft(part, _POS_BITS)
    return df.withColumn(batch_col, F.concat_ws("-", part.cast("string"),
                                                 F.floor(local / size).cast("string")))


def batch_pack(df: DataFrame, size: int, order_by: list[str | Column] | None = None,
               batch_col: str = "batch_id") -> DataFrame:
    """Pack rows into ``(batch_id, n, rows array<struct>)`` with at most ``size`` rows per batch.

    Each collected group is bounded by ``size`` by construction.
    """
    cols = df.columns
    numbered = batch_ids(df, size, order_by, batch_col)
    if order_by:
        # order by rank only (rows may hold columns that are not orderable, e.g. VARIANT)
        packed = numbered.groupBy(batch_col).agg(
            F.array_sort(F.collect_list(F.struct(F.col("batch_rank").alias("_r"), F.struct(*cols).alias("_row"))),
                         lambda a, b: F.when(a["_r"] < b["_r"], -1).when(a["_r"] > b["_r"], 1).otherwise(0))
            .alias("_items"))
        return packed.select(batch_col, F.size("_items").cast("long").alias("n"),
                             F.transform("_items", lambda x: x["_row"]).alias("rows"))
    packed = numbered.groupBy(batch_col).agg(F.collect_list(F.struct(*cols)).alias("rows"))
    return packed.select(batch_col, F.size("rows").cast("long").alias("n"), "rows")
