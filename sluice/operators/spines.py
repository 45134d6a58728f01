"""Date spines, missing slices and parameter products."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _bounds(spark: SparkSession, start: str | None, end: str | None) -> DataFrame:
    """One row of bounds; without a start it is yesterday, without an end today (the session's day)."""
    return spark.range(1).select(
        F.coalesce(F.to_date(F.lit(start or None)), F.date_sub(F.current_date(), 1)).alias("s"),
        F.coalesce(F.to_date(F.lit(end or None)), F.current_date()).alias("e"))


def date_spine(spark: SparkSession, start: str | None = None, end: str | None = None, fmt: str = "yyyyMMdd",
               col: str = "date") -> DataFrame:
    """Dates in ``[start, end)`` as text in ``fmt``; ``start >= end`` gives no rows. Defaults: yesterday, today."""
    return date_spine_from(_bounds(spark, start, end), "s", "e", fmt, col)


def date_spine_from(bounds: DataFrame, start_col: str, end_col: str, fmt: str = "yyyyMMdd",
                    col: str = "date", keep: list[str] | None = None) -> DataFrame:
    """Per row of ``bounds``: the dates in ``[start, end)`` (guarded: empty when start >= end)."""
    s, e = F.to_date(F.col(start_col)), F.to_date(F.col(end_col))
    seq = F.when(s < e, F.sequence(s, F.date_sub(e, 1))).otherwise(F.array().cast("array<date>"))
    return bounds.select(*(keep or []), F.explode(seq).alias("_d")).select(
        *(keep or []), F.date_format("_d", fmt).alias(col))


def month_spine_from(bounds: DataFrame, start_col: str, end_col: str, fmt: str = "yyyy-MM-dd",
                     col: str = "month_start", keep: list[str] | None = None) -> DataFrame:
    """First day of every month from start's month to end's month, inclusive."""
    s = F.trunc(F.to_date(F.col(start_col)), "MM")
    e = F.trunc(F.to_date(F.col(end_col)), "MM")
    seq = F.when(s <= e, F.sequence(s, e, F.expr("interval 1 month"))).otherwise(
        F.array().cast("array<date>"))
    return bounds.select(*(keep or []), F.explode(seq).alias("_d")).select(
        *(keep or []), F.date_format("_d", fmt).alias(col))


def month_spine(spark: SparkSession, start: str | None = None, end: str | None = None, fmt: str = "yyyy-MM-dd",
                col: str = "month_start") -> DataFrame:
    """First day of every month from start's month to end's month, inclusive. Defaults: yesterday, today."""
    return month_spine_from(_bounds(spark, start, end), "s", "e", fmt, col)


def missing_slices(spine: DataFrame, loaded: DataFrame, col: str | list[str] = "date") -> DataFrame:
    """Spine values that the target does not hold yet (each one is a load to run)."""
    cols = [col] if isinstance(col, str) else list(col)
    return spine.join(loaded.select(*cols).distinct(), cols, "left_anti")


def param_product(*lists: DataFrame) -> DataFrame:
    """Row-major cartesian product of parameter lists; columns are the "unzipped" lists.

    The product is the feature, so its size is that of the result; lists may have any length. Order is kept by an
    ``ordinal`` per list and a final sort.
    """
    if len(lists) < 2:
        raise ValueError("param_product needs two or more lists")
    out = None
    order = []
    for i, lst in enumerate(lists):
        part = lst.withColumn(f"_o{i}", F.monotonically_increasing_id())
        order.append(f"_o{i}")
        out = part if out is None else out.crossJoin(part)
    return out.orderBy(*order).drop(*order)
