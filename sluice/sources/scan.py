"""Projected scans: ``SELECT cols FROM t [WHERE raw_sql]`` as a pruned, pushed-down read."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def raw_condition(where: str | None) -> Column | None:
    """A raw SQL condition; the keyword ``WHERE`` in front is optional. None if there is no text."""
    text = re.sub(r"(?is)^\s*where(?![\w.`])", "", where or "").strip()
    return F.expr(text) if text else None


def projected_scan(df: DataFrame, columns: list[str], where: str | None = None) -> DataFrame:
    """Columns of a table, optionally filtered by a raw SQL condition (``WHERE`` keyword optional).

    The condition and the column list reach the file scan (Parquet pushdown
    and column pruning); no ordering is implied.
    """
    condition = raw_condition(where)
    out = df if condition is None else df.where(condition)
    return out.select(*columns)
