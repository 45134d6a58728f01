"""Small sides of joins: computed once, their size known to the optimizer."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import scratch_path


def materialised(df: DataFrame, name: str = "side") -> DataFrame:
    """``df`` computed once and written to the shared folder. Reading it back gives Spark its true size in bytes, so the
    optimizer broadcasts it below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it above; nothing is forced."""
    path = scratch_path(df.sparkSession, "sides", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def observed(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """:func:`materialised` with aggregates of its rows, taken while they were written."""
    seen = Observation(f"{name}_{uuid.uuid4().hex[:8]}")
    out = materialised(df.observe(seen, *[c.alias(k) for k, c in measures.items()]), name)
    return out, seen.get


def counted(df: DataFrame, name: str = "side") -> tuple[DataFrame, int]:
    """:func:`materialised` with the number of rows."""
    out, seen = observed(df, name, n=F.count(F.lit(1)))
    return out, int(seen.get("n") or 0)


def is_scan(df: DataFrame) -> bool:
    """True if ``df`` is a file scan with at most projections and filters on top: as cheap to read again as a copy."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return all(re.match(r"[\s:+-]*(Project \[|Filter |Relation \[)", line) for line in plan.strip().split("\n"))
