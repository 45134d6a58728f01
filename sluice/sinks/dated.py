"""Date-partitioned report sinks (skip dates already present) and sitemap sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.sizing import materialised
from ..session import path_exists


def present_partitions(df_or_spark, path: str, col: str) -> DataFrame:
    """Partition values already present under ``path`` (from the file listing only)."""
    from ..sources.files import object_inventory

    spark = getattr(df_or_spark, "sparkSession", df_or_spark)
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"{col} string")
    inv = object_inventory(spark, path)
    return inv.select(F.regexp_extract("path", f"/{col}=([^/]+)/", 1).alias(col)).where(
        F.col(col) != "").distinct()


def dated_report_sink(df: DataFrame, path: str, date_col: str = "report_date",
                      overwrite: bool = False, fmt: str = "json") -> DataFrame:
    """Write each date's rows under ``<path>/<date_col>=<date>/``.

    Existing dates are skipped unless ``overwrite`` (then they are replaced,
    other dates untouched). Returns ``(action, rows)`` per run.
    """
    spark = df.sparkSession
    todo = df
    if not overwrite:
        # one row per partition folder already written: broadcast once its size is checked
        present = materialised(present_partitions(spark, path, date_col))
        todo = df.join(present, df[date_col].cast("string") == present[date_col], "left_anti")
    obs = Observation(f"dated_{uuid.uuid4().hex[:8]}")
    (todo.observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(date_col).format(fmt).save(path))
    return spark.createDataFrame([("written", int(obs.get.get("n", 0)))], "action string, rows bigint")


def sitemap_sink(df: DataFrame, path: str, date: str, stem_col: str = "sitemap") -> DataFrame:
    """``(scraped_at, url, sitemap)`` rows -> ``<path>/scrape_date=<date>/sitemap=<stem>/`` JSON."""
    obs = Observation(f"sitemap_{uuid.uuid4().hex[:8]}")
    (df.withColumn("scrape_date", F.lit(date)).observe(obs, F.count(F.lit(1)).alias("n"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("scrape_date", stem_col).json(path))
    return df.sparkSession.createDataFrame([("written", int(obs.get.get("n", 0)))], "action string, rows bigint")
