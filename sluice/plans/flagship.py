"""The flagship query: landing -> date slice -> high-water mark -> counts and new mark per type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import iso_format
from ..operators.sync import high_water_filter
from ..sinks.guard import slice_date
from ..sources.landing import variant_landing
from . import derive
from .registry import query

FLAGSHIP_DAY = "2024-01-07"
FLAGSHIP_MARK = "2024-01-07 12:00:00"

FLAGSHIP_SQL = f"""
SELECT event_type, count(*) AS rows_after_mark,
       strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS new_mark
FROM events
WHERE event_id % 10 <> 0 AND CAST(ts AS DATE) = DATE '{FLAGSHIP_DAY}'
  AND date_trunc('second', ts) > TIMESTAMP '{FLAGSHIP_MARK}'
GROUP BY event_type"""


@query("flagship_landing_sync", FLAGSHIP_SQL)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = derive.events_ndjson(spark, sf_dir)
    landed = variant_landing(spark, root, line_numbers=False)
    p = F.col("properties")
    day = landed.where(slice_date("date", FLAGSHIP_DAY)).select(
        F.try_variant_get(p, "$.event_type", "string").alias("event_type"),
        F.try_variant_get(p, "$.date", "timestamp_ntz").alias("modified"))
    fresh = high_water_filter(day, "modified", FLAGSHIP_MARK)
    return fresh.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows_after_mark"),
                                           iso_format(F.max("modified")).alias("new_mark"))
