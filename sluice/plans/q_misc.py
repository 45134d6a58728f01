"""Queries for generators (spines, missing slices, parameter products) and identifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import safe_course_id
from ..operators import spines
from . import derive
from .registry import query

BOUNDS_SQL = """
WITH b AS (SELECT o_orderstatus, min(CAST(o_orderdate AS DATE)) AS s, max(CAST(o_orderdate AS DATE)) AS e
           FROM orders GROUP BY 1),
spine AS (SELECT o_orderstatus, strftime(d, '%Y%m%d') AS date
          FROM (SELECT o_orderstatus, unnest(range(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS d
                FROM b))
"""


def _bounds(spark, sf_dir):
    o = derive.table(spark, sf_dir, "orders")
    return o.groupBy("o_orderstatus").agg(F.min(F.to_date("o_orderdate")).alias("s"),
                                          F.max(F.to_date("o_orderdate")).alias("e"))


@query("date_spine", BOUNDS_SQL + "SELECT * FROM spine")
def q_date_spine(spark, sf_dir):
    return spines.date_spine_from(_bounds(spark, sf_dir), "s", "e", keep=["o_orderstatus"])


@query("month_spine", """
WITH b AS (SELECT o_orderstatus, min(CAST(o_orderdate AS DATE)) AS s, max(CAST(o_orderdate AS DATE)) AS e
           FROM orders GROUP BY 1)
SELECT o_orderstatus, strftime(d, '%Y-%m-%d') AS month_start
FROM (SELECT o_orderstatus, unnest(range(CAST(date_trunc('month', s) AS TIMESTAMP),
             CAST(date_trunc('month', e) AS TIMESTAMP) + INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS d FROM b)""")
def q_month_spine(spark, sf_dir):
    return spines.month_spine_from(_bounds(spark, sf_dir), "s", "e", keep=["o_orderstatus"])


@query("missing_slices", BOUNDS_SQL + """
SELECT o_orderstatus, date FROM spine
EXCEPT SELECT DISTINCT o_orderstatus, strftime(o_orderdate, '%Y%m%d') AS date FROM orders""")
def q_missing_slices(spark, sf_dir):
    spine = spines.date_spine_from(_bounds(spark, sf_dir), "s", "e", keep=["o_orderstatus"])
    loaded = derive.table(spark, sf_dir, "orders").select(
        "o_orderstatus", F.date_format("o_orderdate", "yyyyMMdd").alias("date"))
    return spines.missing_slices(spine, loaded, ["o_orderstatus", "date"])


@query("param_product", """
SELECT r_name, c_mktsegment FROM region, (SELECT DISTINCT c_mktsegment FROM customer) s""")
def q_param_product(spark, sf_dir):
    regions = derive.table(spark, sf_dir, "region").select("r_name")
    segments = derive.table(spark, sf_dir, "customer").select("c_mktsegment").distinct()
    return spines.param_product(regions, segments)


COURSE_SQL = r"""
WITH c AS (SELECT p_partkey, CASE p_partkey % 4
    WHEN 0 THEN 'course-v1:' || replace(p_brand, '#', '') || '+' || p_type || '+' || CAST(p_size AS VARCHAR)
    WHEN 1 THEN replace(p_brand, '#', '') || '/' || p_type || '/' || CAST(p_size AS VARCHAR)
    WHEN 2 THEN 'not a key ' || p_name
    ELSE 'library-v1:' || replace(p_brand, '#', '') || '+' || CASE WHEN p_partkey % 8 = 3 THEN p_type ELSE replace(p_type, ' ', '.') END END AS course_id FROM part)
SELECT p_partkey, course_id,
  regexp_replace(CASE WHEN regexp_matches(course_id, '^course-v1:[\w\-~.:]+\+[\w\-~.:]+\+[\w\-~.:]+$')
                      THEN substr(course_id, 11)
                      WHEN regexp_matches(course_id, '^library-v1:[\w\-~.:]+\+[\w\-~.:]+$') THEN substr(course_id, 12) ELSE course_id END, '[^\w.\-]', '_', 'g') AS safe_id
FROM c"""


@query("safe_course_id", COURSE_SQL)
def q_safe_course_id(spark, sf_dir):
    p = derive.table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 4
    org = F.replace("p_brand", F.lit("#"), F.lit(""))
    cid = F.when(k == 0, F.concat(F.lit("course-v1:"), org, F.lit("+"), "p_type", F.lit("+"), derive.s("p_size"))) \
           .when(k == 1, F.concat(org, F.lit("/"), "p_type", F.lit("/"), derive.s("p_size"))) \
           .when(k == 2, F.concat(F.lit("not a key "), "p_name")) \
           .otherwise(F.concat(F.lit("library-v1:"), org, F.lit("+"), F.when(F.col("p_partkey") % 8 == 3, F.col("p_type")).otherwise(
               F.replace("p_type", F.lit(" "), F.lit(".")))))
    return p.select("p_partkey", cid.alias("course_id")).withColumn("safe_id", safe_course_id("course_id"))
