"""Queries for typed records: validation, conformance, replace, diff, TSV codec, mapping walk."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.convert import datetime_digits
from ..operators import records as rec
from ..operators.mapping import flatten_by_mapping
from ..spec import BooleanField, DateTimeField, FloatField, IntegerField, RecordSpec, StringField
from . import derive
from .registry import query

CUSTOMER = RecordSpec(
    IntegerField("c_custkey", nullable=False), StringField("c_name", length=18), IntegerField("c_nationkey"),
    FloatField("c_acctbal"), StringField("c_mktsegment", length=10, nullable=False))

EVENTS = RecordSpec(
    IntegerField("event_id", nullable=False), DateTimeField("ts"), IntegerField("user_id"),
    StringField("event_type", length=5, truncate=True), FloatField("value"),
    StringField("props", normalize_whitespace=True), BooleanField("is_big"))

MAPPED = RecordSpec(
    IntegerField("event_id"), StringField("event_type", length=8), FloatField("value"), DateTimeField("ts"),
    BooleanField("flag"), IntegerField("user_id"), StringField("tags"))
MAPPING = {
    "root.Event.ID": "event_id", "root.event.type": "event_type", "root.context.type": "event_type",
    "root.event.meta.value": "value", "root.event.meta.when": "ts", "root.event.meta.flag": "flag",
    "root.user.id": "user_id", "root.event.meta.tags": "tags",
}

MAPS = RecordSpec(StringField("s", length=12), IntegerField("i"), FloatField("f"), BooleanField("b"),
                  DateTimeField("t"), StringField("source", length=20), FloatField("value2"))
MAPS_MAPPING = {"root.s": "s", "root.i": "i", "root.f": "f", "root.b": "b", "root.t": "t"}

TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _s(c):
    return derive.s(c)


def customer_json(spark, sf_dir, corrupt=True, drop_acctbal=False, extra=True):
    c = derive.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    name = F.when(k % 13 == 0, F.concat("c_name", F.lit("XX"))).otherwise(F.col("c_name")) if corrupt else F.col("c_name")
    nat = F.when(k % 23 == 0, F.lit("3.5")).otherwise(_s("c_nationkey")) if corrupt else _s("c_nationkey")
    bal = F.when(k % 17 == 0, F.lit('"n/a"')).otherwise(_s("c_acctbal")) if corrupt else _s("c_acctbal")
    seg = F.when(k % 19 == 0, F.lit("null")).otherwise(F.concat(F.lit('"'), "c_mktsegment", F.lit('"'))) \
        if corrupt else F.concat(F.lit('"'), "c_mktsegment", F.lit('"'))
    bal_part = F.concat(F.lit(',"c_acctbal":'), bal)
    if drop_acctbal:
        bal_part = F.when(k % 7 == 0, F.lit("")).otherwise(bal_part)
    more = F.when(k % 29 == 0, F.lit(',"c_comment":"x"')).otherwise(F.lit("")) if extra else F.lit("")
    j = F.concat(F.lit('{"c_custkey":'), _s(k), F.lit(',"c_name":"'), name, F.lit('","c_nationkey":'), nat, bal_part,
                 F.lit(',"c_mktsegment":'), seg, more, F.lit("}"))
    return c.select(k.alias("src_key"), j.alias("json"))


@query("record_validate", """
SELECT c_custkey, concat_ws('; ',
  CASE WHEN c_custkey % 29 = 0 THEN '*: Unknown fields specified: c_comment' END,
  CASE WHEN c_custkey % 13 = 0 THEN 'c_name: The string length exceeds the maximum allowed' END,
  CASE WHEN c_custkey % 23 = 0 THEN 'c_nationkey: The value is not an integer' END,
  CASE WHEN c_custkey % 17 = 0 THEN 'c_acctbal: The value is not a floating point number' END,
  CASE WHEN c_custkey % 19 = 0 THEN 'c_mktsegment: The field cannot accept null values' END) AS error_text
FROM customer""")
def q_record_validate(spark, sf_dir):
    d = rec.conform_json(customer_json(spark, sf_dir), "json", CUSTOMER)
    return d.select("c_custkey", rec.error_text("errors").alias("error_text"))


@query("record_sparse_fill", """
SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal, '' AS error_text
FROM customer""")
def q_record_sparse_fill(spark, sf_dir):
    j = customer_json(spark, sf_dir, corrupt=False, drop_acctbal=True, extra=False)
    d = rec.conform_json(j, "json", CUSTOMER, sparse=True)
    return d.select("c_custkey", "c_acctbal", rec.error_text("errors").alias("error_text"))


@query("record_unknown_fields", """
SELECT c_custkey, CASE WHEN c_custkey % 29 = 0 THEN '*: Unknown fields specified: c_comment' ELSE '' END
       AS error_text FROM customer""")
def q_record_unknown_fields(spark, sf_dir):
    d = rec.conform_json(customer_json(spark, sf_dir, corrupt=False), "json", CUSTOMER)
    return d.select("c_custkey", rec.error_text("errors").alias("error_text"))


@query("record_replace", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || '-updated' ELSE c_name END AS c_name,
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'c_name: The string length exceeds the maximum allowed' ELSE '' END
       AS error_text FROM customer""")
def q_record_replace(spark, sf_dir):
    c = rec.conform(derive.table(spark, sf_dir, "customer").select(*CUSTOMER.names), CUSTOMER)
    new_name = F.when(F.col("c_mktsegment") == "BUILDING", F.concat("c_name", F.lit("-updated"))).otherwise(
        F.col("c_name"))
    d = rec.record_replace(c, CUSTOMER, c_name=new_name)
    return d.select("c_custkey", "c_name", rec.error_text("errors").alias("error_text"))


@query("record_diff", """
WITH a AS (SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer),
bb AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal + CASE WHEN c_custkey % 11 = 0 THEN 1 ELSE 0 END AS c_acctbal,
              c_mktsegment FROM a WHERE c_custkey % 37 <> 0),
b AS (SELECT * FROM bb UNION ALL SELECT * FROM bb WHERE c_custkey % 41 = 0)
SELECT *, 'left' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL
SELECT *, 'right' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def q_record_diff(spark, sf_dir):
    a = rec.conform(derive.table(spark, sf_dir, "customer").select(*CUSTOMER.names), CUSTOMER)
    k = F.col("c_custkey")
    bb = a.where(k % 37 != 0).withColumn("c_acctbal", F.col("c_acctbal") + F.when(k % 11 == 0, 1).otherwise(0))
    b = bb.unionByName(bb.where(k % 41 == 0))
    return rec.record_diff(a, b)


def events_typed(spark, sf_dir):
    e = derive.table(spark, sf_dir, "events")
    k = F.col("event_id")
    return e.select("event_id", F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("ts")).cast("timestamp").alias("ts"),
                    F.when(k % 13 == 0, F.lit(None)).otherwise(F.col("user_id")).alias("user_id"),
                    "event_type", "value", "props", (F.col("value") > 20).alias("is_big"))


EVENTS_TSV_SQL = r"""
WITH ex AS (SELECT event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts END AS ts_x,
                   CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id END AS user_x, event_type, value, props
            FROM events),
enc AS (SELECT *, concat_ws(chr(9), CAST(event_id AS VARCHAR), coalesce(strftime(ts_x, '%Y-%m-%d %H:%M:%S.%f'), '\N'),
                   coalesce(CAST(user_x AS VARCHAR), '\N'), substr(event_type, 1, 5), CAST(value AS VARCHAR),
                   regexp_replace(props, '\s+', ' ', 'g'), CASE WHEN value > 20 THEN '1' ELSE '0' END) AS line
        FROM ex)
"""


@query("tsv_encode", EVENTS_TSV_SQL + "SELECT event_id, line FROM enc")
def q_tsv_encode(spark, sf_dir):
    return rec.tsv_encode(events_typed(spark, sf_dir), EVENTS, keep=["event_id"])


@query("tsv_decode", EVENTS_TSV_SQL + r"""
SELECT event_id AS src_id,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_id END AS event_id,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE strftime(ts_x, '%Y-%m-%d %H:%M:%S.%f') END AS ts,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_x END AS user_id,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE substr(event_type, 1, 5) END AS event_type,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS value,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE regexp_replace(props, '\s+', ' ', 'g') END AS props,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE value > 20 END AS is_big,
  CASE WHEN event_id % 97 = 0
       THEN '*: The length of the tuple of strings must exactly match the number of fields in the Record'
       ELSE '' END AS error_text
FROM enc""")
def q_tsv_decode(spark, sf_dir):
    lines = rec.tsv_encode(events_typed(spark, sf_dir), EVENTS, keep=["event_id"])
    lines = lines.select(F.col("event_id").alias("src_id"), F.when(F.col("event_id") % 97 == 0, F.concat(
        "line", F.lit("\textra"))).otherwise(F.col("line")).alias("line"))
    d = rec.tsv_decode(lines, EVENTS, keep=["src_id"])
    return d.select("src_id", "event_id", F.date_format("ts", TS_FMT).alias("ts"), "user_id", "event_type", "value",
                    "props", "is_big", rec.error_text("errors").alias("error_text"))


@query("datetime_digits", """
WITH t AS (SELECT event_id, ts, (epoch_us(ts) % 1000000) // 1000 AS ms FROM events)
SELECT event_id,
  CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') WHEN 1 THEN strftime(ts, '%Y/%m/%d %H:%M:%S')
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.' || lpad(CAST(ms AS VARCHAR), 3, '0') END AS text,
  CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
       WHEN 1 THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f')
       ELSE strftime(date_trunc('second', ts) + to_microseconds(ms), '%Y-%m-%d %H:%M:%S.%f') END AS parsed
FROM t""")
def q_datetime_digits(spark, sf_dir):
    e = derive.table(spark, sf_dir, "events")
    k = F.col("event_id") % 3
    text = F.when(k == 0, F.date_format("ts", TS_FMT)).when(k == 1, F.date_format("ts", "yyyy/MM/dd HH:mm:ss")) \
            .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
    d = e.select("event_id", text.alias("text"))
    return d.select("event_id", "text", F.date_format(datetime_digits("text"), TS_FMT).alias("parsed"))


def mapped_events(spark, sf_dir):
    e = derive.table(spark, sf_dir, "events")
    k = F.col("event_id")
    val = F.when(k % 4 == 0, F.lit('"bad"')).when(k % 4 == 1, F.concat(F.lit('"'), _s("value"), F.lit('"'))) \
           .otherwise(_s("value"))
    when = F.when(k % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).when(
        k % 3 == 1, F.concat(F.date_format(F.col("ts") + F.expr("interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                             F.lit("+02:00"))).otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                                                                  F.lit("Z")))
    flag = F.when(k % 2 == 0, F.lit('"false"')).otherwise(F.lit("false"))
    ctx = F.when(k % 6 == 0, F.lit(',"context":{"type":"CTX-override"}')).otherwise(F.lit(""))
    user = F.when(k % 5 == 0, F.lit("null")).otherwise(F.concat(F.lit('{"Id":"'), _s("user_id"), F.lit('"}')))
    j = F.concat(F.lit('{"Event":{"ID":'), _s(k), F.lit(',"Type":"'), F.col("event_type"), F.lit('","Meta":{"Value":'),
                 val, F.lit(',"When":"'), when, F.lit('","Flag":'), flag, F.lit(',"Tags":["a","b"]}}'), ctx,
                 F.lit(',"user":'), user, F.lit("}"))
    return e.select("event_id", j.alias("json"))


@query("flatten_by_mapping", """
SELECT event_id, CASE WHEN event_id % 6 = 0 THEN 'CTX-...' ELSE event_type END AS event_type,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS value,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS ts,
  event_id % 2 = 0 AS flag, CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id END AS user_id,
  CAST(NULL AS VARCHAR) AS tags
FROM events""")
def q_flatten_by_mapping(spark, sf_dir):
    d = flatten_by_mapping(mapped_events(spark, sf_dir), "json", MAPPING, MAPPED)
    return d.select("event_id", "event_type", "value", F.date_format("ts", TS_FMT).alias("ts"), "flag", "user_id",
                    "tags")


def map_events(spark, sf_dir):
    e = derive.table(spark, sf_dir, "events")
    k = F.col("event_id")
    s = F.when(k % 4 == 0, F.lit('"tab\\tx"')).when(
        k % 4 == 1, F.concat(F.lit('"'), F.col("event_type"), F.lit("-"), _s(k), F.lit('-long-suffix"'))).when(
        k % 4 == 2, F.lit("12.5")).otherwise(F.lit("true"))
    i = F.when(k % 5 == 0, F.lit('" 42 "')).when(k % 5 == 1, F.lit("3.7")).when(k % 5 == 2, F.lit('"3.7"')).when(
        k % 5 == 3, F.lit("true")).otherwise(_s("user_id"))
    f = F.when(k % 4 == 0, F.lit('"1e3"')).when(k % 4 == 1, F.lit('"abc"')).when(k % 4 == 2, F.lit("false")) \
         .otherwise(_s("value"))
    b = F.when(k % 4 == 0, F.lit('""')).when(k % 4 == 1, F.lit('"false"')).when(k % 4 == 2, F.lit("0")) \
         .otherwise(F.lit("2.5"))
    t = F.when(k % 4 == 0, F.concat(F.lit('"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit('Z"'))).when(
        k % 4 == 1, F.lit('"1899-12-31T00:00:00Z"')).when(
        k % 4 == 2, F.concat(F.lit('"'), F.date_format("ts", "yyyyMMdd'T'HHmmss"), F.lit('Z"'))).otherwise(
        F.lit('"2024-01-01T10:00"'))
    j = F.concat(F.lit('{"s":'), s, F.lit(',"i":'), i, F.lit(',"f":'), f, F.lit(',"b":'), b, F.lit(',"t":'), t,
                 F.lit("}"))
    d = e.select("event_id", "value", j.alias("json"))
    return flatten_by_mapping(d, "json", MAPS_MAPPING, MAPS, keep=["event_id"],
                              calculated={"source": F.lit("events"), "value2": F.col("value") * 2})


@query("map_string", """
WITH x AS (SELECT event_id, event_type || '-' || CAST(event_id AS VARCHAR) || '-long-suffix' AS lng FROM events)
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'tab\\tx'
  WHEN 1 THEN CASE WHEN length(lng) > 12 THEN substr(lng, 1, 8) || '...' ELSE lng END
  WHEN 2 THEN '12.5' ELSE 'True' END AS s FROM x""")
def q_map_string(spark, sf_dir):
    return map_events(spark, sf_dir).select("event_id", "s")


@query("map_int", """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN 42 WHEN 1 THEN 3 WHEN 2 THEN NULL WHEN 3 THEN 1 ELSE user_id END AS i
FROM events""")
def q_map_int(spark, sf_dir):
    return map_events(spark, sf_dir).select("event_id", "i")


@query("map_float", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 1000.0 WHEN 1 THEN NULL WHEN 2 THEN 0.0 ELSE value END AS f
FROM events""")
def q_map_float(spark, sf_dir):
    return map_events(spark, sf_dir).select("event_id", "f")


@query("map_bool", "SELECT event_id, event_id % 4 IN (1, 3) AS b FROM events")
def q_map_bool(spark, sf_dir):
    return map_events(spark, sf_dir).select("event_id", "b")


@query("map_datetime", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
  WHEN 2 THEN strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') END AS t FROM events""")
def q_map_datetime(spark, sf_dir):
    return map_events(spark, sf_dir).select("event_id", F.date_format("t", TS_FMT).alias("t"))


@query("map_calculated", "SELECT event_id, 'events' AS source, value * 2 AS value2 FROM events")
def q_map_calculated(spark, sf_dir):
    return map_events(spark, sf_dir).select("event_id", "source", "value2")
