"""Queries for incremental syncs: splits, high-water marks, lead payloads, batches, list caps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import delimited_list_cap, list_cap_error
from ..operators import sync
from ..operators.batching import batch_pack
from ..session import scratch_path
from . import derive
from .registry import query

MARK = "1999-01-01 00:00:00"
ORDERS_MARK = "1998-06-01 00:00:00"

LEADS_SQL = """
WITH o AS (SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
           FROM orders GROUP BY o_custkey),
leads AS (
  SELECT c_custkey,
    c_mktsegment AS audience,
    CASE WHEN c_acctbal >= 0 THEN 'true' ELSE 'false' END AS braze_hs_contact,
    CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 = 1 THEN ''
         ELSE 'prog-' || CAST(c_nationkey AS VARCHAR) || ';prog-x' END AS braze_programs,
    'city-' || CAST(c_nationkey AS VARCHAR) AS city,
    'C' || CAST(c_nationkey AS VARCHAR) AS country_iso_code,
    coalesce(first_order, TIMESTAMP '1990-01-01 00:00:00')
      + to_microseconds(CAST((c_custkey % 4) * 250000 AS BIGINT)) AS createdate,
    lower(replace(c_name, '#', '.')) || '@example.com' AS email,
    'conv-' || CAST(c_custkey % 7 AS VARCHAR) AS first_conversion_event_name,
    'First' || CAST(c_custkey AS VARCHAR) AS firstname,
    CASE WHEN c_acctbal > 5000 THEN 'masters' END AS highest_level_of_education,
    'hs-' || CAST(c_custkey AS VARCHAR) AS hs_object_id,
    'Last' || CAST(c_custkey AS VARCHAR) AS lastname,
    coalesce(last_order, TIMESTAMP '1990-01-01 00:00:00') AS lastmodifieddate,
    c_mktsegment || '-detail' AS lead_source,
    'deal-' || CAST(c_nationkey AS VARCHAR) AS lead_source_deal_value,
    CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END AS lms_user_id,
    CASE WHEN c_custkey % 97 = 0 THEN repeat('x;', 25) || 'x' WHEN c_custkey % 5 = 0 THEN NULL
         WHEN c_custkey % 5 = 1 THEN '' WHEN c_custkey % 5 = 2 THEN 'a;;b;'
         ELSE c_mktsegment || ';n' || CAST(c_nationkey AS VARCHAR) END AS masters_leads,
    '+1-555-' || CAST(c_custkey AS VARCHAR) AS phone,
    CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 'camp' END AS utm_campaign,
    CASE WHEN c_custkey % 6 = 1 THEN NULL ELSE 'email' END AS utm_medium,
    CASE WHEN c_custkey % 6 = 2 THEN NULL ELSE 'hubspot' END AS utm_source
  FROM customer LEFT JOIN o ON c_custkey = o_custkey),
lists AS (
  SELECT *,
    CASE WHEN coalesce(masters_leads, '') = '' THEN []::VARCHAR[] ELSE string_split(masters_leads, ';') END AS m_list,
    CASE WHEN coalesce(braze_programs, '') = '' THEN []::VARCHAR[] ELSE string_split(braze_programs, ';') END AS p_list,
    CASE WHEN epoch_us(createdate) % 1000000 = 0 THEN strftime(createdate, '%Y-%m-%dT%H:%M:%S')
         ELSE strftime(createdate, '%Y-%m-%dT%H:%M:%S.%f') END AS create_iso
  FROM leads),
payload AS (
  SELECT *,
    json_object('HubSpot Audience', audience, 'HubSpot Contact', braze_hs_contact,
      'HubSpot Contact ID', hs_object_id, 'HubSpot Create Date', create_iso,
      'HubSpot - First Conversion', first_conversion_event_name,
      'HubSpot - Lead Source', lead_source_deal_value, 'HubSpot - Lead Source Detail', lead_source,
      'HubSpot Level of Education', highest_level_of_education,
      'HubSpot Masters Interests', CASE WHEN len(m_list) > 25 THEN NULL ELSE m_list END,
      'HubSpot Program Interests', CASE WHEN len(p_list) > 25 THEN NULL ELSE p_list END,
      'HubSpot - utm_campaign', utm_campaign, 'HubSpot - utm_medium', utm_medium,
      'HubSpot - utm_source', utm_source)::VARCHAR AS custom_json,
    json_object('country', country_iso_code, 'email', email, 'first_name', firstname, 'home_city', city,
      'last_name', lastname, 'phone', phone)::VARCHAR AS standard_json,
    concat_ws('; ',
      CASE WHEN len(m_list) > 25 THEN 'row ' || hs_object_id || ': ' || CAST(len(m_list) AS VARCHAR) || ' masters leads, the cap is 25' END,
      CASE WHEN len(p_list) > 25 THEN 'row ' || hs_object_id || ': ' || CAST(len(p_list) AS VARCHAR) || ' program interests, the cap is 25' END) AS error
  FROM lists)
"""


def _leads(spark, sf_dir):
    return derive.leads(spark, sf_dir)


@query("null_split", LEADS_SQL + """
SELECT hs_object_id, CASE WHEN lms_user_id IS NULL THEN 'alias' ELSE 'registered' END AS split FROM leads""")
def q_null_split(spark, sf_dir):
    alias, registered = sync.null_split(_leads(spark, sf_dir))
    return alias.select("hs_object_id", F.lit("alias").alias("split")).unionByName(
        registered.select("hs_object_id", F.lit("registered").alias("split")))


@query("high_water_filter", f"""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate FROM orders
WHERE o_orderdate > TIMESTAMP '{ORDERS_MARK}'""")
def q_high_water_filter(spark, sf_dir):
    o = derive.table(spark, sf_dir, "orders")
    return sync.high_water_filter(o, "o_orderdate", ORDERS_MARK).select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"))


@query("high_water_update", LEADS_SQL + f"""
SELECT strftime(max(lastmodifieddate), '%Y-%m-%dT%H:%M:%S') AS mark_iso, count(*) AS rows
FROM leads WHERE lastmodifieddate > TIMESTAMP '{MARK}'""")
def q_high_water_update(spark, sf_dir):
    # both splits together are all rows above the mark: one scan
    processed = sync.high_water_filter(_leads(spark, sf_dir), "lastmodifieddate", MARK)
    return sync.high_water_update(processed, "lastmodifieddate", MARK).select("mark_iso", "rows")


@query("processed_count", LEADS_SQL + f"""
SELECT CASE WHEN lms_user_id IS NULL THEN 'alias' ELSE 'registered' END AS split, count(*) AS rows,
       CAST(ceil(count(*) / 75) AS BIGINT) AS batches
FROM leads WHERE lastmodifieddate > TIMESTAMP '{MARK}' GROUP BY 1""")
def q_processed_count(spark, sf_dir):
    processed = sync.high_water_filter(_leads(spark, sf_dir), "lastmodifieddate", MARK)
    split = F.when(F.col("lms_user_id").isNull(), "alias").otherwise("registered")
    return sync.processed_counts(processed, split, 75)


@query("lead_custom_attrs", LEADS_SQL + "SELECT hs_object_id, custom_json, error FROM payload")
def q_lead_custom_attrs(spark, sf_dir):
    d = _leads(spark, sf_dir)
    return d.select("hs_object_id", sync.to_json_keep_nulls(sync.lead_custom_attrs()).alias("custom_json"),
                    F.array_join(sync.lead_errors(), "; ").alias("error"))


@query("lead_standard_attrs", LEADS_SQL + "SELECT hs_object_id, standard_json FROM payload WHERE lms_user_id IS NULL")
def q_lead_standard_attrs(spark, sf_dir):
    alias, _ = sync.null_split(_leads(spark, sf_dir))
    return alias.select("hs_object_id", sync.to_json_keep_nulls(sync.lead_standard_attrs()).alias("standard_json"))


@query("lead_payload_registered", LEADS_SQL + """
SELECT hs_object_id, '{"external_id":' || CAST(lms_user_id AS VARCHAR) || ',' || substr(custom_json, 2) AS payload
FROM payload WHERE lms_user_id IS NOT NULL""")
def q_lead_payload_registered(spark, sf_dir):
    _, registered = sync.null_split(_leads(spark, sf_dir))
    return sync.lead_payload(registered, "registered").select("hs_object_id", "payload")


@query("lead_payload_alias", LEADS_SQL + """
SELECT hs_object_id, '{"_update_existing_only":false,"user_alias":{"alias_label":"hubspot","alias_name":'
       || to_json(email)::VARCHAR || '},' || substr(standard_json, 2, length(standard_json) - 2) || ','
       || substr(custom_json, 2) AS payload
FROM payload WHERE lms_user_id IS NULL""")
def q_lead_payload_alias(spark, sf_dir):
    alias, _ = sync.null_split(_leads(spark, sf_dir))
    return sync.lead_payload(alias, "alias").select("hs_object_id", "payload")


@query("lead_batches", LEADS_SQL + f"""
, r AS (SELECT c_custkey, (row_number() OVER (ORDER BY c_custkey) - 1) // 75 AS batch_id, error,
               '{{"external_id":' || CAST(lms_user_id AS VARCHAR) || ',' || substr(custom_json, 2) AS payload
        FROM payload WHERE lms_user_id IS NOT NULL AND lastmodifieddate > TIMESTAMP '{MARK}')
SELECT batch_id, count(*) AS n, '{{"attributes":[' || string_agg(payload, ',' ORDER BY c_custkey) || ']}}' AS body,
       coalesce(string_agg(nullif(error, ''), '; ' ORDER BY c_custkey), '') AS errors FROM r GROUP BY batch_id""")
def q_lead_batches(spark, sf_dir):
    _, registered = sync.null_split(_leads(spark, sf_dir))
    todo = sync.high_water_filter(registered, "lastmodifieddate", MARK)
    b = sync.lead_batches(todo, "registered", ["c_custkey"], on_error="column")
    return b.select("batch_id", "n", "body", F.array_join("errors", "; ").alias("errors"))


@query("unsubscribe_payload", LEADS_SQL + f"""
, r AS (SELECT c_custkey, email, (row_number() OVER (ORDER BY c_custkey) - 1) // 50 AS batch_id
        FROM leads WHERE lastmodifieddate > TIMESTAMP '{MARK}')
SELECT batch_id, count(*) AS n,
       json_object('email', list(email ORDER BY c_custkey), 'subscription_state', 'unsubscribed')::VARCHAR AS payload
FROM r GROUP BY batch_id""")
def q_unsubscribe_payload(spark, sf_dir):
    todo = sync.high_water_filter(_leads(spark, sf_dir), "lastmodifieddate", MARK)
    return sync.unsubscribe_payload(todo, ["c_custkey"]).select("batch_id", "n", "payload")


@query("batch_pack", LEADS_SQL + """
, r AS (SELECT c_custkey, (row_number() OVER (ORDER BY c_custkey) - 1) // 75 AS batch_id FROM leads)
SELECT batch_id, count(*) AS n, min(c_custkey) AS first_key, max(c_custkey) AS last_key FROM r GROUP BY batch_id""")
def q_batch_pack(spark, sf_dir):
    packed = batch_pack(_leads(spark, sf_dir).select("c_custkey", "email"), 75, ["c_custkey"])
    return packed.select("batch_id", "n", F.col("rows")[0]["c_custkey"].alias("first_key"),
                         F.element_at("rows", -1)["c_custkey"].alias("last_key"))


@query("incremental_sync", """
WITH m1 AS (SELECT count(*) AS n, max(o_orderdate) AS mk FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
SELECT 1::BIGINT AS run_no, n AS rows, strftime(mk, '%Y-%m-%dT%H:%M:%S') AS mark FROM m1
UNION ALL
SELECT 2::BIGINT AS run_no, (SELECT count(*) FROM orders WHERE o_orderdate > (SELECT mk FROM m1)) AS rows,
       (SELECT strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%S') FROM orders) AS mark""")
def q_incremental_sync(spark, sf_dir):
    o = derive.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    state, out = scratch_path(spark, "state"), scratch_path(spark, "sync_out")
    # the source as it was at the first run, then the full source
    r1 = sync.incremental_sync(spark, o.where(F.col("o_orderdate") < "2000-01-01"), state, out, "o_orderdate",
                               "orders-last-success")
    r2 = sync.incremental_sync(spark, o, state, out, "o_orderdate", "orders-last-success")
    return r1.select(F.lit(1).cast("long").alias("run_no"), "rows", "mark").unionByName(
        r2.select(F.lit(2).cast("long").alias("run_no"), "rows", "mark"))


@query("delimited_list_cap", """
WITH l AS (SELECT l_orderkey,
             CASE WHEN l_orderkey % 7 = 0 THEN NULL WHEN l_orderkey % 5 = 0 THEN ''
                  ELSE string_agg(CAST(l_linenumber AS VARCHAR), ';' ORDER BY l_linenumber) END AS items
           FROM lineitem GROUP BY l_orderkey),
s AS (SELECT l_orderkey, CASE WHEN coalesce(items, '') = '' THEN []::VARCHAR[] ELSE string_split(items, ';') END AS lst
      FROM l)
SELECT l_orderkey, CASE WHEN len(lst) > 5 THEN NULL ELSE CAST(len(lst) AS BIGINT) END AS n_items,
       CASE WHEN len(lst) > 5 THEN NULL ELSE lst[1] END AS first_item,
       CASE WHEN len(lst) > 5 THEN NULL ELSE lst[-1] END AS last_item,
       CASE WHEN len(lst) > 5 THEN 'row ' || CAST(l_orderkey AS VARCHAR) || ': ' || CAST(len(lst) AS VARCHAR) || ' line numbers, the cap is 5' END AS error
FROM s""")
def q_delimited_list_cap(spark, sf_dir):
    li = derive.table(spark, sf_dir, "lineitem")
    k = F.col("l_orderkey")
    per = li.groupBy("l_orderkey").agg(
        F.array_join(F.array_sort(F.collect_list(F.col("l_linenumber").cast("string"))), ";").alias("_items"))
    items = F.when(k % 7 == 0, F.lit(None)).when(k % 5 == 0, F.lit("")).otherwise(F.col("_items"))
    per = per.withColumn("items", items)
    lst = delimited_list_cap("items", ";", 5, "line numbers", k)
    return per.select("l_orderkey", F.when(lst.isNotNull(), F.size(lst)).cast("long").alias("n_items"),
                      F.get(lst, 0).alias("first_item"),
                      F.try_element_at(lst, F.lit(-1)).alias("last_item"),
                      list_cap_error("items", ";", 5, "line numbers", k).alias("error"))


@query("projected_scan", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000""")
def q_projected_scan(spark, sf_dir):
    from ..sources.scan import projected_scan
    o = derive.table(spark, sf_dir, "orders")
    return projected_scan(o, ["o_orderkey", "o_custkey", "o_totalprice"],
                          "WHERE o_orderstatus = 'F' AND o_totalprice > 100000")


def _order_files(spark, sf_dir):
    """Orders as they arrive: up to a date, then later ones together with a year of old ones again."""
    def build(path):
        o = derive.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
        o.where(F.col("o_orderdate") < "1997-01-01").coalesce(1).write.parquet(path + "/first")
        o.where(F.col("o_orderdate") >= "1996-01-01").coalesce(1).write.parquet(path + "/second")
    return derive.once(spark, sf_dir, "order_files", build)


_ORDER_DDL = "o_orderkey bigint, o_orderstatus string, o_orderdate timestamp"


def _arrived(spark, sf_dir, which):
    """The rows of one arrival."""
    return spark.read.schema(_ORDER_DDL).parquet(f"{_order_files(spark, sf_dir)}/{which}")


@query("high_water_stream", "SELECT o_orderkey, o_orderstatus, 1 AS times FROM orders")
def q_high_water_stream(spark, sf_dir):
    """Two runs of a stream; the second finds a file with a year of old rows. Every order is delivered once."""
    from ..streaming.incremental import high_water_stream

    inbox, sink, ckpt = (scratch_path(spark, x) for x in ("inbox", "stream_sink", "stream_ckpt"))
    for which in ("first", "second"):
        _arrived(spark, sf_dir, which).write.mode("append").parquet(inbox)
        high_water_stream(spark, inbox, sink, ckpt, "o_orderdate", _ORDER_DDL, key=["o_orderstatus"])
    return spark.read.parquet(sink).groupBy("o_orderkey", "o_orderstatus").agg(F.count(F.lit(1)).cast("int").alias("times"))


@query("batch_pack_stream", """
WITH o AS (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' UNION ALL SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')
SELECT o_orderkey, count(*) AS times, (SELECT (count(*) + 74) // 75 FROM o) AS batches, (SELECT CAST(count(*) % 75 > 0 AS INTEGER) FROM o) AS short_ones
FROM o GROUP BY o_orderkey""")
def q_batch_pack_stream(spark, sf_dir):
    """Two runs over arriving files: all batches but the very last have 75 rows, and no row is lost or sent twice."""
    from ..streaming.incremental import batch_pack_stream

    inbox, sink, ckpt = (scratch_path(spark, x) for x in ("inbox", "stream_sink", "stream_ckpt"))
    for which in ("first", "second"):
        _arrived(spark, sf_dir, which).write.mode("append").parquet(inbox)
        batch_pack_stream(spark, inbox, sink, ckpt, sync.LEAD_BATCH_SIZE, ["o_orderkey"], _ORDER_DDL, finish=which == "second", max_files_per_trigger=1)
    sent = spark.read.parquet(sink)
    sizes = sent.agg(F.countDistinct("batch").alias("batches"), F.count(F.when(F.col("n") < sync.LEAD_BATCH_SIZE, 1)).cast("int").alias("short_ones")).first()
    return sent.select(F.explode("rows").alias("r")).groupBy("r.o_orderkey").agg(F.count(F.lit(1)).alias("times")).select(
        "o_orderkey", "times", F.lit(sizes["batches"]).alias("batches"), F.lit(sizes["short_ones"]).alias("short_ones"))
