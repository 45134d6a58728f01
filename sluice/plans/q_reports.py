"""Queries for report ingestion: file choice, CSV bodies and control totals, settlement, XML pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.money import cents_error, transaction_type, transaction_type_error
from ..operators import reports as R
from ..operators.sizing import materialised
from ..sources.files import numbered_lines
from . import derive
from .registry import query

RANKED_SQL = """
WITH r AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
             l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rank FROM lineitem),
p AS (SELECT *, (rank - 1) // 50 + 1 AS page_no, (rank - 1) % 50 + 1 AS row_num FROM r),
pages AS (SELECT DISTINCT page_no FROM p)
"""


@query("report_file_pick", """
SELECT DISTINCT strftime(l_shipdate, '%Y-%m-%d') AS report_date,
       CASE WHEN day(l_shipdate) = 28 THEN NULL ELSE 'TRR-' || strftime(l_shipdate, '%Y%m%d') || '.01.009.CSV' END
       AS name
FROM lineitem""")
def q_report_file_pick(spark, sf_dir):
    li = derive.table(spark, sf_dir, "lineitem")
    dates = li.select(F.to_date("l_shipdate").alias("report_date")).distinct()
    ymd = F.date_format("report_date", "yyyyMMdd")
    day = F.dayofmonth("report_date")
    names = F.array(
        F.concat(F.lit("TRR-"), ymd, F.lit(".01.009_TEST.CSV")),
        F.when(day != 28, F.concat(F.lit("TRR-"), ymd, F.lit(".01.009.CSV"))),
        F.when(day == 15, F.concat(F.lit("TRR-"), ymd, F.lit(".02.009.CSV"))),
        F.concat(F.lit("DDR-"), ymd, F.lit(".01.009.CSV")))
    files = dates.select(F.explode(names).alias("name")).where(F.col("name").isNotNull())
    picked = R.report_file_pick(files, "TRR-", dates)
    return picked.select(F.date_format("report_date", "yyyy-MM-dd").alias("report_date"), "name")


_FILE = ("report_date", "part")


def _report_rows(spark, sf_dir):
    """The records of every derived report, each parsed by its own header, and one row per file."""
    root = derive.report_files(spark, sf_dir)
    found = R.report_records(numbered_lines(spark, root, keep=list(_FILE)), keep=_FILE)
    layout = R.report_layout(found, keep=_FILE)
    cols = R.report_columns(layout)
    return R.report_rows(found, cols, layout, keep=_FILE), layout, cols


@query("report_body", """
SELECT strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS report_date, CAST(l_orderkey AS VARCHAR) AS order_key,
       CAST(l_linenumber AS VARCHAR) AS line_no, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS qty,
       CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS amount_cents, l_returnflag AS flag,
       CASE WHEN month(l_shipdate) = 5 AND l_linenumber = 1 THEN '5" pipe'
            WHEN month(l_shipdate) = 5 AND l_linenumber = 2 THEN l_returnflag || '" and "more"'
            ELSE l_returnflag || CASE WHEN month(l_shipdate) = 3 AND l_linenumber = 2 THEN ',' || chr(10) ELSE ', ' END || l_linestatus END AS note
FROM lineitem""")
def q_report_body(spark, sf_dir):
    rows, _, cols = _report_rows(spark, sf_dir)
    body = R.report_body(rows.drop("part").withColumnRenamed("report_date", "rd"), F.col("rd").cast("string"), cols)
    return body.select("report_date", "order_key", "line_no", "qty", "amount_cents", "flag", "note")


@query("control_total_check", """
WITH d AS (SELECT date_trunc('month', l_shipdate) AS mo,
                  l_orderkey // 1000000 AS part, count(*) AS n,
                  count(*) FILTER (WHERE month(l_shipdate) = 11 AND l_linenumber = 1) AS late
           FROM lineitem GROUP BY 1, 2),
e AS (SELECT mo, part, n - late AS found,
             CASE WHEN month(mo) = 7 THEN 0 WHEN month(mo) = 1 THEN n + 1 ELSE n END AS expected
      FROM d)
SELECT strftime(mo, '%Y-%m-%d') AS report_date, part, found, CAST(expected AS BIGINT) AS expected,
       found = expected AS ok
FROM e""")
def q_control_total_check(spark, sf_dir):
    rows, layout, _ = _report_rows(spark, sf_dir)
    checked = R.control_total_check(rows, "row_count", files=layout)
    return checked.join(layout, "file_path").select(F.col("report_date").cast("string").alias("report_date"), F.col("part").cast("long").alias("part"),
                                                    "found", "expected", "ok")


SETTLEMENT_SQL = """
WITH c AS (
  SELECT 'T' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
         || '-' || CAST(l_suppkey AS VARCHAR) AS transaction_id,
         CASE WHEN l_linenumber = 7 THEN 'Authorization' WHEN l_returnflag = 'R' THEN 'Credit' ELSE 'Sale' END AS type,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(round(l_tax * 100) AS BIGINT) AS tax,
         l_linenumber, l_quantity
  FROM lineitem),
v AS (
  SELECT *, CASE WHEN l_linenumber = 6 THEN '' WHEN l_linenumber = 5 AND l_quantity > 45 THEN '12.5'
                 ELSE CAST(cents AS VARCHAR) END AS amount,
         CASE WHEN l_linenumber = 6 THEN 0 ELSE cents END AS amt, (cents * tax) // 100 AS fee,
         (l_linenumber = 5 AND l_quantity > 45) AS bad_amount,
         CASE type WHEN 'Sale' THEN 'sale' WHEN 'Credit' THEN 'refund' END AS transaction_type,
         CASE WHEN type = 'Credit' THEN -1 ELSE 1 END AS sgn
  FROM c),
f AS (
  SELECT *,
    CASE WHEN transaction_type IS NULL OR bad_amount THEN NULL
         ELSE CASE WHEN sgn * amt < 0 THEN '-' ELSE '' END || CAST(abs(amt) // 100 AS VARCHAR) || '.'
              || lpad(CAST(abs(amt) % 100 AS VARCHAR), 2, '0') END AS decimal_amount,
    CASE WHEN transaction_type IS NULL THEN NULL
         ELSE CASE WHEN sgn * fee < 0 THEN '-' ELSE '' END || CAST(abs(fee) // 100 AS VARCHAR) || '.'
              || lpad(CAST(abs(fee) % 100 AS VARCHAR), 2, '0') END AS decimal_fees,
    CASE WHEN transaction_type IS NULL THEN 'Unknown transaction type: ' || type
         WHEN bad_amount THEN 'Amount is not a whole number of cents: 12.5' END AS error
  FROM v)
"""


def _settlement(spark, sf_dir):
    return R.settlement(derive.settlement_cells(spark, sf_dir), "cells")


@query("settlement_record", SETTLEMENT_SQL + """
SELECT transaction_id, type, transaction_type, decimal_amount, decimal_fees, error FROM f""")
def q_settlement_record(spark, sf_dir):
    s = _settlement(spark, sf_dir)
    return s.select("transaction_id", "type", "transaction_type", F.col("decimal_amount").cast("string"),
                    F.col("decimal_fees").cast("string"), "error")


@query("transaction_type", SETTLEMENT_SQL + """
SELECT transaction_id, type, transaction_type,
       CASE WHEN transaction_type IS NULL THEN 'Unknown transaction type: ' || type END AS error FROM f""")
def q_transaction_type(spark, sf_dir):
    c = derive.settlement_cells(spark, sf_dir).select("transaction_id", F.col("cells")[2].alias("type"))
    return c.select("transaction_id", "type", transaction_type("type").alias("transaction_type"),
                    transaction_type_error("type").alias("error"))


@query("cents_to_decimal", SETTLEMENT_SQL + "SELECT transaction_id, amount, decimal_amount, error FROM f")
def q_cents_to_decimal(spark, sf_dir):
    from ..functions.money import cents_to_decimal
    c = derive.settlement_cells(spark, sf_dir).select(
        "transaction_id", F.col("cells")[2].alias("type"), F.col("cells")[6].alias("amount"))
    return c.select("transaction_id", "amount", cents_to_decimal("amount", "type").cast("string").alias("decimal_amount"),
                    cents_error("amount", "type").alias("error"))


# --- XML responses -------------------------------------------------------------------------------

@query("report_page_rows", RANKED_SQL + """
SELECT page_no, row_num,
       CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) || '|' || l_returnflag || '|'
       || strftime(l_shipdate, '%Y-%m-%d') || '|'
       || CASE WHEN page_no % 9 = 4 AND row_num = 1 THEN '<null>' WHEN l_linenumber = 3 THEN '' ELSE l_linestatus END
       AS cells,
       CASE WHEN page_no % 7 = 3 THEN 'API request failed with code 107: Report unavailable'
            WHEN page_no % 9 = 4 AND row_num = 1
            THEN 'The required element "data" was not found in the API response' END AS error
FROM p""")
def q_report_page_rows(spark, sf_dir):
    rows = R.report_page_rows(derive.data_pages(spark, sf_dir), "doc", keep=["page_no"])
    return rows.select("page_no", "row_num", F.array_join("cells", "|", "<null>").alias("cells"), "error")


@query("xml_pages_scan", RANKED_SQL + """
SELECT page_no, CASE WHEN page_no % 7 = 3 THEN 107 ELSE 100 END AS response_code, count(*) AS n_rows,
       page_no % 7 <> 3 AS ok
FROM p GROUP BY page_no""")
def q_xml_pages_scan(spark, sf_dir):
    d = R.parse_once(derive.data_pages(spark, sf_dir), "doc", ["page_no"], pages=True)
    r = F.col("_r")
    base = R.response_ok(r)
    return d.select("page_no", base["response_code"].alias("response_code"),
                    F.when(r["getDataResponse"]["reportDataRow"].isNotNull(),
                           F.size(r["getDataResponse"]["reportDataRow"])).cast("long").alias("n_rows"),
                    base["ok"].alias("ok"))


@query("report_metadata", """
WITH m AS (SELECT date_trunc('month', l_shipdate) AS mo, count(*) AS n FROM lineitem GROUP BY 1)
SELECT strftime(mo, '%Y-%m-%d') AS report_month, CAST(n AS INTEGER) AS num_rows,
       CAST(ceil(n / 50) AS INTEGER) AS num_pages,
       CASE WHEN month(mo) = 6 THEN NULL ELSE 50 END AS page_size,
       'order_key:integer,line_no:integer,flag:char,ship_date:date,status:string' AS columns,
       CASE WHEN month(mo) = 6 THEN 'The required element "pageSize" was not found in the API response' END AS error
FROM m""")
def q_report_metadata(spark, sf_dir):
    d = R.parse_once(derive.metadata_pages(spark, sf_dir), "doc", ["report_month"])
    m = R.report_metadata(F.col("_r"))
    cols = F.array_join(F.transform(m["columns"], lambda c: F.concat(c["name"], F.lit(":"), c["data_type"])), ",")
    return d.select("report_month", m["num_rows"].alias("num_rows"), m["num_pages"].alias("num_pages"),
                    m["page_size"].alias("page_size"), cols.alias("columns"), m["error"].alias("error"))


STATUS_SQL = RANKED_SQL + """
, s AS (SELECT page_no, 'R' || CAST(page_no AS VARCHAR) AS report_id, CAST(page_no % 6 + 1 AS INTEGER) AS status_code,
          CASE WHEN page_no % 11 = 5 THEN NULL WHEN page_no % 10 = 2 THEN ''
               ELSE 'Report status ' || CAST(page_no % 6 + 1 AS VARCHAR) END AS status_message,
          CASE WHEN page_no % 11 = 5 THEN 'The required element "statusMsg" was not found in the API response' END
          AS error
        FROM pages)
"""


def _status(spark, sf_dir):
    d = R.parse_once(derive.status_pages(spark, sf_dir), "doc", ["page_no"])
    r = F.col("_r")
    return d.select("page_no", R.report_status(r).alias("st"), R.response_ok(r).alias("base"))


@query("report_status", STATUS_SQL + "SELECT page_no, report_id, status_code, status_message, error FROM s")
def q_report_status(spark, sf_dir):
    return _status(spark, sf_dir).select("page_no", "st.report_id", "st.status_code", "st.status_message",
                                         F.col("st.error").alias("error"))


@query("report_state", STATUS_SQL + """
SELECT page_no, status_code, CASE WHEN status_code IN (1, 2) THEN 'running' WHEN status_code = 3 THEN 'ready'
                                  WHEN status_code > 3 THEN 'failed' ELSE 'unknown' END AS state FROM s""")
def q_report_state(spark, sf_dir):
    return _status(spark, sf_dir).select("page_no", "st.status_code", R.report_state("st.status_code").alias("state"))


@query("response_ok", STATUS_SQL + """
SELECT page_no, CASE WHEN page_no % 7 = 3 THEN 107 ELSE 100 END AS response_code,
       NOT (page_no % 13 = 8 OR page_no % 7 = 3) AS ok,
       CASE WHEN page_no % 13 = 8 THEN 'The required element "responseMsg" was not found in the API response'
            WHEN page_no % 7 = 3 THEN 'API request failed with code 107: Report unavailable' END AS error
FROM s""")
def q_response_ok(spark, sf_dir):
    return _status(spark, sf_dir).select("page_no", "base.response_code", "base.ok", F.col("base.error").alias("error"))


@query("required_element", STATUS_SQL + "SELECT page_no, status_message, error FROM s")
def q_required_element(spark, sf_dir):
    return _status(spark, sf_dir).select("page_no", "st.status_message", F.col("st.error").alias("error"))
