"""Deterministic inputs derived from the supplied tables (identically re-derived in the oracle SQL).

Derived files are written once per process below the shared checkpoint root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.batching import global_rank
from ..session import scratch_path

LINEITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
PAGE_SIZE = 50
# Derived files hold fixed ranges of keys, so there are more of them as the tables grow, and a row's file doesn't
# depend on how many others there are (the oracle SQL has the same rule).
EVENT_CHUNK = 5000
REPORT_KEYS = 1_000_000
# rows that a task sorts to write its reports
REPORT_ROWS = 250_000

_written: dict[tuple[str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def once(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """Write a derived input once per process and return its path."""
    key = (sf_dir, name)
    if key not in _written:
        path = scratch_path(spark, "derived", name)
        build(path)
        _written[key] = path
    return _written[key]


def s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# --- events as NDJSON files ---------------------------------------------------------------

def event_json_line(broken: bool = True) -> Column:
    line = F.concat(
        F.lit('{"date":"'), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.lit('","day":"'), F.date_format("ts", "yyyyMMdd"),
        F.lit('","event_id":'), s("event_id"),
        F.lit(',"event_type":"'), F.col("event_type"),
        F.lit('","props":'), F.coalesce(F.col("props"), F.lit("null")), F.lit("}"))
    if not broken:
        return line
    return F.when(F.col("event_id") % 10 == 0, F.substring(line, 2, 1 << 30)).otherwise(line)


def events_ndjson(spark: SparkSession, sf_dir: str) -> str:
    """events -> ``event_type=<t>/chunk=<event_id div chunk>/`` text files, one JSON object per line,
    in event_id order; every 10th record is broken (first character removed)."""
    def build(path):
        ev = table(spark, sf_dir, "events")
        chunk = EVENT_CHUNK
        lines = ev.select("event_type", F.floor(F.col("event_id") / chunk).cast("long").alias("chunk"),
                          "event_id", event_json_line().alias("value"))
        (lines.repartition("event_type", "chunk").sortWithinPartitions("event_type", "chunk", "event_id")
              .drop("event_id").write.partitionBy("event_type", "chunk").text(path))
    return once(spark, sf_dir, "events_ndjson", build)


# --- leads derived from customer + orders ------------------------------------------------------

def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"))
    j = c.join(o, c.c_custkey == o.o_custkey, "left")
    k = F.col("c_custkey")
    epoch = F.lit("1990-01-01 00:00:00").cast("timestamp_ntz")
    return j.select(
        "c_custkey",
        F.col("c_mktsegment").alias("audience"),
        F.when(F.col("c_acctbal") >= 0, "true").otherwise("false").alias("braze_hs_contact"),
        F.when(k % 4 == 0, F.lit(None)).when(k % 4 == 1, F.lit(""))
         .otherwise(F.concat(F.lit("prog-"), s("c_nationkey"), F.lit(";prog-x"))).alias("braze_programs"),
        F.concat(F.lit("city-"), s("c_nationkey")).alias("city"),
        F.concat(F.lit("C"), s("c_nationkey")).alias("country_iso_code"),
        F.timestamp_add("MICROSECOND", (k % 4) * 250000, F.coalesce("first_order", epoch)).alias("createdate"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("conv-"), s(k % 7)).alias("first_conversion_event_name"),
        F.concat(F.lit("First"), s(k)).alias("firstname"),
        F.when(F.col("c_acctbal") > 5000, F.lit("masters")).alias("highest_level_of_education"),
        F.concat(F.lit("hs-"), s(k)).alias("hs_object_id"),
        F.concat(F.lit("Last"), s(k)).alias("lastname"),
        F.coalesce("last_order", epoch).alias("lastmodifieddate"),
        F.concat("c_mktsegment", F.lit("-detail")).alias("lead_source"),
        F.concat(F.lit("deal-"), s("c_nationkey")).alias("lead_source_deal_value"),
        F.when(k % 3 != 0, k).alias("lms_user_id"),
        F.when(k % 97 == 0, F.concat(F.repeat(F.lit("x;"), 25), F.lit("x")))
         .when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, F.lit("")).when(k % 5 == 2, F.lit("a;;b;"))
         .otherwise(F.concat("c_mktsegment", F.lit(";n"), s("c_nationkey"))).alias("masters_leads"),
        F.concat(F.lit("+1-555-"), s(k)).alias("phone"),
        F.when(k % 6 == 0, F.lit(None)).otherwise(F.lit("camp")).alias("utm_campaign"),
        F.when(k % 6 == 1, F.lit(None)).otherwise(F.lit("email")).alias("utm_medium"),
        F.when(k % 6 == 2, F.lit(None)).otherwise(F.lit("hubspot")).alias("utm_source"),
    )


# --- paged report documents built from lineitem ---------------------------------------------------

def lineitem_ranked(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    """Rows with their rank, page and place in it; of the table's own columns those in ``keep``, by default all."""
    li = table(spark, sf_dir, "lineitem")
    r = global_rank(li, LINEITEM_ORDER, "rank", keep=keep)
    return r.withColumn("page_no", (F.floor((F.col("rank") - 1) / PAGE_SIZE) + 1).cast("long")) \
            .withColumn("row_num", ((F.col("rank") - 1) % PAGE_SIZE + 1).cast("long"))


def _cell(v: Column) -> Column:
    return F.concat(F.lit("<columnData><data>"), v, F.lit("</data></columnData>"))


def data_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One XML data page (50 rows) per row: ``(page_no, doc)`` (written once)."""
    return spark.read.parquet(once(spark, sf_dir, "data_pages", lambda p: _data_pages(spark, sf_dir).write.parquet(p)))


def _data_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = lineitem_ranked(spark, sf_dir, ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate"])
    missing = (F.col("page_no") % 9 == 4) & (F.col("row_num") == 1)
    status_cell = F.when(missing, F.lit("<columnData></columnData>")).when(
        F.col("l_linenumber") == 3, F.lit("<columnData><data/></columnData>")).otherwise(_cell(F.col("l_linestatus")))
    row = F.concat(F.lit("<reportDataRow>"), _cell(s("l_orderkey")), _cell(s("l_linenumber")),
                   _cell(F.col("l_returnflag")), _cell(F.date_format("l_shipdate", "yyyy-MM-dd")), status_cell,
                   F.lit("</reportDataRow>"))
    per_page = r.groupBy("page_no").agg(
        F.sort_array(F.collect_list(F.struct("row_num", row.alias("x")))).alias("rows"))  # <= 50 per page
    code = F.when(F.col("page_no") % 7 == 3, F.lit("107")).otherwise(F.lit("100"))
    msg = F.when(F.col("page_no") % 7 == 3, F.lit("Report unavailable")).otherwise(
        F.lit("Request has completed successfully"))
    doc = F.concat(F.lit("<reportingEngineResponse><baseResponse><responseCode>"), code,
                   F.lit("</responseCode><responseMsg>"), msg, F.lit("</responseMsg></baseResponse><getDataResponse>"),
                   F.array_join(F.col("rows")["x"], ""),
                   F.lit("</getDataResponse></reportingEngineResponse>"))
    return per_page.select("page_no", doc.alias("doc"))


def status_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run / results status response per data page: ``(page_no, doc)``."""
    pages = lineitem_ranked(spark, sf_dir, []).select("page_no").distinct()
    p = F.col("page_no")
    code = F.when(p % 7 == 3, F.lit("107")).otherwise(F.lit("100"))
    base_msg = F.when(p % 13 == 8, F.lit("")).otherwise(
        F.concat(F.lit("<responseMsg>"), F.when(p % 7 == 3, F.lit("Report unavailable"))
                 .otherwise(F.lit("Request has completed successfully")), F.lit("</responseMsg>")))
    status_msg = F.when(p % 11 == 5, F.lit("")).when(p % 10 == 2, F.lit("<statusMsg/>")).otherwise(
        F.concat(F.lit("<statusMsg>Report status "), s((p % 6) + 1), F.lit("</statusMsg>")))
    body = F.concat(F.lit("<reportId>R"), s(p), F.lit("</reportId><statusCode>"), s((p % 6) + 1),
                    F.lit("</statusCode>"), status_msg)
    wrapped = F.when(p % 2 == 1, F.concat(F.lit("<runReportResponse>"), body, F.lit("</runReportResponse>"))) \
               .otherwise(F.concat(F.lit("<getResultsResponse><Results>"), body,
                                   F.lit("</Results></getResultsResponse>")))
    doc = F.concat(F.lit("<reportingEngineResponse><baseResponse><responseCode>"), code, F.lit("</responseCode>"),
                   base_msg, F.lit("</baseResponse>"), wrapped, F.lit("</reportingEngineResponse>"))
    return pages.select("page_no", doc.alias("doc"))


# Fixed metadata column list of the derived report (a repeated name: last type wins)
META_COLUMNS = [("order_key", "integer"), ("line_no", "integer"), ("flag", "string"), ("ship_date", "date"),
                ("status", "string"), ("flag", "char")]


def metadata_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metadata response per ship month: ``(report_month, doc)``."""
    li = table(spark, sf_dir, "lineitem")
    m = li.groupBy(F.date_format(F.trunc("l_shipdate", "MM"), "yyyy-MM-dd").alias("report_month")) \
          .agg(F.count(F.lit(1)).alias("n"))
    cols = "".join(f"<columnMetaData><dataName>{n}</dataName><dataType>{t}</dataType></columnMetaData>"
                   for n, t in META_COLUMNS)
    page_size = F.when(F.month(F.to_date("report_month")) == 6, F.lit("")).otherwise(
        F.lit("<pageSize>50</pageSize>"))
    doc = F.concat(F.lit("<reportingEngineResponse><baseResponse><responseCode>100</responseCode>"
                         "<responseMsg>ok</responseMsg></baseResponse><getMetaDataResponse><numberOfRows>"),
                   s("n"), F.lit("</numberOfRows><numberOfPages>"), s(F.ceil(F.col("n") / PAGE_SIZE)),
                   F.lit("</numberOfPages>"), page_size, F.lit(cols),
                   F.lit("</getMetaDataResponse></reportingEngineResponse>"))
    return m.select("report_month", doc.alias("doc"))


# --- daily CSV reports built from lineitem ---------------------------------------------------------

REPORT_COLUMNS = ["CH", "order_key", "line_no", "qty", "amount_cents", "flag", "note", "row_count"]


def _csv(month: Column, first: Column, *rest: Column) -> Column:
    return F.when(month % 2 == 0, F.concat_ws(",", first, *reversed(rest))).otherwise(F.concat_ws(",", first, *rest))


def report_files(spark: SparkSession, sf_dir: str) -> str:
    """CSV reports per ship month and range of order keys under ``report_date=<yyyy-MM-01>/part=<p>/``: 3 free lines,
    header, SB rows, SF footer (wrong in January, missing in July, line-1 rows after it in November). Reports of even
    months have their columns the other way round; some notes of March hold a line break, some of May stray quotes."""
    def build(path):
        li = table(spark, sf_dir, "lineitem")
        li = li.withColumn("part", F.floor(F.col("l_orderkey") / REPORT_KEYS).cast("long"))
        d = F.date_format(F.trunc("l_shipdate", "MM"), "yyyy-MM-dd")
        mon = F.month("l_shipdate")
        body = li.select(
            d.alias("report_date"), "part",
            F.when((mon == 11) & (F.col("l_linenumber") == 1), F.lit(4)).otherwise(F.lit(2)).alias("section"),
            *[F.col(c) for c in LINEITEM_ORDER],
            _csv(mon, F.lit("SB"), s("l_orderkey"), s("l_linenumber"), s(F.col("l_quantity").cast("long")),
                 s(F.round(F.col("l_extendedprice") * 100).cast("long")), F.col("l_returnflag"),
                 F.when((mon == 5) & (F.col("l_linenumber") == 1), F.lit('5" pipe')).when(
                     (mon == 5) & (F.col("l_linenumber") == 2), F.concat(F.lit('"'), F.col("l_returnflag"), F.lit('""" and "more"'))).otherwise(
                     F.concat(F.lit('"'), F.col("l_returnflag"), F.when((mon == 3) & (F.col("l_linenumber") == 2), F.lit(",\n")).otherwise(
                         F.lit(", ")), F.col("l_linestatus"), F.lit('"'))), F.lit("")).alias("value"))
        per_month = li.groupBy(d.alias("report_date"), "part").agg(F.count(F.lit(1)).alias("n"))
        pmon = F.month(F.to_date("report_date"))
        footer = per_month.where(pmon != 7).select(
            "report_date", "part", F.lit(3).alias("section"),
            _csv(pmon, F.lit("SF"), *[F.lit("")] * 6, s(F.col("n") + F.when(pmon == 1, 1).otherwise(0))).alias("value"))
        head = per_month.select("report_date", "part", F.explode(F.array(
            *[F.struct(F.lit(i).alias("section"), v.alias("value")) for i, v in enumerate([
                F.lit("Settlement report"), F.concat(F.lit("Generated for "), F.col("report_date")),
                F.lit("Version 1"), _csv(pmon, *[F.lit(c) for c in REPORT_COLUMNS])])])).alias("h")).select(
            "report_date", "part", (F.col("h.section") - 4).alias("section"), "h.value")
        empty = [F.lit(None).cast(li.schema[c].dataType).alias(c) for c in LINEITEM_ORDER]
        allrows = body.unionByName(footer.select("report_date", "part", "section", *empty, "value")) \
                      .unionByName(head.select("report_date", "part", "section", *empty, "value"))
        # one file per report (the writer of one file is one task); files are size-bounded by `parts`, and tasks grow in number
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-li.count() // REPORT_ROWS))
        (allrows.repartition(tasks, "report_date", "part")
                .sortWithinPartitions("report_date", "part", "section", *LINEITEM_ORDER)
                .select("report_date", "part", "value").write.partitionBy("report_date", "part").text(path))
    return once(spark, sf_dir, "report_files", build)


def settlement_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """23 settlement cells per lineitem row (types, empty and bad amounts by line number)."""
    li = table(spark, sf_dir, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    tax = F.round(F.col("l_tax") * 100).cast("long")
    ttype = F.when(F.col("l_linenumber") == 7, F.lit("Authorization")).when(
        F.col("l_returnflag") == "R", F.lit("Credit")).otherwise(F.lit("Sale"))
    amount = F.when(F.col("l_linenumber") == 6, F.lit("")).when(
        (F.col("l_linenumber") == 5) & (F.col("l_quantity") > 45), F.lit("12.5")).otherwise(s(cents))
    fees = s(F.floor(cents * tax / 100).cast("long"))
    tid = F.concat(F.lit("T"), s("l_orderkey"), F.lit("-"), s("l_linenumber"), F.lit("-"), s("l_partkey"),
                   F.lit("-"), s("l_suppkey"))
    cells = [tid, F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), ttype, F.lit("C"),
             F.concat(F.lit("XXXX"), s(F.col("l_partkey") % 10000)), F.lit("1225"), amount, F.lit("0"),
             F.lit("Approved"), F.col("l_returnflag"), F.col("l_linestatus"), s("l_orderkey"), F.lit("$"),
             F.concat(F.lit("P"), s("l_orderkey")), fees, F.lit("merchant@example.com"), F.lit(""), F.lit(""),
             F.lit(""), F.lit(""), F.concat(F.lit("INV"), s("l_orderkey")), F.lit(""), F.lit("")]
    return li.select(tid.alias("transaction_id"), F.array(*cells).alias("cells"))


# --- sitemaps and API pages ---------------------------------------------------------------------

def xml_escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


SITEMAP_NS = "http://www.sitemaps.org/schemas/sitemap/0.9"


def sitemap_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages -> urlset documents of 50 URLs ``(sitemap_no, sitemap_url, doc)``; odd sitemaps use a
    namespace prefix and padded ``<loc>`` text."""
    pages = global_rank(table(spark, sf_dir, "pages").select("page_id", "url"), ["page_id"], "rank")
    k = F.floor((F.col("rank") - 1) / PAGE_SIZE).cast("long")
    pages = pages.withColumn("sitemap_no", k)
    odd = F.col("sitemap_no") % 2 == 1
    pre = F.when(odd, F.lit("s:")).otherwise(F.lit(""))
    entry = F.concat(F.lit("<"), pre, F.lit("url><"), pre, F.lit("loc>"),
                     F.when(odd, F.concat(F.lit("\n  "), xml_escape(F.col("url")), F.lit("  \n")))
                      .otherwise(xml_escape(F.col("url"))),
                     F.lit("</"), pre, F.lit("loc><"), pre, F.lit("lastmod>2024-01-31</"), pre, F.lit("lastmod></"),
                     pre, F.lit("url>"))
    per = pages.groupBy("sitemap_no").agg(F.array_sort(F.collect_list(F.struct("rank", entry.alias("x")))).alias("e"))
    po = F.col("sitemap_no") % 2 == 1
    open_tag = F.when(po, F.lit(f'<s:urlset xmlns:s="{SITEMAP_NS}">')).otherwise(F.lit(f'<urlset xmlns="{SITEMAP_NS}">'))
    close_tag = F.when(po, F.lit("</s:urlset>")).otherwise(F.lit("</urlset>"))
    doc = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>'), open_tag,
                   F.array_join(F.transform("e", lambda x: x["x"]), ""), close_tag)
    return per.select("sitemap_no", F.concat(F.lit("https://www.example.com/sitemap-"), s("sitemap_no"),
                                             F.lit(".xml")).alias("sitemap_url"), doc.alias("doc"))


def odd_sitemaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document for every sitemap that isn't one, or has entries without a URL: ``(sitemap_url, doc)``."""
    no = F.col("sitemap_no")
    doc = (F.when(no % 4 == 0, F.lit("<urlset/>")).when(no % 4 == 1, F.lit("<html><body><p>not found</p></body></html>"))
           .when(no % 4 == 2, F.lit("<urlset><url><loc/></url><url><lastmod>2024-01-31</lastmod></url></urlset>")).otherwise(F.lit("<urlset><url><loc>https")))
    return sitemap_docs(spark, sf_dir).select(F.concat(F.lit("https://www.example.com/odd-"), s("sitemap_no"), F.lit(".xml")).alias("sitemap_url"), doc.alias("doc"))


def sitemap_index_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index documents listing 50 sitemaps each: ``(index_no, doc)``."""
    maps = sitemap_docs(spark, sf_dir).select("sitemap_no", "sitemap_url")
    idx = maps.withColumn("index_no", F.floor(F.col("sitemap_no") / PAGE_SIZE).cast("long"))
    entry = F.concat(F.lit("<sitemap><loc>"), F.col("sitemap_url"), F.lit("</loc><lastmod>2024-01-31</lastmod></sitemap>"))
    per = idx.groupBy("index_no").agg(F.array_sort(F.collect_list(F.struct("sitemap_no", entry.alias("x")))).alias("e"))
    doc = F.concat(F.lit(f'<sitemapindex xmlns="{SITEMAP_NS}">'), F.array_join(F.transform("e", lambda x: x["x"]), ""),
                   F.lit("</sitemapindex>"))
    return per.select("index_no", doc.alias("doc"))


def api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> landed API pages of 50 results ``(url, body)`` chained by ``next`` (written once)."""
    path = once(spark, sf_dir, "api_pages",
                lambda p: _api_pages(spark, sf_dir).write.parquet(p))
    return spark.read.parquet(path)


def _api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = global_rank(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey"),
                    ["o_orderkey"], "rank")
    o = o.withColumn("page", (F.floor((F.col("rank") - 1) / PAGE_SIZE) + 1).cast("long"))
    item = F.concat(F.lit('{"o_orderkey":'), s("o_orderkey"), F.lit(',"o_orderstatus":"'), F.col("o_orderstatus"),
                    F.lit('","o_custkey":'), s("o_custkey"), F.lit("}"))
    per = o.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("rank", item.alias("x")))).alias("e"))
    # a page has a successor when page + 1 exists (equi-join on the page number)
    succ = per.select((F.col("page") - 1).alias("page"), F.lit(True).alias("has_next"))
    per = per.join(succ, "page", "left")
    url = lambda p: F.concat(F.lit("https://api.example.com/orders?page="), s(p))
    nxt = F.when(F.col("has_next"), F.concat(F.lit('"'), url(F.col("page") + 1), F.lit('"'))).otherwise(F.lit("null"))
    body = F.concat(F.lit('{"count":'), s(F.size("e")), F.lit(',"next":'), nxt, F.lit(',"results":['),
                    F.array_join(F.transform("e", lambda x: x["x"]), ","), F.lit("]}"))
    return per.select(url(F.col("page")).alias("url"), body.alias("body"))
