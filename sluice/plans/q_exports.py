"""Queries for exports, manifests, dated sinks, sitemaps, API pages and the streaming load."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.text import url_file_stem
from ..operators.sitemap import sitemap_index_urls, sitemap_urls
from ..sinks import export as X
from ..sinks.dated import dated_report_sink, sitemap_sink
from ..session import scratch_path
from ..sources.apipages import api_page_links, api_pages_flatten, page_positions
from ..sources.delimited import delimited_load, manifest_load
from ..streaming.incremental import load_new_files
from . import derive
from .registry import query

PART_DDL = "p_partkey bigint, p_name string, p_label string, p_size int, p_retailprice double, p_note string"

PART_SQL = """
WITH px AS (
  SELECT p_partkey,
         CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN '' ELSE p_name END AS p_name,
         p_brand || ',' || p_type AS p_label, p_size, p_retailprice,
         CASE WHEN p_partkey % 7 = 3 THEN 'a\\b' WHEN p_partkey % 7 = 4 THEN 'two' || chr(10) || 'lines'
              ELSE 'plain' END AS p_note
  FROM part)
"""


def _esc(c):
    return ("replace(replace(replace(replace(" + c + ", '\\', '\\\\'), ',', '\\,'), chr(10), '\\n'), "
            "chr(13), '\\r')")


LINE_SQL = ("CAST(p_partkey AS VARCHAR) || ',' || coalesce(" + _esc("p_name") + ", '\\N') || ',' || "
            + _esc("p_label") + " || ',' || CAST(p_size AS VARCHAR) || ',' || CAST(p_retailprice AS VARCHAR) || ','"
            " || " + _esc("p_note"))


def part_x(spark, sf_dir):
    p = derive.table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        "p_partkey",
        F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, F.lit("")).otherwise(F.col("p_name")).alias("p_name"),
        F.concat("p_brand", F.lit(","), "p_type").alias("p_label"), "p_size", "p_retailprice",
        F.when(k % 7 == 3, F.lit("a\\b")).when(k % 7 == 4, F.lit("two\nlines")).otherwise(F.lit("plain"))
         .alias("p_note"))


@query("delimited_export", PART_SQL + "SELECT " + LINE_SQL + " AS line FROM px")
def q_delimited_export(spark, sf_dir):
    path = scratch_path(spark, "exports", "part")
    X.delimited_export(part_x(spark, sf_dir), path, sep=",", enclosed_by="NONE", escape="\\", null_marker="\\N")
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("export_file_sizes", PART_SQL + """, l AS (SELECT strlen(line) + 1 AS n FROM (SELECT """ + LINE_SQL + """ AS line FROM px))
SELECT cap, true AS within_cap, true AS filled, (SELECT CAST(sum(n) AS BIGINT) FROM l) + (SELECT count(*) FROM px WHERE p_partkey % 500 = 0) * 3000 AS bytes
FROM (VALUES (20000), (100000)) v(cap)""")
def q_export_file_sizes(spark, sf_dir):
    """Exports under two caps, with a row of 3,000 more bytes in every 500: no file is above its cap, and files are
    filled: two files of a task that follow each other never fit into one."""
    src = part_x(spark, sf_dir).repartitionByRange(4, "p_partkey").sortWithinPartitions("p_partkey")
    wide = src.withColumn("p_note", F.when(F.col("p_partkey") % 500 == 0, F.concat("p_note", F.repeat(F.lit("w"), 3000))).otherwise(F.col("p_note")))
    out = None
    for cap in (20_000, 100_000):
        path = scratch_path(spark, "exports", "capped")
        X.delimited_export(wide, path, enclosed_by="NONE", escape="\\", max_file_bytes=cap)
        files = spark.read.format("binaryFile").load(path).select("path", "length").withColumn("task", F.regexp_extract("path", "part-([0-9]+)-", 1))
        pair = F.col("length") + F.lead("length").over(Window.partitionBy("task").orderBy("path"))
        one = files.withColumn("pair", pair).agg((F.max("length") <= cap).alias("within_cap"), (F.coalesce(F.min("pair"), F.lit(cap + 1)) > cap).alias("filled"),
                                                 F.sum("length").alias("bytes")).select(F.lit(cap).alias("cap"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query("export_clean_prefix", PART_SQL.replace("ELSE p_name END", "ELSE upper(p_name) END")
       + "SELECT " + LINE_SQL + " AS line FROM px")
def q_export_clean_prefix(spark, sf_dir):
    path = scratch_path(spark, "exports", "part")
    src = part_x(spark, sf_dir)
    X.delimited_export(src, path, enclosed_by="NONE", escape="\\")
    X.delimited_export(src.withColumn("p_name", F.upper("p_name")), path, enclosed_by="NONE", escape="\\",
                       overwrite=True)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("export_no_clobber", "SELECT 'refused' AS second_attempt, count(*) AS rows_present FROM part")
def q_export_no_clobber(spark, sf_dir):
    path = scratch_path(spark, "exports", "part")
    src = part_x(spark, sf_dir)
    X.delimited_export(src, path, enclosed_by='"')
    try:
        X.delimited_export(src, path, enclosed_by='"', overwrite=False)
        second = "written"
    except FileExistsError:
        second = "refused"
    back = delimited_load(spark, path, PART_DDL, quote='"', escape='"', multiline=True)
    return back.agg(F.count(F.lit(1)).alias("rows_present")).select(F.lit(second).alias("second_attempt"),
                                                                    "rows_present")


def _quoted_export(spark, sf_dir):
    path = scratch_path(spark, "exports", "part")
    X.delimited_export(part_x(spark, sf_dir), path, enclosed_by='"')
    return path


def delimited_files(spark, sf_dir):
    """Quoted files of all parts, and files of other make: bare fields that hold quotes, quotes within quotes, line breaks."""
    def build(path):
        X.delimited_export(part_x(spark, sf_dir), path + "/own", enclosed_by='"')
        k = F.col("p_partkey")
        fields = [derive.s("p_partkey"), F.when(k % 3 == 0, F.lit('5" pipe')).when(k % 3 == 1, F.lit('"the "big" one"')).otherwise(F.lit('"two\n""lines"""')),
                  F.lit('"a,b"'), derive.s("p_size"), F.lit(""), F.when(k % 2 == 0, F.lit('6" pipe')).otherwise(F.lit("\\N"))]
        derive.table(spark, sf_dir, "part").select(F.concat_ws(",", *fields).alias("value")).write.text(path + "/other")
    return derive.once(spark, sf_dir, "delimited_files", build)


@query("delimited_load", PART_SQL + """
SELECT * FROM px UNION ALL
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '5" pipe' WHEN 1 THEN 'the "big" one' ELSE 'two' || chr(10) || '"lines"' END, 'a,b', p_size, NULL,
       CASE WHEN p_partkey % 2 = 0 THEN '6" pipe' END FROM part""")
def q_delimited_load(spark, sf_dir):
    root = delimited_files(spark, sf_dir)
    return delimited_load(spark, [root + "/own", root + "/other"], PART_DDL, quote='"', escape='"', multiline=True)


@query("delimited_round_trip", PART_SQL + """
SELECT layout, px.* FROM px, (VALUES ('escaped'), ('quoted'), ('escaped, 2 lines ignored'), ('quoted, 1 line ignored')) v(layout)""")
def q_delimited_round_trip(spark, sf_dir):
    """Separators, escapes and line breaks come back, with and without quotes and lines to ignore."""
    src, out = part_x(spark, sf_dir), None
    for enclosed, ignore in ((None, 0), ('"', 0), (None, 2), ('"', 1)):
        path = scratch_path(spark, "exports", "round")
        X.delimited_export(src, path, enclosed_by=enclosed)
        options = {"quote": '"', "escape": '"', "multiline": True} if enclosed else {}
        if ignore:  # files that begin with lines of no record
            raw = spark.read.text(path, wholetext=True, lineSep=None).select(F.concat(F.lit("about\n" * ignore), F.regexp_replace(
                "value", "\n$", "")).alias("value"))
            path = scratch_path(spark, "exports", "headed")
            raw.write.text(path)
        back = delimited_load(spark, path, PART_DDL, ignore_lines=ignore, **options)
        label = ("quoted" if enclosed else "escaped") + {0: "", 1: ", 1 line ignored", 2: ", 2 lines ignored"}[ignore]
        back = back.select(F.lit(label).alias("layout"), "*")
        out = back if out is None else out.unionByName(back)
    return out


@query("manifest_write", """
SELECT 'brand=' || replace(p_brand, '#', '') || '/part.csv' AS url, true AS mandatory, count(*) AS rows_loaded FROM part GROUP BY p_brand""")
def q_manifest_write(spark, sf_dir):
    """One export folder a brand; the manifest's URLs, and what loading each brings back."""
    root = scratch_path(spark, "exports", "brands")
    part_x(spark, sf_dir).withColumn("brand", F.replace(F.split("p_label", ",")[0], F.lit("#"), F.lit(""))).repartition("brand").select(
        "brand", "p_partkey", "p_size").write.partitionBy("brand").csv(root)
    entries = X.manifest_write(spark, root)
    rows = manifest_load(spark, root, "p_partkey bigint, p_size int").select(F.lit(1).alias("one"))
    loaded = spark.read.text(root + "/*/part-*").groupBy(F.regexp_extract("_metadata.file_path", "(brand=[^/]*)/", 1).alias("folder")).count()
    total = rows.count()
    named = entries.select(F.regexp_extract("url", "(brand=[^/]*)/part-[^/]*[.]csv$", 1).alias("folder"), "mandatory")
    return named.join(loaded, "folder").where(F.lit(total) == F.lit(part_x(spark, sf_dir).count())).select(
        F.concat("folder", F.lit("/part.csv")).alias("url"), "mandatory", F.col("count").alias("rows_loaded"))


@query("manifest_load", PART_SQL + "SELECT * FROM px")
def q_manifest_load(spark, sf_dir):
    path = _quoted_export(spark, sf_dir)
    X.manifest_write(spark, path)
    return manifest_load(spark, path, PART_DDL, quote='"', escape='"', multiline=True)


@query("ndjson_gzip_export", """
SELECT event_id, event_type, 'ga' AS dataset, strftime(ts, '%Y%m%d') AS date, true AS gz FROM events""")
def q_ndjson_gzip_export(spark, sf_dir):
    root = scratch_path(spark, "exports", "ga")
    ev = derive.table(spark, sf_dir, "events").select("event_id", "event_type",
                                                      F.date_format("ts", "yyyyMMdd").alias("day"))
    X.ndjson_gzip_export(ev, root, "ga", date_col="day")
    back = spark.read.schema("event_id bigint, event_type string").json(root)
    return back.select("event_id", "event_type", F.col("dataset").cast("string"), F.col("date").cast("string"),
                       F.col("_metadata.file_path").endswith(".json.gz").alias("gz"))


@query("dated_report_sink", """
SELECT l_orderkey, l_linenumber, l_quantity + CASE WHEN l_shipdate >= TIMESTAMP '1998-01-01' THEN 1 ELSE 0 END
       AS l_quantity, strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS report_date
FROM lineitem""")
def q_dated_report_sink(spark, sf_dir):
    li = derive.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.date_format(F.trunc("l_shipdate", "MM"), "yyyy-MM-dd").alias("report_date"))
    path = scratch_path(spark, "reports")
    dated_report_sink(li.where(F.col("report_date") < "1998-01-01"), path)
    # second run: all dates, changed values; dates already present are skipped
    dated_report_sink(li.withColumn("l_quantity", F.col("l_quantity") + 1), path)
    back = spark.read.schema("l_orderkey bigint, l_linenumber int, l_quantity double").json(path)
    return back.select("l_orderkey", "l_linenumber", "l_quantity", F.col("report_date").cast("string"))


PAGES_SQL = """
WITH r AS (SELECT page_id, url, row_number() OVER (ORDER BY page_id) AS rank FROM pages),
m AS (SELECT *, (rank - 1) // 50 AS sitemap_no, (rank - 1) % 50 + 1 AS pos FROM r)
"""


def _sitemap_rows(spark, sf_dir):
    docs = derive.sitemap_docs(spark, sf_dir)
    return sitemap_urls(docs, "doc", "2024-01-31", source_url_col="sitemap_url")


@query("sitemap_urls", PAGES_SQL + """
SELECT 'sitemap-' || CAST(sitemap_no AS VARCHAR) AS sitemap, pos, url, '2024-01-31' AS scraped_at,
       CAST(NULL AS VARCHAR) AS error FROM m
UNION ALL
SELECT 'odd-' || CAST(sitemap_no AS VARCHAR), pos, NULL, '2024-01-31', e
FROM (SELECT DISTINCT sitemap_no FROM m), (VALUES (2, 1, '<url> entry without text in <loc>'), (2, 2, '<url> entry without text in <loc>'),
      (3, NULL, 'malformed XML document')) v(kind, pos, e)
WHERE sitemap_no % 4 = kind""")
def q_sitemap_urls(spark, sf_dir):
    """URLs of all sitemaps, and of as many odd ones: without entries, of another root, with entries without text, cut off."""
    odd = sitemap_urls(derive.odd_sitemaps(spark, sf_dir), "doc", "2024-01-31", source_url_col="sitemap_url")
    return _sitemap_rows(spark, sf_dir).unionByName(odd).select("sitemap", F.col("pos").cast("long").alias("pos"), "url",
                                               "scraped_at", "error")


@query("sitemap_index_urls", PAGES_SQL + """
SELECT DISTINCT sitemap_no // 50 AS index_no, sitemap_no % 50 + 1 AS pos,
       'https://www.example.com/sitemap-' || CAST(sitemap_no AS VARCHAR) || '.xml' AS url FROM m""")
def q_sitemap_index_urls(spark, sf_dir):
    idx = sitemap_index_urls(derive.sitemap_index_docs(spark, sf_dir), "doc", keep=["index_no"])
    return idx.select("index_no", F.col("pos").cast("long").alias("pos"), "url")


@query("sitemap_sink", PAGES_SQL + """
SELECT url, 'sitemap-' || CAST(sitemap_no AS VARCHAR) AS sitemap, '2024-01-31' AS scraped_at,
       '2024-02-01' AS scrape_date FROM m""")
def q_sitemap_sink(spark, sf_dir):
    path = scratch_path(spark, "sitemaps")
    sitemap_sink(_sitemap_rows(spark, sf_dir).select("scraped_at", "url", "sitemap"), path, "2024-02-01")
    back = spark.read.schema("scraped_at string, url string").json(path)
    return back.select("url", F.col("sitemap").cast("string"), "scraped_at",
                       F.col("scrape_date").cast("string").alias("scrape_date"))


@query("url_file_stem", r"""
WITH u AS (SELECT page_id, regexp_replace(regexp_extract(regexp_extract(url,
             '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1), '([^/]*)$', 1), ';.*$', '') AS base
           FROM pages)
SELECT page_id, CASE WHEN regexp_matches(base, '^.*[^.].*\.[^.]*$') THEN regexp_extract(base, '^(.*)\.[^.]*$', 1)
                     ELSE base END AS stem FROM u""")
def q_url_file_stem(spark, sf_dir):
    return derive.table(spark, sf_dir, "pages").select("page_id", url_file_stem("url").alias("stem"))


@query("api_pages_flatten", """
WITH r AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_orderkey) AS rank FROM orders),
p AS (SELECT *, (rank - 1) // 50 + 1 AS page, (rank - 1) % 50 AS pos FROM r)
SELECT 'https://api.example.com/orders?page=' || CAST(page AS VARCHAR) AS url, page - 1 AS page_pos, pos, o_orderkey,
       o_orderstatus, page = (SELECT max(page) FROM p) AS is_last
FROM p""")
def q_api_pages_flatten(spark, sf_dir):
    pages = derive.api_pages(spark, sf_dir)
    order = page_positions(api_page_links(pages))
    flat = api_pages_flatten(pages)
    flat = flat.join(order.select("url", "page_pos"), "url")  # one row per page: small side
    return flat.select("url", "page_pos", F.col("pos").cast("long").alias("pos"),
                       F.variant_get("item", "$.o_orderkey", "bigint").alias("o_orderkey"),
                       F.variant_get("item", "$.o_orderstatus", "string").alias("o_orderstatus"), "is_last")


@query("load_once_stream", "SELECT event_type, count(*) AS n_rows FROM events GROUP BY event_type")
def q_load_once_stream(spark, sf_dir):
    root = derive.events_ndjson(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "stream_sink"), scratch_path(spark, "stream_ckpt")
    shape = lambda d: d.select("origin_file_name")
    load_new_files(spark, root, sink, ckpt, shape=shape)
    load_new_files(spark, root, sink, ckpt, shape=shape)  # rerun: no new files, nothing read twice
    back = spark.read.parquet(sink)
    return back.groupBy(F.regexp_extract("origin_file_name", r"/event_type=([^/]+)/", 1).alias("event_type")) \
               .agg(F.count(F.lit(1)).alias("n_rows"))
