"""Queries over landed files: landing, file selection, inventories, load ledger, slices, guarded loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sinks import guard
from ..sinks.load import landed_load, read_ledger
from ..sources.files import load_once, object_inventory
from ..sources.landing import session_landing, variant_landing
from ..session import scratch_path
from . import derive
from .registry import query

SLICE_DAY = "2024-01-07"
SLICE_DAY_COMPACT = "20240107"
FIRST_RUN_TYPES = ("click", "view")

EVENT_LINES_SQL = """
WITH src AS (
  SELECT event_id, event_type, ts, props, value, user_id,
         event_id // 5000 AS chunk,
         '{"date":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '","day":"' || strftime(ts, '%Y%m%d')
         || '","event_id":' || CAST(event_id AS VARCHAR) || ',"event_type":"' || event_type
         || '","props":' || coalesce(props, 'null') || '}' AS line
  FROM events),
landed AS (
  SELECT *, CASE WHEN event_id % 10 = 0 THEN substr(line, 2) ELSE line END AS origin_str,
         event_id % 10 <> 0 AS is_valid,
         row_number() OVER (PARTITION BY event_type, chunk ORDER BY event_id) AS origin_file_line
  FROM src)
"""


def _landed(spark, sf_dir, pattern=None, file=None, line_numbers=True):
    root = derive.events_ndjson(spark, sf_dir)
    return variant_landing(spark, root, file=file, pattern=pattern, keep=["event_type"], line_numbers=line_numbers)


def _chunk():
    return F.regexp_extract("origin_file_name", r"/chunk=([0-9]+)/", 1).cast("long").alias("chunk")


@query("variant_landing", EVENT_LINES_SQL + """
SELECT event_type, chunk, origin_file_line, origin_str,
       CASE WHEN is_valid THEN event_id END AS prop_event_id,
       CASE WHEN is_valid THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS prop_date,
       CASE WHEN is_valid THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS prop_k,
       is_valid
FROM landed""")
def q_variant_landing(spark, sf_dir):
    d = _landed(spark, sf_dir)
    p = F.col("properties")
    return d.select("event_type", _chunk(), "origin_file_line", "origin_str",
                    F.try_variant_get(p, "$.event_id", "bigint").alias("prop_event_id"),
                    F.try_variant_get(p, "$.date", "string").alias("prop_date"),
                    F.try_variant_get(p, "$.props.k", "bigint").alias("prop_k"),
                    p.isNotNull().alias("is_valid"))


@query("session_landing", EVENT_LINES_SQL + """
SELECT 'view-42' AS ga_view_id, chunk, origin_file_line,
       CASE WHEN is_valid THEN event_id END AS session_event_id,
       CASE WHEN is_valid THEN event_type END AS session_event_type
FROM landed""")
def q_session_landing(spark, sf_dir):
    root = derive.events_ndjson(spark, sf_dir)
    d = session_landing(spark, root, "view-42", pattern=".*")
    v = F.col("session")
    return d.select("ga_view_id", _chunk(), "origin_file_line",
                    F.try_variant_get(v, "$.event_id", "bigint").alias("session_event_id"),
                    F.try_variant_get(v, "$.event_type", "string").alias("session_event_type"))


@query("file_select", EVENT_LINES_SQL + """
SELECT event_type, chunk, count(*) AS n_rows, max(origin_file_line) AS last_line
FROM landed WHERE event_type IN ('click', 'view') GROUP BY event_type, chunk""")
def q_file_select(spark, sf_dir):
    d = _landed(spark, sf_dir, pattern=".*/event_type=(click|view)/.*")
    return d.groupBy("event_type", _chunk()).agg(F.count(F.lit(1)).alias("n_rows"),
                                                 F.max("origin_file_line").alias("last_line"))


@query("object_inventory", """
SELECT DISTINCT event_type, event_id // 5000 AS chunk,
       1::BIGINT AS n_files, true AS has_bytes FROM events""")
def q_object_inventory(spark, sf_dir):
    root = derive.events_ndjson(spark, sf_dir)
    inv = object_inventory(spark, root)
    return inv.groupBy(F.regexp_extract("path", r"/event_type=([^/]+)/", 1).alias("event_type"),
                       F.regexp_extract("path", r"/chunk=([0-9]+)/", 1).cast("long").alias("chunk")).agg(
        F.count(F.lit(1)).alias("n_files"), F.min(F.col("length") > 0).alias("has_bytes"))


@query("load_once", """
SELECT event_type, count(*) AS n_rows FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY event_type""")
def q_load_once(spark, sf_dir):
    root = derive.events_ndjson(spark, sf_dir)
    files = object_inventory(spark, root).select("path")
    # first run loaded the click and view files: its ledger
    first = _landed(spark, sf_dir, pattern=".*/event_type=(click|view)/.*")
    ledger = first.select(F.col("origin_file_name").alias("path")).distinct()
    todo = load_once(files, ledger)
    # second run: only the files not in the ledger are read
    paths = [r["path"] for r in todo.collect()]  # one row per file (a listing, not data)
    d = variant_landing(spark, paths, keep=[]) if paths else first.limit(0)
    return d.groupBy(F.regexp_extract("origin_file_name", r"/event_type=([^/]+)/", 1).alias("event_type")).agg(
        F.count(F.lit(1)).alias("n_rows"))


@query("landed_load", EVENT_LINES_SQL + """
SELECT event_type, count(*) AS n_rows, count(DISTINCT chunk) AS n_files, event_type IN ('click', 'view') AS first_run,
       true AS ids_unique
FROM landed GROUP BY event_type""")
def q_landed_load(spark, sf_dir):
    """Two loads: the second finds only the files that the first did not read, and a third nothing."""
    root = derive.events_ndjson(spark, sf_dir)
    target, ledger = scratch_path(spark, "targets", "landed"), scratch_path(spark, "ledgers")
    options = {"check": False, "line_numbers": False}
    landed_load(spark, root, target, ledger, "events", pattern=".*/event_type=(click|view)/.*", **options)
    first = guard.read_target(spark, target).agg(F.max("id")).first()[0]
    landed_load(spark, root, target, ledger, "events", **options)
    third = landed_load(spark, root, target, ledger, "events", **options).first()["action"]
    rows = guard.read_target(spark, target)
    unique = rows.select("id").distinct().count() == rows.count() and third == "nothing_new"
    kind = F.regexp_extract("origin_file_name", r"/event_type=([^/]+)/", 1).alias("event_type")
    read = read_ledger(spark, ledger, "events").groupBy(F.regexp_extract("path", r"/event_type=([^/]+)/", 1).alias("event_type")).agg(
        F.count(F.lit(1)).alias("n_files"))
    return rows.groupBy(kind).agg(F.count(F.lit(1)).alias("n_rows"), (F.min("id") <= first).alias("first_run")).join(
        read, "event_type").withColumn("ids_unique", F.lit(unique))


@query("array_landing", EVENT_LINES_SQL + """
SELECT layout, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS prop_date
FROM src, (VALUES ('one line'), ('pretty'), ('line per element')) v(layout)""")
def q_array_landing(spark, sf_dir):
    """The same records as arrays in three layouts: on one line, pretty-printed, and one element a line."""
    e = derive.table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / derive.EVENT_CHUNK).alias("part"), "event_id", derive.event_json_line(broken=False).alias("x"))
    arrays = e.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("event_id", "x"))).alias("e")).withColumn("e", F.transform("e", lambda r: r["x"]))
    out = None
    for layout, left, between, right in (("one line", "[", ",", "]"), ("pretty", "[\n  ", ",\n  ", "\n]"), ("line per element", "[\n", ",\n", "\n]")):
        path = scratch_path(spark, "arrays")
        text = F.concat(F.lit(left), F.array_join("e", between), F.lit(right))
        if layout == "pretty":  # line breaks inside the elements too
            text = F.replace(F.replace(text, F.lit('{"'), F.lit('{\n    "')), F.lit(',"'), F.lit(',\n    "'))
        arrays.select("part", text.alias("value")).write.partitionBy("part").text(path)  # one document a file
        d = variant_landing(spark, path, strip_outer_array=True)
        p = F.col("properties")
        d = d.select(F.lit(layout).alias("layout"), F.try_variant_get(p, "$.event_id", "bigint").alias("event_id"),
                     F.try_variant_get(p, "$.event_type", "string").alias("event_type"), F.try_variant_get(p, "$.date", "string").alias("prop_date"))
        out = d if out is None else out.unionByName(d)
    return out


@query("slice_predicate_date", EVENT_LINES_SQL + f"""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS prop_date
FROM landed WHERE is_valid AND CAST(ts AS DATE) = DATE '{SLICE_DAY}'""")
def q_slice_predicate_date(spark, sf_dir):
    d = _landed(spark, sf_dir, line_numbers=False).where(guard.slice_date("date", SLICE_DAY))
    p = F.col("properties")
    return d.select(F.try_variant_get(p, "$.event_id", "bigint").alias("event_id"),
                    F.try_variant_get(p, "$.date", "string").alias("prop_date"))


@query("slice_predicate_session", EVENT_LINES_SQL + f"""
SELECT 'view-42' AS ga_view_id, event_id, event_type
FROM landed WHERE is_valid AND strftime(ts, '%Y%m%d') = '{SLICE_DAY_COMPACT}'""")
def q_slice_predicate_session(spark, sf_dir):
    root = derive.events_ndjson(spark, sf_dir)
    d = session_landing(spark, root, "view-42", line_numbers=False)
    v = F.col("session")
    return d.where(guard.slice_session(SLICE_DAY_COMPACT, "view-42", key="day")).select("ga_view_id", F.try_variant_get(v, "$.event_id", "bigint").alias("event_id"),
                                F.try_variant_get(v, "$.event_type", "string").alias("event_type"))


@query("slice_exists", EVENT_LINES_SQL + f"""
SELECT '{SLICE_DAY}' AS slice, EXISTS (SELECT 1 FROM landed WHERE is_valid AND CAST(ts AS DATE) = DATE '{SLICE_DAY}')
       AS slice_exists
UNION ALL
SELECT '2025-01-01' AS slice, EXISTS (SELECT 1 FROM landed WHERE is_valid AND CAST(ts AS DATE) = DATE '2025-01-01')
       AS slice_exists""")
def q_slice_exists(spark, sf_dir):
    d = _landed(spark, sf_dir, line_numbers=False)
    rows = [(day, guard.slice_exists(d, guard.slice_date("date", day))) for day in (SLICE_DAY, "2025-01-01")]
    return spark.createDataFrame(rows, "slice string, slice_exists boolean")


# --- guarded loads on a date-partitioned events target ---------------------------------------------

def _target(spark, sf_dir, partitioned=True):
    ev = derive.table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd").alias("slice_date"))
    path = scratch_path(spark, "targets", "events")
    ev.write.partitionBy("slice_date").parquet(path) if partitioned else ev.write.parquet(path)
    return ev, path


def _read_back(spark, path):
    t = guard.read_target(spark, path)
    return t.select("event_id", "event_type", F.col("slice_date").cast("string").alias("slice_date"), "value")


TARGET_SQL = "SELECT event_id, event_type, strftime(ts, '%Y-%m-%d') AS slice_date, value FROM events"


@query("guarded_slice_load", f"""
SELECT event_id, event_type, slice_date, value + CASE WHEN slice_date = '{SLICE_DAY}' THEN 1000 ELSE 0 END AS value
FROM ({TARGET_SQL})""")
def q_guarded_slice_load(spark, sf_dir):
    ev, path = _target(spark, sf_dir)
    pred = F.col("slice_date") == SLICE_DAY
    day = ev.where(pred)
    guard.guarded_slice_load(spark, path, day.withColumn("value", F.col("value") + 1000), pred,
                             overwrite=True, partition_col="slice_date")
    # second run without overwrite: the slice exists, nothing is written
    guard.guarded_slice_load(spark, path, day.withColumn("value", F.col("value") + 2000), pred,
                             overwrite=False, partition_col="slice_date")
    return _read_back(spark, path)


@query("truncate_load", f"""
SELECT event_id, event_type, slice_date, value + 1000 AS value
FROM ({TARGET_SQL}) WHERE slice_date = '{SLICE_DAY}'""")
def q_truncate_load(spark, sf_dir):
    ev, path = _target(spark, sf_dir)
    pred = F.col("slice_date") == SLICE_DAY
    guard.guarded_slice_load(spark, path, ev.where(pred).withColumn("value", F.col("value") + 1000), pred,
                             truncate=True, partition_col="slice_date")
    return _read_back(spark, path)


@query("append_unchecked", f"""
SELECT * FROM ({TARGET_SQL}) UNION ALL SELECT * FROM ({TARGET_SQL}) WHERE slice_date = '{SLICE_DAY}'""")
def q_append_unchecked(spark, sf_dir):
    ev, path = _target(spark, sf_dir)
    pred = F.col("slice_date") == SLICE_DAY
    guard.guarded_slice_load(spark, path, ev.where(pred), pred, overwrite=True, check=False,
                             partition_col="slice_date")
    return _read_back(spark, path)


@query("slice_predicate_raw", f"""
SELECT event_id, event_type, slice_date, value + CASE WHEN event_type = 'click' THEN 1000 ELSE 0 END AS value
FROM ({TARGET_SQL})""")
def q_slice_predicate_raw(spark, sf_dir):
    ev, path = _target(spark, sf_dir, partitioned=False)
    pred = guard.slice_raw("where event_type = 'click'")
    guard.guarded_slice_load(spark, path, ev.where(pred).withColumn("value", F.col("value") + 1000), pred,
                             overwrite=True)
    return _read_back(spark, path)


@query("rollback_on_error", TARGET_SQL)
def q_rollback_on_error(spark, sf_dir):
    ev, path = _target(spark, sf_dir)
    pred = F.col("slice_date") == SLICE_DAY
    bad = ev.where(pred).withColumn(
        "value", F.when(F.col("event_id") >= 0, F.raise_error(F.lit("injected load failure"))).otherwise(F.col("value")))
    for kwargs in ({"overwrite": True, "partition_col": "slice_date"}, {"truncate": True}):
        try:
            guard.guarded_slice_load(spark, path, bad, pred, **kwargs)
        except Exception:  # noqa: BLE001 - the failure is the point: target must be unchanged
            pass
        else:
            raise AssertionError("the injected failure did not fail the load")
    return _read_back(spark, path)


@query("slice_index", """
SELECT strftime(ts, '%Y-%m-%d') AS slice_date, true AS present, 'skipped' AS second_load FROM events GROUP BY 1
UNION ALL SELECT '2031-01-01', false, 'appended'""")
def q_slice_index(spark, sf_dir):
    """An unpartitioned target under an index of its slice key: every day that is there is found, and one that isn't is told
    by the index alone and loaded."""
    ev = derive.table(spark, sf_dir, "events").select("event_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("slice_date"))
    path = scratch_path(spark, "targets", "indexed")
    guard.guarded_slice_load(spark, path, ev, None, key=("slice_date", None))
    days = [*[r[0] for r in ev.select("slice_date").distinct().collect()], "2031-01-01"]
    found = [(d, guard.slice_present(spark, path, "slice_date", d)) for d in days]
    one = ev.limit(1)
    loads = {d: guard.guarded_slice_load(spark, path, one.withColumn("slice_date", F.lit(d)), F.col("slice_date") == d, key=("slice_date", d)).first()["action"]
             for d in (days[0], days[-1])}
    return spark.createDataFrame([(d, p, loads[days[-1] if d == days[-1] else days[0]]) for d, p in found], "slice_date string, present boolean, second_load string")


@query("swap_overwrite", """
SELECT event_id, event_type, value * 2 AS value_x2 FROM events""")
def q_swap_overwrite(spark, sf_dir):
    ev = derive.table(spark, sf_dir, "events")
    loc = scratch_path(spark, "tables")
    name = "sluice_swap_" + loc.rsplit("/", 1)[-1]
    guard.swap_overwrite(spark, ev.select("event_id", "ts", "value"), name, loc)
    # schema change on the second load
    guard.swap_overwrite(spark, ev.select("event_id", "event_type", (F.col("value") * 2).alias("value_x2")), name, loc)
    return spark.table(name)
