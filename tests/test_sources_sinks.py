import os

import pytest
from pyspark.sql import functions as F

from sluice.sinks import export as X
from sluice.sinks import guard
from sluice.sinks.dated import dated_report_sink
from sluice.sources.delimited import delimited_load, manifest_load
from sluice.sources.files import load_once, object_inventory
from sluice.sources.landing import variant_landing
from sluice.streaming.incremental import load_new_files


def _write(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_variant_landing(spark, tmp):
    _write(tmp + "/in", "a.json", '{"date":"2020-01-01","k":1}\n{"date":"2020-01-01"} junk\n\n{"date":"2020-01-02 10:00:00"}\n')
    _write(tmp + "/in", "b.json", '{"k":3}\n')
    d = variant_landing(spark, tmp + "/in").orderBy("origin_file_name", "origin_file_line").collect()
    assert [(r["origin_file_name"].rsplit("/", 1)[1], r["origin_file_line"]) for r in d] == [
        ("a.json", 1), ("a.json", 2), ("a.json", 3), ("b.json", 1)]  # blank lines are not records
    assert d[1]["properties"] is None and d[1]["origin_str"] == '{"date":"2020-01-01"} junk'
    assert len({r["id"] for r in d}) == 4
    sel = variant_landing(spark, tmp + "/in", file="b.json").count()
    assert sel == 1
    day = variant_landing(spark, tmp + "/in", pattern=".*/a\\.json").where(guard.slice_date("date", "2020-01-02"))
    assert day.count() == 1
    with pytest.raises(ValueError):
        from sluice.sources.files import file_predicate
        file_predicate()


def test_strip_outer_array(spark, tmp):
    _write(tmp + "/arr", "a.json", '[\n{"k":1},\n{"k":2},\n{"k":3}\n]\n')
    _write(tmp + "/arr", "b.json", '[{"k":4},\n{"k":5}]\n')
    d = variant_landing(spark, tmp + "/arr", strip_outer_array=True).orderBy("origin_file_name", "origin_file_line")
    got = [(r["origin_file_name"].rsplit("/", 1)[1], r["origin_file_line"], r["origin_str"]) for r in d.collect()]
    assert got == [("a.json", 1, '{"k":1}'), ("a.json", 2, '{"k":2}'), ("a.json", 3, '{"k":3}'),
                   ("b.json", 1, '{"k":4}'), ("b.json", 2, '{"k":5}')]


def test_arrays_in_any_layout(spark, tmp):
    for name, text in (("one", '[{"k":1},{"k":"a,]"}]'), ("pretty", '[\n {"k": 1},\n {\n"k": "a,]"\n}\n]\n'), ("lines", '[\n{"k":1},\n{"k":"a,]"}\n]'),
                       ("rows", '[{"k":1}]\n\n[{"k":"a,]"}]\n')):
        _write(f"{tmp}/{name}", "f.json", text)
        rows = variant_landing(spark, f"{tmp}/{name}", strip_outer_array=True).orderBy("origin_file_line").collect()
        assert [(r["origin_file_line"], r["origin_str"]) for r in rows] == [(1, '{"k":1}'), (2, '{"k":"a,]"}')], name
    _write(tmp + "/bad", "f.json", '[{"k":1},\n{"k":\n')
    bad = variant_landing(spark, tmp + "/bad", strip_outer_array=True).collect()
    assert all(r["properties"] is None for r in bad) and len(bad) == 2


def test_landed_load_history(spark, tmp):
    from sluice.sinks.load import landed_load, read_ledger

    src, target, ledger = tmp + "/in", tmp + "/t", tmp + "/ledger"
    run = lambda **k: landed_load(spark, src, target, ledger, "tab", date_property="d", partition_col="slice_date", **k).first()
    _write(src, "a.json", '{"d":"2024-01-01","v":1}\n')
    day = lambda d: F.col("slice_date") == d
    assert tuple(run(pred=day("2024-01-01"))) == ("appended", 1)
    assert run(pred=day("2024-01-01"))["action"] == "skipped"
    assert run(pred=day("2024-01-02"))["action"] == "nothing_new"
    _write(src, "b.json", '{"d":"2024-01-02","v":2}\n')
    assert tuple(run(pred=day("2024-01-02"))) == ("appended", 1)
    assert read_ledger(spark, ledger, "tab").count() == 2 and read_ledger(spark, ledger, "other").count() == 0
    ids = [r["id"] for r in guard.read_target(spark, target).collect()]
    assert len(set(ids)) == 2
    assert tuple(run(pred=day("2024-01-01"), overwrite=True, pattern=".*/a\\.json")) == ("replaced", 1)  # files of the history are read again
    assert guard.read_target(spark, target).count() == 2 and read_ledger(spark, ledger, "tab").count() == 2
    assert tuple(run(truncate=True)) == ("truncated", 2)
    assert read_ledger(spark, ledger, "tab").count() == 2


def test_load_once(spark, tmp):
    _write(tmp + "/in", "a.json", "{}\n")
    _write(tmp + "/in", "b.json", "{}\n")
    files = object_inventory(spark, tmp + "/in").select("path")
    ledger = files.where(F.col("path").endswith("a.json"))
    assert [r[0].rsplit("/", 1)[1] for r in load_once(files, ledger).collect()] == ["b.json"]
    assert load_once(files, ledger, force=True).count() == 2


def test_guarded_slice_load(spark, tmp):
    path = tmp + "/t"
    base = spark.createDataFrame([(1, "d1", 1.0), (2, "d2", 2.0)], "id int, slice_date string, v double")
    pred = F.col("slice_date") == "d2"
    assert guard.guarded_slice_load(spark, path, base, pred, partition_col="slice_date").first()["action"] == "appended"
    new = spark.createDataFrame([(3, "d2", 30.0)], "id int, slice_date string, v double")
    assert guard.guarded_slice_load(spark, path, new, pred, partition_col="slice_date").first()["action"] == "skipped"
    st = guard.guarded_slice_load(spark, path, new, pred, overwrite=True, partition_col="slice_date").first()
    assert (st["action"], st["rows"]) == ("replaced", 1)
    got = sorted((r["id"], r["v"]) for r in guard.read_target(spark, path).collect())
    assert got == [(1, 1.0), (3, 30.0)]
    bad = new.withColumn("v", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception):
        guard.guarded_slice_load(spark, path, bad, pred, overwrite=True, partition_col="slice_date")
    assert sorted(r["id"] for r in guard.read_target(spark, path).collect()) == [1, 3]
    guard.guarded_slice_load(spark, path, new, pred, overwrite=True, check=False, partition_col="slice_date")
    assert guard.read_target(spark, path).count() == 3  # unchecked append never deletes
    guard.guarded_slice_load(spark, path, new, None, truncate=True, partition_col="slice_date")
    assert guard.read_target(spark, path).count() == 1


def test_empty_replacement_removes_slice(spark, tmp):
    path = tmp + "/t"
    base = spark.createDataFrame([(1, "d1"), (2, "d2")], "id int, slice_date string")
    guard.guarded_slice_load(spark, path, base, None, partition_col="slice_date")
    empty = base.limit(0)
    guard.guarded_slice_load(spark, path, empty, F.col("slice_date") == "d2", overwrite=True,
                             partition_col="slice_date")
    assert [r["id"] for r in guard.read_target(spark, path).collect()] == [1]


def test_raw_slice_and_swap(spark, tmp):
    path = tmp + "/plain"
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    base.write.parquet(path)
    guard.guarded_slice_load(spark, path, spark.createDataFrame([(9, "b")], "id int, k string"),
                             guard.slice_raw("WHERE k = 'b'"), overwrite=True)
    assert sorted(r["id"] for r in guard.read_target(spark, path).collect()) == [1, 9]
    assert guard.slice_exists(guard.read_target(spark, path), guard.slice_raw(""))
    guard.swap_overwrite(spark, base, "swap_t", tmp + "/tables")
    guard.swap_overwrite(spark, base.withColumn("extra", F.lit(1)), "swap_t", tmp + "/tables")
    assert spark.table("swap_t").columns == ["id", "k", "extra"]


def test_exports_and_manifest(spark, tmp):
    df = spark.createDataFrame([(1, "a,b", None), (2, "", "x\\y")], "id int, s string, t string")
    out = tmp + "/exp"
    X.delimited_export(df, out, enclosed_by="NONE", escape="\\")
    lines = sorted(r[0] for r in spark.read.text(out).collect())
    assert lines == ["1,a\\,b,\\N", "2,,x\\\\y"]
    with pytest.raises(FileExistsError):
        X.delimited_export(df, out, overwrite=False)
    q = tmp + "/q"
    X.delimited_export(df, q, enclosed_by='"')
    back = delimited_load(spark, q, "id int, s string, t string", quote='"', escape='"', multiline=True).orderBy("id").collect()
    assert [tuple(r) for r in back] == [(1, "a,b", None), (2, "", "x\\y")]
    entries = X.manifest_write(spark, q).collect()
    assert entries and all(e["mandatory"] for e in entries)
    assert manifest_load(spark, q, "id int, s string, t string", quote='"', escape='"').count() == 2
    skip = tmp + "/skip"
    delimited_text = "h1\nh2\n1,x\n2,y\n"
    _write(skip, "f1.csv", delimited_text)
    _write(skip, "f2.csv", delimited_text)
    assert delimited_load(spark, skip, "id int, s string", ignore_lines=2).count() == 4


def test_delimited_text_as_mysql_reads_it(spark, tmp):
    ddl = "id int, s string, t string"
    rows = [(1, "a,b", "x"), (2, "c\\,d\\\\", None), (3, "two\nlines", ""), (4, '"q" ""', "\t\\n"), (5, "\\N", "end\\")]
    df = spark.createDataFrame(rows, ddl)
    for k, options in enumerate(({}, {"enclosed_by": '"'})):
        out = f"{tmp}/trip{k}"
        X.delimited_export(df, out, **options)
        load = {"quote": '"', "escape": '"', "multiline": True} if options else {}
        back = delimited_load(spark, out, ddl, **load).orderBy("id").collect()
        assert [tuple(r) for r in back] == rows
    _write(tmp + "/mysql", "a.txt", "1,a\\,b,\\N\n2,line\\\nbreak,\\\\\n3,\\tab\\0,\n")
    back = delimited_load(spark, tmp + "/mysql", ddl, multiline=True).orderBy("id").collect()
    assert [tuple(r) for r in back] == [(1, "a,b", None), (2, "line\nbreak", "\\"), (3, "\tab\x00", "")]
    _write(tmp + "/quoted", "a.txt", 'h1\nh2\n1,"a\nb",x\n2,"say ""hi""",\n')
    back = delimited_load(spark, tmp + "/quoted", ddl, quote='"', escape='"', ignore_lines=2, multiline=True).orderBy("id").collect()
    assert [tuple(r) for r in back] == [(1, "a\nb", "x"), (2, 'say "hi"', "")]
    X.delimited_export(df.where("id = 1"), tmp + "/never", escape="NONE")
    assert spark.read.text(tmp + "/never").first()[0] == "1,a,b,x"


def test_delimited_errors_are_reported(spark, tmp):
    _write(tmp + "/bad", "a.csv", "1,x\nno,y\n3,z,more\n4\n99999999999,w\n,empty\n")
    with pytest.raises(Exception, match="id can't hold|fields instead of"):
        delimited_load(spark, tmp + "/bad", "id int, s string").collect()
    got = {r["s"]: (r["id"], r["_errors"]) for r in delimited_load(spark, tmp + "/bad", "id int, s string", on_error="column").collect()}
    assert got["x"] == (1, []) and got["y"] == (None, ["id can't hold: no"]) and got["z"] == (3, ["3 fields instead of 2"])
    assert got[None] == (4, ["1 fields instead of 2"]) and got["w"] == (None, ["id can't hold: 99999999999"]) and got["empty"] == (None, [])


def test_manifest_is_one_object(spark, tmp):
    import json

    df = spark.range(20).selectExpr("id", "cast(id as string) s")
    out = tmp + "/m"
    X.delimited_export(df.repartition(3), out)
    X.manifest_write(spark, out)
    X.manifest_write(spark, out)  # again: the manifest itself is no entry
    with open(out + "/manifest.json") as f:
        entries = json.load(f)["entries"]
    assert len(entries) == 3 and all(e["mandatory"] for e in entries)
    assert manifest_load(spark, out, "id int, s string").count() == 20
    os.remove(out + "/.manifest.json.crc")
    with open(out + "/manifest.json", "w") as f:  # pretty-printed, with files that are not there
        json.dump({"entries": entries + [{"url": entries[0]["url"] + "x", "mandatory": False}]}, f, indent=2)
    assert manifest_load(spark, out, "id int, s string").count() == 20
    with open(out + "/manifest.json", "w") as f:
        json.dump({"entries": entries + [{"url": entries[0]["url"] + "x", "mandatory": True}]}, f, indent=2)
    with pytest.raises(FileNotFoundError):
        manifest_load(spark, out, "id int, s string")


def _slices(spark, path):
    return sorted((r["day"], r["view"], r["v"]) for r in guard.read_target(spark, path).collect())


def test_slice_load_leaves_all_other_rows(spark, tmp):
    ddl = "day string, view string, v int"
    path = tmp + "/t"
    old = [("d1", "v1", 1), ("d1", "v2", 2), ("d2", "v1", 3), ("d3", "v1", 4)]
    spark.createDataFrame(old, ddl).write.partitionBy("day").parquet(path)
    pred = (F.col("day") == "d1") & (F.col("view") == "v1")
    new = spark.createDataFrame([("d1", "v1", 10), ("d2", "v9", 11), ("d4", "v1", 12)], ddl)
    guard.guarded_slice_load(spark, path, new, pred, overwrite=True, partition_col="day")
    want = sorted(old[1:] + [("d1", "v1", 10), ("d2", "v9", 11), ("d4", "v1", 12)])
    assert _slices(spark, path) == want


def test_dated_sink_skips_existing(spark, tmp):
    path = tmp + "/rep"
    a = spark.createDataFrame([("2020-01-01", 1), ("2020-01-02", 2)], "report_date string, v int")
    dated_report_sink(a.where("report_date = '2020-01-01'"), path)
    st = dated_report_sink(a.withColumn("v", F.col("v") * 10), path).first()
    assert st["rows"] == 1
    got = sorted((str(r["report_date"]), r["v"]) for r in spark.read.json(path).collect())
    assert got == [("2020-01-01", 1), ("2020-01-02", 20)]


def test_stream_load_new_files_only(spark, tmp):
    src, sink, ckpt = tmp + "/src", tmp + "/sink", tmp + "/ckpt"
    _write(src, "a.txt", "1\n2\n")
    load_new_files(spark, src, sink, ckpt)
    _write(src, "b.txt", "3\n")
    load_new_files(spark, src, sink, ckpt)
    load_new_files(spark, src, sink, ckpt)
    assert sorted(r["value"] for r in spark.read.parquet(sink).collect()) == ["1", "2", "3"]


def test_stream_incremental_parquet(spark, tmp):
    from sluice.streaming.incremental import high_water_stream

    src, sink, ckpt = tmp + "/src", tmp + "/sink", tmp + "/ckpt"
    schema = "id long, modified timestamp"
    spark.createDataFrame([(1, None), (2, None)], schema).write.parquet(src + "/a")
    first = high_water_stream(spark, src + "/a", sink, ckpt, "modified", schema)
    spark.createDataFrame([(3, None)], schema).write.mode("append").parquet(src + "/a")
    second = high_water_stream(spark, src + "/a", sink, ckpt, "modified", schema)
    third = high_water_stream(spark, src + "/a", sink, ckpt, "modified", schema)
    assert (first, second, third) == (1, 1, 0)
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == [1, 2, 3]


def test_landing_into_partitioned_target(spark, tmp):
    src = tmp + "/in"
    _write(src, "d1.json", '{"date":"2020-01-01 10:00:00","k":1}\n{"date":"2020-01-02","k":2}\n')
    target = tmp + "/landing"
    first = variant_landing(spark, src, date_property="date").drop("properties")
    guard.guarded_slice_load(spark, target, first, None, partition_col="slice_date")
    _write(tmp + "/in2", "d2.json", '{"date":"2020-01-02T08:00:00","k":20}\n')
    again = variant_landing(spark, tmp + "/in2", date_property="date").drop("properties")
    pred = F.col("slice_date") == "2020-01-02"
    st = guard.guarded_slice_load(spark, target, again, pred, overwrite=True, partition_col="slice_date").first()
    assert st["action"] == "replaced"
    got = sorted((str(r["slice_date"]), r["origin_str"]) for r in guard.read_target(spark, target).collect())
    assert got == [("2020-01-01", '{"date":"2020-01-01 10:00:00","k":1}'),
                   ("2020-01-02", '{"date":"2020-01-02T08:00:00","k":20}')]
    sess = variant_landing(spark, src, date_property=None)
    assert "slice_date" not in sess.columns


def test_export_options(spark, tmp):
    import glob

    df = spark.createDataFrame([(1, bytearray(b"\x01\xff")), (2, None)], "id int, b binary")
    X.delimited_export(df, tmp + "/hex", binary_format="HEX")
    assert sorted(r[0] for r in spark.read.text(tmp + "/hex").collect()) == ["1,01FF", "2,\\N"]
    X.delimited_export(df, tmp + "/b64", binary_format="BASE64", null_marker="NULL")
    assert sorted(r[0] for r in spark.read.text(tmp + "/b64").collect()) == ["1,Af8=", "2,NULL"]
    many = spark.range(0, 400, 1, 4).withColumn("s", F.lit("x" * 20))
    X.delimited_export(many, tmp + "/one", single=True)
    assert len(glob.glob(tmp + "/one/part-*")) == 1
    X.delimited_export(many, tmp + "/capped", max_file_bytes=2000)
    files = glob.glob(tmp + "/capped/part-*")
    assert len(files) > 4 and sum(1 for f in files for _ in open(f)) == 400


def test_one_wide_row_leaves_files_near_the_cap(spark, tmp):
    import glob

    rows = spark.range(0, 20_000, 1, 2).select("id", F.when(F.col("id") == 7, F.repeat(F.lit("w"), 200_000)).otherwise(F.lit("x")).alias("s"))
    for cap, most in ((100_000, 6), (1_000_000, 2)):
        out = f"{tmp}/{cap}"
        X.delimited_export(rows, out, max_file_bytes=cap)
        sizes = [os.path.getsize(f) for f in glob.glob(out + "/part-*")]
        assert len(sizes) <= most and sorted(sizes)[:-1] == [n for n in sorted(sizes)[:-1] if n <= cap]
        assert max(sizes) <= max(cap, 200_010)
    got = sorted(int(line.split(",")[0]) for f in glob.glob(tmp + "/100000/part-*") for line in open(f))
    assert got == list(range(20_000))


def test_manifest_lists_all_folders_at_once(spark, tmp):
    import json

    for folder in ("a", "b,c", "b{d"):
        os.makedirs(f"{tmp}/m/{folder}")
        with open(f"{tmp}/m/{folder}/x.csv", "w") as f:
            f.write("1\n")
    entry = lambda url, mandatory: {"url": f"file:{tmp}/m/{url}", "mandatory": mandatory}
    entries = [entry("a/x.csv", True), entry("b,c/x.csv", True), entry("b{d/x.csv", True), entry("none/x.csv", False)]
    with open(f"{tmp}/m/manifest.json", "w") as f:
        json.dump({"entries": entries}, f)
    from sluice.sources.delimited import _listed

    assert _listed(spark, [f"{tmp}/m/{x}" for x in ("a", "b,c", "b{d", "none")]).count() == 3
    assert _listed(spark, [f"{tmp}/m/a"]).count() == 1 and _listed(spark, [f"{tmp}/m/none"]).count() == 0
    with open(f"{tmp}/m/manifest.json", "w") as f:
        json.dump({"entries": [*entries[:1], entry("none/x.csv", False)]}, f)
    assert manifest_load(spark, tmp + "/m", "a int").count() == 1


def test_raw_conditions(spark):
    from sluice.sources.scan import projected_scan

    df = spark.createDataFrame([(1, "x"), (2, "y")], "id int, whereabouts string")
    for text, n in (("whereabouts = 'x'", 1), ("WHERE whereabouts = 'x'", 1), (" where(id > 1)", 1), ("where", 2), ("", 2), (None, 2)):
        assert projected_scan(df, ["id"], text).count() == n
        assert df.where(guard.slice_raw(text)).count() == n


def test_manifest_missing_mandatory(spark, tmp):
    import json

    os.makedirs(tmp + "/m/manifest.json", exist_ok=True)
    with open(tmp + "/m/manifest.json/part-0.json", "w") as f:
        f.write(json.dumps({"entries": [{"url": tmp + "/m/nope.csv", "mandatory": True}]}) + "\n")
    with pytest.raises(FileNotFoundError):
        manifest_load(spark, tmp + "/m", "a int")


def test_ndjson_gzip_one_date(spark, tmp):
    import glob

    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    st = X.ndjson_gzip_export(df, tmp + "/ga", "views", "20200101").first()
    assert st["rows"] == 2
    files = glob.glob(tmp + "/ga/dataset=views/date=20200101/*.json.gz")
    assert files and spark.read.json(tmp + "/ga").count() == 2


def test_record_replace_unknown_field(spark):
    from sluice.operators.records import record_replace
    from sluice.spec import IntegerField, RecordSpec

    spec = RecordSpec(IntegerField("id"))
    with pytest.raises(TypeError, match="Unknown fields specified: nope"):
        record_replace(spark.createDataFrame([(1,)], "id long"), spec, nope=F.lit(1))


def test_load_once_reloads_changed_files(spark, tmp):
    files = spark.createDataFrame([("a", 1), ("b", 2)], "path string, modified long")
    ledger = spark.createDataFrame([("a", 1), ("b", 1)], "path string, modified long")
    assert [r[0] for r in load_once(files, ledger, key=["path", "modified"]).collect()] == ["b"]
    assert load_once(files, ledger).count() == 0


def test_session_slice_column_and_lookback(spark, tmp):
    import datetime as dt

    from sluice.operators.sync import high_water_filter
    from sluice.sources.landing import session_landing

    _write(tmp + "/s", "a.json", '{"date":"20200101","x":1}\n{"date":"20200102","x":2}\n')
    d = session_landing(spark, tmp + "/s", "view-1", date_key="date")
    assert sorted(r["slice_date"] for r in d.collect()) == ["20200101", "20200102"]
    assert d.where(guard.slice_session("20200102", "view-1")).count() == 1
    rows = spark.createDataFrame([(1, dt.datetime(2020, 1, 1, 10)), (2, dt.datetime(2020, 1, 1, 12))],
                                 "id int, m timestamp")
    assert [r["id"] for r in high_water_filter(rows, "m", "2020-01-01 11:00:00").collect()] == [2]
    assert high_water_filter(rows, "m", "2020-01-01 11:00:00", lookback="2 hours").count() == 2
    assert high_water_filter(rows, "m", None).count() == 2


def test_incremental_sync_with_batched_payload(spark, tmp):
    import datetime as dt

    from sluice.operators.sync import incremental_sync, unsubscribe_payload

    src = spark.createDataFrame([(f"u{i}@x.org", dt.datetime(2020, 1, 1) + dt.timedelta(hours=i)) for i in range(120)],
                                "email string, lastmodifieddate timestamp")
    pay = lambda df: unsubscribe_payload(df, ["email"])
    r1 = incremental_sync(spark, src.where("lastmodifieddate < '2020-01-03'"), tmp + "/state", tmp + "/out",
                          "lastmodifieddate", "k", payload=pay).first()
    assert (r1["rows"], r1["mark"]) == (48, "2020-01-02T23:00:00")
    r2 = incremental_sync(spark, src, tmp + "/state", tmp + "/out", "lastmodifieddate", "k", payload=pay).first()
    assert (r2["rows"], r2["previous_mark"], r2["mark"]) == (72, "2020-01-02T23:00:00", "2020-01-05T23:00:00")
    batches = spark.read.parquet(tmp + "/out")
    assert batches.agg(F.sum("n")).first()[0] == 120 and batches.agg(F.max("n")).first()[0] <= 50


def test_dated_sink_overwrite_replaces_only_written_dates(spark, tmp):
    path = tmp + "/rep2"
    a = spark.createDataFrame([("2020-01-01", 1), ("2020-01-02", 2)], "report_date string, v int")
    dated_report_sink(a, path)
    dated_report_sink(a.where("report_date = '2020-01-02'").withColumn("v", F.lit(99)), path, overwrite=True)
    got = sorted((str(r["report_date"]), r["v"]) for r in spark.read.json(path).collect())
    assert got == [("2020-01-01", 1), ("2020-01-02", 99)]
