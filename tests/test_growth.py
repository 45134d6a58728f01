"""Work that must not grow faster than the input: tasks of a listing, parses of a row, lines that are shuffled."""

import os

from pyspark.sql import functions as F

from sluice.operators import reports as R
from sluice.plans import derive
from sluice.sources import files as S
from sluice.sources import landing as L
from sluice.sources import records


def most_tasks(spark, group, work):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        work()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    return max((tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds if tracker.getStageInfo(s)), default=0)


def test_a_listing_takes_few_tasks(spark, tmp):
    for i in range(150):
        os.makedirs(f"{tmp}/in/k=a/n={i}")
        with open(f"{tmp}/in/k=a/n={i}/x.json", "w") as f:
            f.write("1")
    bound = max(32, 4 * spark.sparkContext.defaultParallelism)
    assert 1 < most_tasks(spark, "inventory", lambda: S.object_inventory(spark, tmp + "/in")) <= bound
    assert 1 < most_tasks(spark, "text", lambda: S.read_text(spark, tmp + "/in")) <= bound
    assert S.object_inventory(spark, tmp + "/in").count() == 150 == S.read_text(spark, tmp + "/in").count()
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == "10000"


def test_a_json_text_is_parsed_once(spark):
    rows = spark.createDataFrame([("1",), ('{"a":1}',), ("1,2",), ("",), ("{",), (None,), ("null",), ("[1,2]",), ("1 2",)], "value string")
    d = rows.select("value", L.strict_json("value").alias("v"))
    assert d._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1
    got = {r["value"]: r["j"] for r in d.select("value", F.to_json("v").alias("j")).collect()}
    assert got == {"1": "1", '{"a":1}': '{"a":1}', "1,2": None, "": None, "{": None, None: None, "null": "null", "[1,2]": "[1,2]", "1 2": None}


def test_arrays_hold_a_chunk_of_events(spark, tmp, monkeypatch):
    from sluice.plans import q_files

    spark.range(0, 6000, 3).selectExpr(
        "id as event_id", "timestamp'2024-01-01' as ts", "1L as user_id", "'click' as event_type", "1.0D as value", "'{\"k\":1}' as props").write.parquet(tmp + "/events.parquet")
    monkeypatch.setattr(q_files, "scratch_path", lambda spark, name: f"{tmp}/{name}/{len(os.listdir(tmp + '/arrays')) if os.path.isdir(tmp + '/arrays') else 0}")
    rows = q_files.q_array_landing(spark, tmp).groupBy("layout").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("s")).collect()
    assert {(r["n"], r["s"]) for r in rows} == {(2000, 3 * 1999 * 1000)} and len(rows) == 3
    assert all(len([x for x in os.listdir(f"{tmp}/arrays/{i}") if x.startswith("part=")]) == -(-6000 // derive.EVENT_CHUNK) for i in range(3))


def test_only_chunks_with_records_of_several_lines_are_shuffled(spark, monkeypatch):
    seen, real = {}, records.materialised
    monkeypatch.setattr(records, "materialised", lambda df, name="side": seen.setdefault(name, real(df, name)))
    monkeypatch.setattr(records, "CHUNK", 10)
    lines = spark.createDataFrame([("a", i, 'x,"y' if i == 25 else 'z",1' if i == 26 else "p,q") for i in range(1, 101)] + [
        ("b", i, f'{i},"c"') for i in range(1, 101)], "file_path string, line long, value string")
    got = records.records(records.classified(lines)).collect()
    assert len(got) == 199 and [r["value"] for r in got if "\n" in r["value"]] == ['x,"y\nz",1']
    assert {(r["file_path"], r["line"]) for r in seen["record-marked"].collect()} == {("a", i) for i in range(21, 31)}


def test_control_totals_read_their_rows_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def kind(n):
        read.add(1)
        return "SF" if n == 7 else "SB"

    rows = spark.range(1, 11).select(F.lit("f").alias("file_path"), F.col("id").alias("line"), F.lit("6").alias("Count"), kind.asNondeterministic()("id").alias("CH"))
    files = spark.createDataFrame([("f",), ("g",)], "file_path string")
    got = {r["file_path"]: (r["found"], r["expected"], r["ok"]) for r in R.control_total_check(rows, "Count", files=files).collect()}
    assert got == {"f": (6, 6, True), "g": (0, 0, True)}
    assert read.value == 10
