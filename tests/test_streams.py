"""Streams that carry state: marks per key and unfinished batches, also over lost runs."""

import pytest
from pyspark.sql import functions as F

from sluice.streaming import incremental as I

DDL = "k string, t int, v int"


def arrive(spark, src, rows):
    spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(src)


def delivered(spark, sink):
    return sorted((r["k"] or "", r["t"], r["v"]) for r in spark.read.parquet(sink).collect())


FIRST = [("a", 1, 1), ("a", 2, 2), ("b", 9, 3), (None, 4, 4)]
SECOND = [("a", 1, 1), ("a", 2, 2), ("a", 3, 5), ("b", 8, 6), ("b", 10, 7), (None, 4, 4), (None, 5, 8), ("c", 0, 9)]


@pytest.mark.parametrize("lost_in", [None, 0, 1])
def test_old_rows_in_a_new_file_are_not_delivered_again(spark, tmp, monkeypatch, lost_in):
    src, sink, ckpt = tmp + "/src", tmp + "/sink", tmp + "/ckpt"
    run = lambda: I.high_water_stream(spark, src, sink, ckpt, "t", DDL, key=["k"])
    real = I.State.after

    def after(self, batch_id, *args):
        real(self, batch_id, *args)  # the state is saved, then the run is lost before the checkpoint knows of it
        raise OSError("lost")

    for n, rows in enumerate((FIRST, SECOND)):
        arrive(spark, src, rows)
        if lost_in == n:
            with monkeypatch.context() as m:
                m.setattr(I.State, "after", after)
                with pytest.raises(Exception, match="lost"):
                    run()
        run()
    assert delivered(spark, sink) == sorted([("a", 1, 1), ("a", 2, 2), ("b", 9, 3), ("", 4, 4), ("a", 3, 5), ("b", 10, 7), ("", 5, 8), ("c", 0, 9)])
    assert run() == 0


def test_one_mark_for_all_rows(spark, tmp):
    src, sink, ckpt = tmp + "/src", tmp + "/sink", tmp + "/ckpt"
    for rows in (FIRST, SECOND):
        arrive(spark, src, rows)
        I.high_water_stream(spark, src, sink, ckpt, "t", DDL, mark=1)
    assert delivered(spark, sink) == sorted([("a", 2, 2), ("b", 9, 3), ("", 4, 4), ("b", 10, 7)])


@pytest.mark.parametrize("lost", [None, "state", "last"])
def test_only_the_last_batch_is_short(spark, tmp, monkeypatch, lost):
    src, sink, ckpt = tmp + "/src", tmp + "/sink", tmp + "/ckpt"
    run = lambda finish: I.batch_pack_stream(spark, src, sink, ckpt, 4, ["v"], DDL, finish=finish, max_files_per_trigger=1)
    rows = [("x", i, i) for i in range(23)]
    for part in (rows[:3], rows[3:9], rows[9:10]):
        arrive(spark, src, part)
    real, failed = I.State.after, []

    def after(self, batch_id, *args):
        if lost == "state":
            real(self, batch_id, *args)
        if not failed:
            failed.append(1)
            raise OSError("lost")
        if lost != "state":
            real(self, batch_id, *args)

    if lost == "state":
        with monkeypatch.context() as m:
            m.setattr(I.State, "after", after)
            with pytest.raises(Exception, match="lost"):
                run(False)
    run(False)
    for part in (rows[10:22], rows[22:]):
        arrive(spark, src, part)
    run(False)
    if lost == "last":  # the short batch is written, then the run is lost
        with monkeypatch.context() as m:
            m.setattr(I.State, "after", after)
            with pytest.raises(OSError):
                run(True)
    run(True)
    sent = spark.read.parquet(sink).orderBy("batch").collect()
    assert [r["batch"] for r in sent] == list(range(6)) and [r["n"] for r in sent] == [4] * 5 + [3]
    assert sorted(x["v"] for r in sent for x in r["rows"]) == list(range(23))
    arrive(spark, src, [("y", 0, 100)])
    run(True)
    assert sorted(r["n"] for r in spark.read.parquet(sink).collect()) == [1, 3, 4, 4, 4, 4, 4]


def test_equal_tables_compare_without_a_row_shuffle(spark, monkeypatch):
    from sluice.operators import records as R

    a = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id")).alias("x"), F.lit(None).cast("string").alias("s"))
    same = R.record_diff(a, a.orderBy(F.desc("id")))
    assert same.collect() == [] and same.columns == ["id", "x", "s", "side"]
    assert "Exchange" not in same._jdf.queryExecution().executedPlan().toString()
    seen = []
    real = R.differing_nodes
    monkeypatch.setattr(R, "differing_nodes", lambda *args: (seen.append(real(*args)), seen[-1])[1])
    b = a.where("id <> 5").withColumn("x", F.when(F.col("id") == 7, 1).otherwise(F.col("x"))).unionByName(a.where("id = 9"))
    got = sorted((r["id"], r["x"], r["side"]) for r in R.record_diff(a, b).collect())
    assert got == [(5, 5, "left"), (7, 1, "right"), (7, 7, "left"), (9, None, "right")]
    assert [n.count() for n in seen] == [4, 4]  # of 4,096 and 16 million nodes


def test_nulls_in_other_places_differ(spark):
    from sluice.operators import records as R

    a = spark.createDataFrame([(None, 1), (2, 2), (2, 2)], "x int, y int")
    b = spark.createDataFrame([(1, None), (2, 2)], "x int, y int")
    got = sorted((str(r["x"]), str(r["y"]), r["side"]) for r in R.record_diff(a, b).collect())
    assert got == [("1", "None", "right"), ("2", "2", "left"), ("None", "1", "left")]
