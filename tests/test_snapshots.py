"""Slice loads under snapshots: readers between any two steps, lost drivers at any step, and loads that race."""

import os

import pytest
from pyspark.sql import functions as F

from sluice.sinks import guard, snapshots
from sluice.sinks import load as L

DDL = "day string, view string, v int"
OLD = [("d1", "v1", 1), ("d1", "v2", 2), ("d2", "v1", 3)]
NEW = [("d1", "v1", 10), ("d2", "v1", 11), ("d4", "v1", 12)]
AFTER = sorted([("d1", "v2", 2), *NEW])


def rows(spark, path):
    return sorted((str(r["day"]), r["view"], r["v"]) for r in guard.read_target(spark, path).select("day", "view", "v").collect())


def files(path):
    return sorted(os.path.join(d, n) for d, _, names in os.walk(path) for n in names)


STEPS = [(snapshots, "stage"), (snapshots, "commit"), (snapshots, "_published"), (snapshots, "read"), (snapshots, "current"), (snapshots, "children")]


def each_step(monkeypatch, before):
    """Calls ``before(n)`` ahead of the n-th call of any step of a load."""
    n = [0]
    for module, name in STEPS:
        real = getattr(module, name)

        def step(*args, real=real, **kwargs):
            n[0] += 1
            before(n[0])
            return real(*args, **kwargs)

        monkeypatch.setattr(module, name, step)
    return n


@pytest.mark.parametrize("partition_col", ["day", None])
@pytest.mark.parametrize("plain", [True, False])
def test_a_lost_driver_leaves_the_table_whole_at_every_step(spark, tmp, monkeypatch, partition_col, plain):
    done, n = False, 0
    while not done and n < 60:
        n += 1
        path = f"{tmp}/{n}"
        old = spark.createDataFrame(OLD, DDL)
        if plain:
            (old.write.partitionBy("day") if partition_col else old.write).parquet(path)
        else:
            guard.guarded_slice_load(spark, path, old, None, partition_col=partition_col)

        def lost(k, n=n):
            if k >= n:
                raise OSError("lost")

        with monkeypatch.context() as m:
            each_step(m, lost)
            try:
                guard.guarded_slice_load(spark, path, spark.createDataFrame(NEW, DDL), F.col("view") == "v1", overwrite=True, partition_col=partition_col)
                done = True
            except OSError:
                pass
        assert rows(spark, path) == (AFTER if done else sorted(OLD))
    assert done and n > 5
    left = len(snapshots.vacuum(spark, f"{tmp}/{n - 1}", older_than_s=-10))
    assert rows(spark, f"{tmp}/{n - 1}") == sorted(OLD) and left >= (1 if n > 6 else 0)


@pytest.mark.parametrize("partition_col", ["day", None])
def test_a_reader_between_any_two_steps_sees_one_version_and_writes_nothing(spark, tmp, monkeypatch, partition_col):
    path = tmp + "/t"
    guard.guarded_slice_load(spark, path, spark.createDataFrame(OLD, DDL), None, partition_col=partition_col)
    seen, busy = [], []

    def reading(k):
        if not busy:  # the reader's own steps
            busy.append(k)
            before = files(path)
            seen.append(rows(spark, path))
            assert files(path) == before
            busy.clear()

    frame = guard.read_target(spark, path)  # opened before the load, read after it
    with monkeypatch.context() as m:
        each_step(m, reading)
        guard.guarded_slice_load(spark, path, spark.createDataFrame(NEW, DDL), F.col("view") == "v1", overwrite=True, partition_col=partition_col)
    assert rows(spark, path) == AFTER
    assert all(s in (sorted(OLD), AFTER) for s in seen) and sorted(OLD) in seen
    assert sorted((str(r["day"]), r["view"], r["v"]) for r in frame.collect()) == sorted(OLD)


def test_of_two_loads_one_publishes_and_the_other_starts_again(spark, tmp, monkeypatch):
    path = tmp + "/t"
    guard.guarded_slice_load(spark, path, spark.createDataFrame(OLD, DDL), None, partition_col="day")
    real, raced = snapshots.commit, []

    def commit(*args):
        if not raced:  # another load of the same slice comes first
            raced.append(1)
            guard.guarded_slice_load(spark, path, spark.createDataFrame([("d9", "v1", 90)], DDL), F.col("view") == "v1", overwrite=True, partition_col="day")
        return real(*args)

    monkeypatch.setattr(snapshots, "commit", commit)
    status = guard.guarded_slice_load(spark, path, spark.createDataFrame(NEW, DDL), F.col("view") == "v1", overwrite=True, partition_col="day").first()
    assert (status["action"], status["rows"]) == ("replaced", 3) and rows(spark, path) == AFTER  # the other load's slice was replaced in turn
    raced.clear()
    status = guard.guarded_slice_load(spark, path, spark.createDataFrame([("d8", "v8", 80)], DDL), F.col("view") == "v8", partition_col="day").first()
    assert status["action"] == "appended" and ("d8", "v8", 80) in rows(spark, path) and ("d9", "v1", 90) in rows(spark, path)
    assert snapshots.current(spark, path).version == 5


def test_a_skipped_load_writes_nothing(spark, tmp):
    path = tmp + "/t"
    guard.guarded_slice_load(spark, path, spark.createDataFrame(OLD, DDL), None)
    before = files(path)
    assert guard.guarded_slice_load(spark, path, spark.createDataFrame(NEW, DDL), F.col("view") == "v1").first()["action"] == "skipped"
    assert files(path) == before


def test_columns_that_come_and_go(spark, tmp):
    path = tmp + "/t"
    guard.guarded_slice_load(spark, path, spark.createDataFrame(OLD, DDL), None, partition_col="day")
    more = spark.createDataFrame([("d1", 5, "x")], "day string, v long, extra string")
    guard.guarded_slice_load(spark, path, more, None, partition_col="day")
    got = sorted((r["day"], r["view"], r["v"], r["extra"]) for r in guard.read_target(spark, path).collect() if r["day"] == "d1" and r["v"] == 5)
    assert got == [("d1", None, 5, "x")] and guard.read_target(spark, path).count() == 4


def test_vacuum_keeps_what_current_versions_name(spark, tmp):
    path = tmp + "/t"
    for i in range(3):
        guard.guarded_slice_load(spark, path, spark.createDataFrame([("d1", "v1", i)], DDL), F.col("view") == "v1", overwrite=True, partition_col="day")
    assert snapshots.vacuum(spark, path, older_than_s=3600) == ["v000000000001.json", "v000000000002.json"]
    assert len(snapshots.vacuum(spark, path, older_than_s=-10)) >= 2
    assert rows(spark, path) == [("d1", "v1", 2)]


def _land(spark, src, target, ledger, **options):
    return L.landed_load(spark, src, target, ledger, "tab", date_property="d", partition_col="slice_date", **options).first()["action"]


def test_history_and_rows_are_one_at_every_step(spark, tmp, monkeypatch):
    src = tmp + "/in"
    os.makedirs(src)
    for name, n in (("a", 1), ("b", 2)):
        with open(f"{src}/{name}.json", "w") as f:
            f.write(f'{{"d":"2020-01-0{n}","k":{n}}}\n')
    done, n = False, 0
    while not done and n < 40:
        n += 1
        target, ledger = f"{tmp}/t{n}", f"{tmp}/l{n}"

        def lost(k, n=n):
            if k >= n:
                raise OSError("lost")

        with monkeypatch.context() as m:
            each_step(m, lost)
            try:
                _land(spark, src, target, ledger)
                done = True
            except OSError:
                pass
        again = _land(spark, src, target, ledger)  # the rerun after the loss
        assert again == ("nothing_new" if done else "appended")
        assert guard.read_target(spark, target).count() == 2
        assert L.read_ledger(spark, ledger, "tab").count() == 2
    assert done and n > 4


def test_two_landing_loads_at_once_load_each_file_once(spark, tmp, monkeypatch):
    src, target, ledger = tmp + "/in", tmp + "/t", tmp + "/l"
    os.makedirs(src)
    with open(f"{src}/a.json", "w") as f:
        f.write('{"d":"2020-01-01","k":1}\n')
    real, raced = snapshots.commit, []

    def commit(*args):
        if not raced:
            raced.append(1)
            assert _land(spark, src, target, ledger) == "appended"
        return real(*args)

    monkeypatch.setattr(snapshots, "commit", commit)
    assert _land(spark, src, target, ledger) == "nothing_new"
    assert guard.read_target(spark, target).count() == 1 and L.read_ledger(spark, ledger, "tab").count() == 1


def test_swap_finishes_what_a_lost_driver_began(spark, tmp):
    base = spark.createDataFrame([(1, "a")], "id int, k string")
    guard.swap_overwrite(spark, base, "swap_lost", tmp + "/tables")
    spark.sql("ALTER TABLE swap_lost RENAME TO swap_lost_old")  # the driver was lost here
    bad = base.withColumn("k", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        guard.swap_overwrite(spark, bad, "swap_lost", tmp + "/tables")
    assert [tuple(r) for r in spark.table("swap_lost").collect()] == [(1, "a")]
    guard.swap_overwrite(spark, base.withColumn("k", F.lit("b")), "swap_lost", tmp + "/tables")
    assert [tuple(r) for r in spark.table("swap_lost").collect()] == [(1, "b")]


def test_an_absent_slice_is_told_by_the_index_alone(spark, tmp, monkeypatch):
    path = tmp + "/t"
    day = lambda d: F.col("day") == d
    for n in range(4):  # four loads of many days each, one file a load
        some = spark.createDataFrame([(f"d{n}{i:02d}", "v", i) for i in range(0, 60, 2)] * 3, DDL).coalesce(1)
        guard.guarded_slice_load(spark, path, some, day(f"d{n}00"), key=("day", f"d{n}00"))
    snapshot = snapshots.current(spark, path)
    for n in range(4):
        for i in range(0, 60, 2):
            assert len(snapshots.candidate_files(spark, path, snapshot, "day", f"d{n}{i:02d}")) == 1 if i in (0, 20, 58) else True
    scanned = []
    real = guard.slice_exists
    monkeypatch.setattr(guard, "slice_exists", lambda df, pred: (scanned.append(df.inputFiles()), real(df, pred))[1])
    absent = [d for d in ("d001", "d133", "c", "e", "d259") if not guard.slice_present(spark, path, "day", d)]
    assert absent == ["d001", "d133", "c", "e", "d259"] and scanned == []
    assert guard.slice_present(spark, path, "day", "d320") and len(scanned) == 1 and len(scanned[0]) == 1
    new = spark.createDataFrame([("d320", "v", 100)], DDL)
    assert guard.guarded_slice_load(spark, path, new, day("d320"), key=("day", "d320")).first()["action"] == "skipped"
    assert guard.guarded_slice_load(spark, path, new, day("d320"), overwrite=True, key=("day", "d320")).first()["action"] == "replaced"
    assert guard.slice_present(spark, path, "day", "d320") and not guard.slice_present(spark, path, "day", "d321")
    assert guard.read_target(spark, path).where(day("d320")).count() == 1 and guard.read_target(spark, path).count() == 4 * 90 - 3 + 1
    guard.guarded_slice_load(spark, path, new, None)  # a load without the key: the index no longer tells all
    assert snapshots.candidate_files(spark, path, snapshots.current(spark, path), "day", "x") is None
    assert not guard.slice_present(spark, path, "day", "x")
    guard.guarded_slice_load(spark, path, new, None, truncate=True, key=("day", "d320"))
    assert snapshots.candidate_files(spark, path, snapshots.current(spark, path), "day", "d000") == []
