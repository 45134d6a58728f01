"""The guarded slice-load protocol and its variants (truncate, append, swap, rollback).

Targets are folders under snapshots (``sinks/snapshots.py``): a slice is described by a predicate and a load deletes the
rows that match it, no others. The new rows, and the rows of the touched partitions (or of the whole table, if it has none) that
stay, are written to a folder of their own; publishing the next version is the only step that readers see. A load that finds
its version taken by another one starts again from that one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path
from ..sources.scan import raw_condition
from . import snapshots
from .snapshots import Conflict, Snapshot

#: Times that a load starts again after another one took its version.
ATTEMPTS = 20
STATUS_DDL = "action string, rows bigint"


def _status(spark: SparkSession, action: str, rows: int) -> DataFrame:
    return spark.createDataFrame([(action, int(rows))], STATUS_DDL)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, s, jvm = _fs(spark, src)
    if not fs.rename(s, jvm.org.apache.hadoop.fs.Path(dst)):
        raise OSError(f"rename failed: {src} -> {dst}")


def slice_session(date: str, view: str, session_col: str = "session", view_col: str = "ga_view_id", key: str = "date") -> Column:
    """``session:date = '<date>' AND ga_view_id = '<view>'`` (string equality, no date cast; ``key`` names the date)."""
    return (F.try_variant_get(F.col(session_col), f"$.{key}", "string") == F.lit(date)) & \
        (F.col(view_col) == F.lit(view))


def slice_date(prop: str, date: str, properties_col: str = "properties") -> Column:
    """``date(properties:<prop>) = date('<date>')``: timestamps match their day."""
    return F.try_variant_get(F.col(properties_col), f"$.{prop}", "date") == F.to_date(F.lit(date))


def slice_raw(where: str | None) -> Column:
    """An arbitrary ``WHERE ...`` clause (the keyword is optional); empty means the whole table."""
    condition = raw_condition(where)
    return F.lit(True) if condition is None else condition


def slice_exists(df: DataFrame, pred: Column) -> bool:
    """``SELECT 1 ... LIMIT 1``: stops at the first matching row."""
    return not df.where(pred).limit(1).isEmpty()


def slice_exists_df(df: DataFrame, pred: Column, label: str = "slice") -> DataFrame:
    exists = slice_exists(df, pred)
    return df.sparkSession.createDataFrame([(label, exists)], "slice string, exists boolean")


def read_target(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The newest version of the table at ``path``, or None if there is none. Reads only."""
    snapshot = snapshots.current(spark, path, fmt)
    return None if snapshot is None else snapshots.read(spark, path, snapshot)


def _write(df: DataFrame, path: str, mode: str, fmt: str) -> int:
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("n")).write.format(fmt).mode(mode).save(path)
    return int(obs.get.get("n", 0))


class _New:
    """The rows of a load, written once, whatever the number of attempts to publish them."""

    def __init__(self, spark: SparkSession, path: str, rows: DataFrame, partition_col: str | None, fmt: str, key: str | None = None):
        self.spark, self.path, self.frame, self.partition_col, self.fmt, self.key = spark, path, rows, partition_col, fmt, key
        self.load, self.rows = None, 0

    def schema(self, base: Snapshot | None):
        return snapshots.merged(base.schema if base else None, self.frame.schema)

    def staged(self, base: Snapshot | None) -> str:
        if self.load is None:
            self.partition_col = self.partition_col or (base.partition_col if base else None)
            self.load, self.rows = snapshots.stage(
                self.spark, self.path, snapshots.conformed(self.frame, self.schema(base)), self.partition_col, self.fmt)
            self.index(self.load, self.schema(base))
        return self.load

    def index(self, load: str, schema) -> None:
        if self.key and not self.partition_col:  # partitions tell their slices by themselves
            snapshots.index_load(self.spark, self.path, load, schema, self.key, self.fmt)

    def indexed(self, *loads: str) -> dict[str, str]:
        return dict.fromkeys(loads, self.key) if self.key and not self.partition_col else {}


def version_of(snapshot: Snapshot | None) -> int:
    return snapshot.version if snapshot else 0


def _load(spark: SparkSession, path: str, fmt: str, step: Callable[[Snapshot | None], tuple[Snapshot | None, str]], made_from: int | None) -> str:
    """Publish what ``step`` makes of the newest version, again from the start if another load comes first. ``step`` returns the
    next version (None: nothing to publish) and the name of what it did. Rows that were made from a version (``made_from``) are of
    no use on another one."""
    for _ in range(ATTEMPTS):
        base = snapshots.current(spark, path, fmt)
        if made_from is not None and version_of(base) != made_from:
            raise Conflict(f"{path} is at version {version_of(base)}, the rows were made from version {made_from}")
        after, action = step(base)
        if after is None or snapshots.commit(spark, path, base, after):
            return action
    raise Conflict(f"{path}: {ATTEMPTS} times another load published first")


def stage_and_swap(spark: SparkSession, result: DataFrame | Callable[[DataFrame | None], DataFrame], path: str,
                   partition_col: str | None = None, fmt: str = "parquet", history: tuple[str, ...] = (),
                   made_from: int | None = None) -> int:
    """Replace the whole table by ``result``: a frame, or a function that makes one of the newest version (called anew if
    another load comes first)."""
    rows = 0
    fixed = result if isinstance(result, _New) else None if callable(result) else _New(spark, path, result, partition_col, fmt)

    def step(base):
        nonlocal rows
        made = fixed or _New(spark, path, result(None if base is None else snapshots.read(spark, path, base)), partition_col, fmt)
        load, rows = made.staged(None), made.rows
        return Snapshot(0, fmt, made.schema(None), partition_col, {load: frozenset()}, history, made.indexed(load)), "replaced"

    _load(spark, path, fmt, step, made_from)
    return rows


def _appended(base: Snapshot | None, new: _New, history: tuple[str, ...]) -> Snapshot:
    load = new.staged(base)
    if base is None:
        return Snapshot(0, new.fmt, new.schema(None), new.partition_col, {load: frozenset()}, history, new.indexed(load))
    return replace(base, schema=new.schema(base), partition_col=new.partition_col,
                   loads=base.loads | {load: frozenset()}, history=base.history + history, indexed=base.indexed | new.indexed(load))


def _replaced(spark: SparkSession, path: str, base: Snapshot, new: _New, pred: Column, history: tuple[str, ...]) -> Snapshot:
    """The version without the rows that match ``pred``, and with the new ones; rows outside the slice stay, also in
    partitions of the new rows."""
    schema, stays = new.schema(base), ~F.coalesce(pred, F.lit(False))
    load = new.staged(base)
    base = replace(base, partition_col=new.partition_col)
    # folders of partitions: as many as hold rows of one slice
    found = snapshots.read(spark, path, base, folder="__folder").where(pred).select("__folder").distinct().collect() if new.partition_col else []
    touched = snapshots.partition_names([r[0] for r in found])
    if new.partition_col and len(touched) == len(found):
        kept = snapshots.read(spark, path, base, only=touched).where(stays) if touched else None
        loads = snapshots.without(spark, path, base, touched)
    else:  # no partitions, or files outside them
        kept, loads = snapshots.read(spark, path, base).where(stays), {}
    if kept is not None:
        own, _ = snapshots.stage(spark, path, snapshots.conformed(kept, schema), new.partition_col, new.fmt)
        new.index(own, schema)
        loads = loads | {own: frozenset()}
    loads = loads | {load: frozenset()}
    indexed = {k: v for k, v in (base.indexed | new.indexed(*loads)).items() if k in loads} if kept is not None or new.key else base.indexed
    return replace(base, schema=schema, loads=loads, history=base.history + history, indexed=indexed)


def _present(spark: SparkSession, path: str, base: Snapshot, pred: Column, key: tuple[str, object] | None) -> bool:
    """Whether a version has rows of the slice: by its index if there is one for the key, else by a scan."""
    files = snapshots.candidate_files(spark, path, base, *key) if key and not base.partition_col else None
    if files is None:
        return slice_exists(snapshots.read(spark, path, base), pred)
    return bool(files) and slice_exists(snapshots.read_files(spark, base, files), pred)


def slice_present(spark: SparkSession, path: str, key: str, value, fmt: str = "parquet") -> bool:
    """Whether the table at ``path`` has rows whose ``key`` equals ``value``. A table that was loaded with that key is asked by its
    index first: an absent slice opens no data file."""
    base = snapshots.current(spark, path, fmt)
    return base is not None and _present(spark, path, base, F.col(key) == F.lit(value), (key, value))


def guarded_slice_load(spark: SparkSession, path: str, new: DataFrame, pred: Column | None,
                       overwrite: bool = False, truncate: bool = False, check: bool = True,
                       partition_col: str | None = None, fmt: str = "parquet", history: tuple[str, ...] = (),
                       made_from: int | None = None, key: tuple[str, object] | None = None) -> DataFrame:
    """Load ``new`` into the target at ``path`` under the slice protocol.

    * ``truncate``: the target is emptied first, so the load always proceeds.
    * ``check=False``: always append (with ``overwrite`` nothing is deleted).
    * slice present and not ``overwrite``: skip, nothing is written.
    * slice present and ``overwrite``: the rows of the slice, and no others, are replaced by ``new``.
    * slice absent (or no target): append.

    ``history``: ids that the version takes in with the rows. ``made_from``: the version that ``new`` was made from; if the
    target is at another one, Conflict is raised and nothing is loaded. ``key``: (column, value) where the slice is one value of a
    column; the files of an unpartitioned target are then indexed by that column, and whether the slice is there is asked of the
    index and the few files that it names. Returns ``(action, rows)`` with action in skipped | replaced |
    appended | truncated.
    """
    if truncate:
        made = _New(spark, path, new, partition_col, fmt, key[0] if key else None)
        return _status(spark, "truncated", stage_and_swap(spark, made, path, partition_col, fmt, history, made_from))
    rows = _New(spark, path, new, partition_col, fmt, key[0] if key else None)

    def step(base):
        if base is None or not check or pred is None or not _present(spark, path, base, pred, key):
            return _appended(base, rows, history), "appended"
        if not overwrite:
            return None, "skipped"
        return _replaced(spark, path, base, rows, pred, history), "replaced"

    action = _load(spark, path, fmt, step, made_from)
    return _status(spark, action, 0 if action == "skipped" else rows.rows)


def swap_overwrite(spark: SparkSession, df: DataFrame, table: str, location: str,
                   fmt: str = "parquet") -> DataFrame:
    """Load into ``<table>_temp``, rename ``table -> table_old``, ``table_temp -> table``, drop ``_old``.

    Tables are external (data at ``location``), so the renames are catalog
    metadata only; a schema change is allowed. The two renames are not one
    transaction: a reader may miss the table for an instant. If a driver was lost
    between them, the table stands under its old name and gets it back first.
    """
    tag = uuid.uuid4().hex[:10]
    temp, old = f"{table}_temp", f"{table}_old"
    if spark.catalog.tableExists(old) and not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {temp}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    data_path = f"{location.rstrip('/')}/{table}__{tag}"
    rows = _write(df, data_path, "errorifexists", fmt)
    spark.catalog.createTable(temp, path=data_path, source=fmt)
    old_path = None
    if spark.catalog.tableExists(table):
        old_path = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
        old_path = old_path["data_type"] if old_path else None
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {temp} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    if old_path and old_path != data_path:
        delete_path(spark, old_path)
    return _status(spark, "swapped", rows)
