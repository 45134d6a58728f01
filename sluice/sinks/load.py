"""The whole landing load: history of loaded files, slice check, landing, ids that go on, and the write, in one call."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists
from ..sources.files import file_predicate, ledger_entries, load_once, object_inventory
from ..sources.landing import variant_landing
from . import snapshots
from .guard import ATTEMPTS, guarded_slice_load, slice_exists, version_of
from .snapshots import Conflict

LEDGER_DDL = "table string, path string, loaded_at timestamp, target string, load string"


def read_ledger(spark: SparkSession, ledger_path: str, table: str) -> DataFrame | None:
    """Files that earlier loads of ``table`` have read: ``(table, path, loaded_at)``; None if there is no history at all.

    An entry counts if the target's current version names its load, so rows and history change in the same step."""
    if not path_exists(spark, ledger_path):
        return None
    entries = spark.read.schema(LEDGER_DDL).parquet(ledger_path).where(F.col("table") == table)
    committed = []
    for (target,) in entries.select("target").distinct().collect():  # the folders that a table has been loaded into
        snapshot = snapshots.current(spark, target)
        committed += [(target, load) for load in (snapshot.history if snapshot else ())]
    return entries.join(spark.createDataFrame(committed, "target string, load string"), ["target", "load"], "left_semi").select("table", "path", "loaded_at")


def landed_load(spark: SparkSession, source: str, target: str, ledger_path: str, table: str, pred: Column | None = None,
                file: str | None = None, pattern: str | None = None, overwrite: bool = False, truncate: bool = False,
                check: bool = True, partition_col: str | None = None, **landing) -> DataFrame:
    """Land the JSON files below ``source`` that no earlier load of ``table`` has read, under the slice protocol.

    * a slice that is there (``pred``) and no ``overwrite``: skipped, nothing is read, the history stays;
    * ``overwrite`` also reads files that are in the history (the source's FORCE), and replaces the slice alone;
    * ``truncate`` empties target and history first;
    * ids go on above the target's largest.

    The entries of the history are written first and count from the moment that the rows do, as one pointer names both:
    a load that is lost anywhere before leaves neither, and one lost after has both. If another load of the target comes
    first, this one starts again from what that one left. Returns ``(action, rows)`` with action nothing_new if no file is
    left to read.
    """
    for _ in range(ATTEMPTS):
        try:
            return _landed(spark, source, target, ledger_path, table, pred, file, pattern, overwrite, truncate, check, partition_col, landing)
        except Conflict:
            continue
    raise Conflict(f"{target}: {ATTEMPTS} times another load published first")


def _landed(spark, source, target, ledger_path, table, pred, file, pattern, overwrite, truncate, check, partition_col, landing) -> DataFrame:
    base = snapshots.current(spark, target)
    existing = None if base is None else snapshots.read(spark, target, base)
    guarded = check and pred is not None and existing is not None and not truncate
    if guarded and not overwrite and slice_exists(existing, pred):
        return spark.createDataFrame([("skipped", 0)], "action string, rows bigint")
    files = object_inventory(spark, source).select("path")
    if file or pattern:
        files = files.where(file_predicate(file, pattern, "path"))
    ledger = None if truncate else read_ledger(spark, ledger_path, table)
    # names of the files to read, which the scan needs
    paths = [r["path"] for r in load_once(files, ledger, force=overwrite).collect()]
    if not paths:
        return spark.createDataFrame([("nothing_new", 0)], "action string, rows bigint")
    last = 0 if existing is None or truncate else existing.agg(F.max("id")).first()[0] or 0
    rows = variant_landing(spark, paths, id_offset=last, **landing)
    load = uuid.uuid4().hex
    entries = ledger_entries(spark.createDataFrame([(p,) for p in paths], "origin_file_name string"), table)
    if ledger is not None:
        entries = entries.join(ledger.select("path"), "path", "left_anti")
    entries.select("table", "path", F.current_timestamp().alias("loaded_at"), F.lit(target).alias("target"), F.lit(load).alias("load")) \
        .write.mode("append").parquet(ledger_path)
    return guarded_slice_load(spark, target, rows, pred, overwrite=overwrite, truncate=truncate, check=check, partition_col=partition_col,
                              history=(load,), made_from=version_of(base))
