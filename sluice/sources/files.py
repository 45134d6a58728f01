"""File-level sources: numbered lines, file selection, inventories and the load ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.sizing import materialised
from ..session import listing



def file_predicate(file: str | None = None, pattern: str | None = None,
                   path_col: str = "_metadata.file_path") -> Column:
    """Restrict a scan by an exact relative file name and/or a whole-path regex.

    At least one of ``file`` / ``pattern`` is required (both may be combined).
    ``pattern`` must match the whole path (anchored), ``file`` matches the end
    of the path at a folder boundary.
    """
    if not file and not pattern:
        raise ValueError("Either `file` or `pattern` must be specified")
    cond = F.lit(True)
    path = F.col(path_col)
    if file:
        rel = file.lstrip("/")
        cond = cond & (path.endswith("/" + rel) | (path == F.lit(rel)))
    if pattern:
        cond = cond & path.rlike("^(?:" + pattern + ")$")
    return cond


def file_select(df: DataFrame, file: str | None = None, pattern: str | None = None,
                path_col: str = "origin_file_name") -> DataFrame:
    """Filter an already numbered / landed frame by its file-name column."""
    return df.where(file_predicate(file, pattern, path_col))


def read_text(spark: SparkSession, path: str | list[str], recursive: bool = False,
              base_path: str | None = None, wholetext: bool = False) -> DataFrame:
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if base_path:
        reader = reader.option("basePath", base_path)
    paths = [path] if isinstance(path, str) else list(path)
    with listing(spark):
        return reader.text(paths, wholetext=wholetext)


def selected_files(spark: SparkSession, path: str, file: str | None = None,
                   pattern: str | None = None) -> list[str]:
    """Files under ``path`` matching ``file`` / ``pattern``: the regex runs over the distributed
    listing; only the matching names (one row per file) come back to hand them to the scan."""
    inv = object_inventory(spark, path)
    return [r["path"] for r in inv.where(file_predicate(file, pattern, "path")).select("path").collect()]


def selected_text(spark: SparkSession, path: str | list[str], file: str | None = None, pattern: str | None = None,
                  recursive: bool = False, where: Column | None = None, wholetext: bool = False) -> DataFrame:
    """The text of the selected files; ``where`` is a condition on partition columns and prunes folders."""
    if file or pattern:
        # resolve the selection on the listing, so unselected files are never opened
        if not isinstance(path, str):
            raise ValueError("file / pattern selection needs one root path")
        paths = selected_files(spark, path, file, pattern)
        raw = read_text(spark, paths, base_path=None if recursive else path, wholetext=wholetext) if paths else \
            read_text(spark, path, recursive, wholetext=wholetext).where(F.lit(False))
    else:
        raw = read_text(spark, path, recursive, wholetext=wholetext)
    return raw if where is None else raw.where(where)


def numbered_lines(spark: SparkSession, path: str | list[str], file: str | None = None,
                   pattern: str | None = None, recursive: bool = False,
                   keep: list[str] | None = None, skip_blank: bool = False,
                   line_filter: Column | None = None, where: Column | None = None) -> DataFrame:
    """Every line of every file with its 1-based line number inside its own file.

    Files are read split by split in parallel; no file is funnelled through a
    single task. Each row remembers its split (``_metadata.file_block_start``)
    and its position inside the split (``monotonically_increasing_id`` is
    contiguous within a task). A per-split table (one row per split) gives the
    number of lines in earlier splits of the same file; joining it back turns
    the in-split position into the file line number.

    With ``skip_blank`` blank lines (and with ``line_filter`` the lines it
    rejects) are dropped before numbering, so ``line`` is the record number.

    ``where`` (on partition columns) is applied before numbering, so it reaches the scan.
    Returns ``file_path, line, value`` (+ ``keep`` columns such as partition columns).
    """
    keep = list(keep or [])
    raw = selected_text(spark, path, file, pattern, recursive, where)
    if skip_blank:
        # before the position id: positions stay contiguous among the kept lines of a split
        raw = raw.where(~F.col("value").rlike(r"^\s*$"))
    if line_filter is not None:
        raw = raw.where(line_filter)
    tagged = raw.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.xxhash64(F.col("_metadata.file_path")).alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_pos"),
        "value",
        *keep,
    )
    # one row per split, keyed by a 64-bit hash of the path (compact to broadcast)
    blocks = tagged.groupBy("_file", "_block").agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "_file", "_block", "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    # computed once; Spark broadcasts it below the byte threshold
    blocks = materialised(blocks, "blocks")
    out = tagged.join(blocks, ["_file", "_block"])
    return out.select(
        "file_path",
        (F.col("_pos") - F.col("_first") + F.col("_before") + 1).alias("line"),
        "value",
        *keep,
    )


def object_inventory(spark: SparkSession, path: str) -> DataFrame:
    """All objects below a prefix: ``path, length, modified`` (content is never read)."""
    with listing(spark):
        objects = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return objects.select("path", "length", F.col("modificationTime").alias("modified"))


def load_once(files: DataFrame, ledger: DataFrame | None, force: bool = False,
              key: str | list[str] = "path") -> DataFrame:
    """Files not yet recorded in the ledger (``force`` reloads everything).

    ``files`` and ``ledger`` are file lists (one row per file); the anti join
    is keyed on the file path, so re-running a load picks up only new files.
    ``key=["path", "modified"]`` also reloads a file whose content changed.
    """
    if force or ledger is None:
        return files
    keys = [key] if isinstance(key, str) else list(key)
    return files.join(ledger.select(*keys).distinct(), keys, "left_anti")


def ledger_entries(loaded: DataFrame, table: str, path_col: str = "origin_file_name") -> DataFrame:
    """Ledger rows ``(table, path)`` for the files a load just wrote."""
    return loaded.select(F.lit(table).alias("table"), F.col(path_col).alias("path")).distinct()
