"""Exports: delimited files (enclosed or escaped), manifests, gzip NDJSON shards."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path, list_files, path_exists, scratch_path

# Fixed value: target size of one exported file (bytes)
EXPORT_MAX_FILE_BYTES = 104_857_600
MANIFEST_NAME = "manifest.json"


def export_dir(base: str, qualified_table: str) -> str:
    """``<base>/<db>-<schema>-<table>/`` lower-cased."""
    return base.rstrip("/") + "/" + qualified_table.replace(".", "-").lower()


def _none(v):
    return None if v is None or v == "NONE" else v


def _text_cols(df: DataFrame, binary_format: str | None) -> list:
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.BinaryType):
            fmt = (binary_format or "HEX").upper()
            c = F.base64(c) if fmt == "BASE64" else (F.decode(c, "UTF-8") if fmt == "UTF8" else F.hex(c))
        elif isinstance(f.dataType, T.BooleanType):
            c = F.when(c, "true").when(~c, "false")
        elif not isinstance(f.dataType, T.StringType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return out


def escaped_lines(df: DataFrame, sep: str = ",", escape: str | None = "\\", null_marker: str = "\\N",
                  binary_format: str | None = None) -> DataFrame:
    """One text line per row, fields not enclosed: escape char, separator and line breaks escaped."""
    cols = []
    for c in _text_cols(df, binary_format):
        v = c
        if escape:
            v = F.replace(v, F.lit(escape), F.lit(escape + escape))
            v = F.replace(v, F.lit(sep), F.lit(escape + sep))
            v = F.replace(F.replace(v, F.lit("\n"), F.lit(escape + "n")), F.lit("\r"), F.lit(escape + "r"))
        cols.append(F.coalesce(v, F.lit(null_marker)))
    return df.select(F.concat_ws(sep, *cols).alias("value"))


def enclosed_lines(df: DataFrame, sep: str, quote: str, null_marker: str = "\\N", binary_format: str | None = None) -> DataFrame:
    """One record per row: text fields in quotes, a quote inside doubled; other fields and the null marker bare, so that a text
    that reads like the marker is told from NULL."""
    q = F.lit(quote)
    cols = []
    for f, c in zip(df.schema.fields, _text_cols(df, binary_format), strict=True):
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            c = F.concat(q, F.replace(c, q, F.lit(quote * 2)), q)
        cols.append(F.coalesce(c, F.lit(null_marker)))
    return df.select(F.concat_ws(sep, *cols).alias("value"))


def packed(lines: DataFrame, max_bytes: int) -> DataFrame:
    """``lines(value)`` as texts of several lines, each as many lines as fit into ``max_bytes`` with their line breaks; a longer
    line stands alone. A task packs its rows as they come, in one pass and without a shuffle; it holds one text at a time, so
    its memory goes with ``max_bytes``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def text() -> pa.RecordBatch:
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, sum(map(len, held))], pa.int32()), pa.concat_arrays(held)), "\n")
            return pa.record_batch([joined], names=["value"])

        for batch in batches:
            column = batch.column(0)
            ends = np.cumsum(pc.add(pc.binary_length(column), 1).to_numpy(zero_copy_only=False))
            at = 0
            while at < len(column):
                base = int(ends[at - 1]) if at else 0
                upto = max(at, int(np.searchsorted(ends, base + max_bytes - size, side="right")))
                if upto == at and held:
                    yield text()
                    held, size = [], 0
                    continue
                upto = max(upto, at + 1) if not held else upto
                held.append(column.slice(at, upto - at))
                size += int(ends[upto - 1]) - base
                at = upto
        if held:
            yield text()

    return lines.mapInArrow(run, "value string")


def delimited_export(df: DataFrame, path: str, sep: str = ",", enclosed_by: str | None = None,
                     escape: str | None = None, null_marker: str | None = None,
                     binary_format: str | None = None, overwrite: bool = True, single: bool = False,
                     max_file_bytes: int = EXPORT_MAX_FILE_BYTES) -> DataFrame:
    """Table -> delimited text files under ``path`` (no compression; empty string is not null).

    ``enclosed_by``: None / "NONE" -> fields never enclosed (escaped instead), else the quote
    character of text fields. ``escape`` of files without a quote: unset -> backslash, "NONE" -> never.
    ``overwrite=False`` with files present fails; ``overwrite=True`` clears the
    prefix first (same order as the reference: delete, then write). Files are filled up to
    ``max_file_bytes`` (a longer row has a file of its own, a task's last file may be smaller);
    ``single`` writes one file, whatever its size.
    Returns ``(action, rows)``.
    """
    spark = df.sparkSession
    enclosed, esc = _none(enclosed_by), _none("\\" if escape is None else escape)
    marker = "\\N" if null_marker is None else null_marker
    if not overwrite and path_exists(spark, path):
        raise FileExistsError(f"Files already exist at {path}. Use overwrite option to force unloading.")
    out = df.coalesce(1) if single else df
    lines = enclosed_lines(out, sep, enclosed, marker, binary_format) if enclosed else escaped_lines(out, sep, esc, marker, binary_format)
    obs = Observation(f"export_{uuid.uuid4().hex[:8]}")
    lines = lines.observe(obs, F.count(F.lit(1)).alias("n"))
    (lines if single else packed(lines, max_file_bytes)).write.mode("overwrite" if overwrite else "errorifexists") \
        .option("maxRecordsPerFile", 0 if single else 1).option("compression", "none").text(path)
    return spark.createDataFrame([("exported", int(obs.get.get("n", 0)))], "action string, rows bigint")


def manifest_write(spark: SparkSession, path: str, name: str = MANIFEST_NAME) -> DataFrame:
    """Write ``<path>/manifest.json``, one file with one JSON object that lists every data file of the export, all mandatory.

    The entries come from a distributed listing and are written one a line by one task, then the file is renamed into
    place; no list of them is held anywhere. Returns ``(url, mandatory)``.
    """
    from ..sources.delimited import manifest_entries
    from ..sources.files import object_inventory
    from .guard import _rename

    base = path.rstrip("/")
    files = object_inventory(spark, base).where(~F.col("path").endswith("/" + name)).select(F.col("path").alias("url"))
    entry = F.to_json(F.struct("url", F.lit(True).alias("mandatory")))
    first = F.lag("url").over(Window.orderBy("url")).isNull()  # one row a file
    lines = files.select(F.lit(1).alias("_part"), "url", F.concat(F.when(first, " ").otherwise(","), entry).alias("value"))
    ends = spark.range(1).select(F.explode(F.array(
        F.struct(F.lit(0).alias("_part"), F.lit("").alias("url"), F.lit('{"entries": [').alias("value")),
        F.struct(F.lit(2).alias("_part"), F.lit("").alias("url"), F.lit("]}").alias("value")))).alias("e")).select("e.*")
    staging = scratch_path(spark, "manifest")
    lines.unionByName(ends).coalesce(1).sortWithinPartitions("_part", "url").select("value").write.text(staging)
    delete_path(spark, f"{base}/{name}")  # also a folder of that name
    _rename(spark, list_files(spark, staging)[0], f"{base}/{name}")
    return manifest_entries(spark, f"{base}/{name}")


def ndjson_gzip_export(df: DataFrame, root: str, dataset: str, date: str | None = None,
                       date_col: str | None = None) -> DataFrame:
    """Dates of a table -> gzip NDJSON shards under ``<root>/dataset=<d>/date=<date>/``.

    ``date`` exports one date; ``date_col`` exports every date of the column.
    Dynamic partition overwrite replaces only the dates written.
    """
    obs = Observation(f"ndjson_{uuid.uuid4().hex[:8]}")
    dcol = F.lit(date) if date is not None else F.col(date_col).cast("string")
    (df.withColumn("dataset", F.lit(dataset)).withColumn("date", dcol)
       .observe(obs, F.count(F.lit(1)).alias("n"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("compression", "gzip").partitionBy("dataset", "date").json(root))
    return df.sparkSession.createDataFrame([("exported", int(obs.get.get("n", 0)))], "action string, rows bigint")
