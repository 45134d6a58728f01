"""Landing loads: JSON files -> one row per record with file, line, raw text and a VARIANT."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sizing import materialised
from .files import numbered_lines, selected_text

LANDING_DDL = ("id bigint, load_time timestamp, origin_file_name string, origin_file_line bigint, "
               "origin_str string, properties variant")


def strict_json(text) -> "F.Column":
    """VARIANT of a text holding exactly one JSON value, else NULL.

    ``try_parse_json`` accepts a valid prefix followed by junk; wrapping the
    text in ``[...]`` and requiring exactly one element rejects such lines.
    """
    t = F.col(text) if isinstance(text, str) else text
    arr = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), t, F.lit("]"))), "$", "array<variant>")
    # as the only element of an array, so that the text is parsed once
    return F.get(F.get(F.filter(F.array(arr), lambda x: F.size(x) == 1), 0), 0)


def _records(spark, path, file, pattern, strip_outer_array, recursive, keep, where, line_numbers):
    """``(file_path, line, value, parsed, *keep)`` of every record."""
    if strip_outer_array:
        return _array_records(spark, path, file, pattern, recursive, keep, where)
    # blank lines are not records: numbering counts records
    if line_numbers:
        lines = numbered_lines(spark, path, file=file, pattern=pattern, recursive=recursive, keep=keep, skip_blank=True, where=where)
    else:
        raw = selected_text(spark, path, file, pattern, recursive, where)
        lines = raw.where(~F.col("value").rlike(r"^\s*$")).select(
            F.col("_metadata.file_path").alias("file_path"), F.lit(None).cast("long").alias("line"), "value", *(keep or []))
    return lines.withColumn("parsed", strict_json("value"))


#: Lines that are run through in one window when depths and elements are counted.
CHUNK = 65_536
_STRING = r'"(?:[^"\\]++|\\.)*+"?'
_SIGN = re.compile(r'"(?:[^"\\]|\\.)*"?|[\[\]{},]')


def _running(rows: DataFrame, amount: Column, out: str) -> DataFrame:
    """``rows(file_path, line, ..)`` with the sum of ``amount`` over the earlier lines of the file: sums by chunk are run through per
    file, and lines inside their chunk."""
    rows = rows.withColumn("_amount", amount).withColumn("_chunk", F.floor((F.col("line") - 1) / CHUNK).cast("long"))
    earlier = Window.partitionBy("file_path").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = materialised(rows.groupBy("file_path", "_chunk").agg(F.sum("_amount").alias("_sum")).select(
        F.col("file_path").alias("_of"), F.col("_chunk").alias("_in"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before")), "chunk-sums")
    inside = Window.partitionBy("file_path", "_chunk").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("_inside", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
    return (summed.join(before, (F.col("file_path") == F.col("_of")) & (F.col("_chunk") == F.col("_in")))
            .withColumn(out, F.col("_before") + F.col("_inside")).drop("_amount", "_chunk", "_inside", "_of", "_in", "_before"))


def _depths(line: Column) -> Column:
    """``struct<delta, least>``: by how much a line of JSON changes the depth of brackets, and the least depth on the way, 0 being
    that before the line. Brackets in strings don't count; a string never spans lines."""
    signs = F.regexp_replace(F.regexp_replace(line, _STRING, ""), "[^\\[\\]{}]+", "")
    steps = F.transform(F.split(signs, ""), lambda c: F.when(c.isin("[", "{"), 1).when(c.isin("]", "}"), -1).otherwise(0))
    plain = F.struct(F.lit(0).alias("delta"), F.lit(0).alias("least"))
    return F.when(signs == "", plain).otherwise(F.aggregate(steps, plain, lambda acc, x: F.struct(
        (acc["delta"] + x).alias("delta"), F.least(acc["least"], acc["delta"] + x).alias("least"))))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of each line of a top-level array, cut at the commas of depth 1 and without the array's own brackets."""
    for batch in batches:
        parts = []
        for text, depth, least in zip(*[batch.column(c).to_pylist() for c in ("value", "depth", "least")], strict=True):
            if depth + least > 1:  # the whole line lies inside an element
                parts.append([text])
                continue
            own, at = [], 0
            for sign in _SIGN.finditer(text):
                c = sign.group()
                if c in "[{":
                    depth += 1
                    if depth == 1:
                        at = sign.end()
                elif c in "]}":
                    depth -= 1
                    if depth == 0:
                        own.append(text[at:sign.start()])
                        at = len(text)
                elif c == "," and depth == 1:
                    own.append(text[at:sign.start()])
                    at = sign.end()
            parts.append(own if depth == 0 else [*own, text[at:]])
        kept = [c for c in batch.schema.names if c not in ("value", "depth", "least")]
        yield pa.record_batch([*[batch.column(c) for c in kept], pa.array(parts, pa.list_(pa.string()))], names=[*kept, "parts"])


def _array_records(spark, path, file, pattern, recursive, keep, where):
    """The elements of the arrays of each file, numbered through the file, and values that are no arrays as they are. A
    file is one value a line, or one value on many lines; its elements come out as equal JSON text either way.

    A file whose lines are balanced in brackets is read line by line. Of any other, the depth of brackets before each line is a running
    sum; if the file is one array, its lines are cut at the commas of depth 1 wherever they lie, so that many tasks
    read a large file and only the lines of one element meet. A file that is neither is read line by line too."""
    keep = list(keep or [])
    lines = numbered_lines(spark, path, file=file, pattern=pattern, recursive=recursive, keep=keep, skip_blank=True, where=where)
    lines = materialised(lines.withColumn("_d", _depths(F.col("value"))).select("file_path", "line", "value", *keep, "_d.delta", "_d.least"), "json-lines")
    first = F.max(F.when(F.col("line") == 1, F.substring(F.ltrim("value"), 1, 1)))
    files = materialised(lines.groupBy("file_path").agg(F.max(F.col("delta") != 0).alias("broken"), F.sum("delta").alias("total"), first.alias("first"))
                         .where(F.col("broken") & (F.col("total") == 0) & F.col("first").isin("[", "{")).select("file_path", "first"), "json-files")
    if files.isEmpty():
        return _numbered_values(lines, keep)
    deep = _running(lines.join(files, "file_path"), F.col("delta"), "depth")
    odd = F.max((F.col("depth") + F.col("least") < 0) | ((F.col("line") > 1) & (F.col("depth") < 1)))
    one = materialised(deep.groupBy("file_path").agg(odd.alias("odd")).where("not odd").select("file_path"), "json-one-value")
    deep = deep.join(one, "file_path", "left_semi")
    columns = ["file_path", "line", *keep]
    kind = T.StructType([*deep.select(*columns, "first").schema.fields, T.StructField("parts", T.ArrayType(T.StringType()))])
    cut = deep.where(F.col("first") == "[").select(*columns, "first", "value", "depth", "least").mapInArrow(_cut, kind)
    whole = deep.where(F.col("first") == "{").select(*columns, "first", F.array("value").alias("parts"))
    parts = _running(materialised(cut.unionByName(whole), "json-parts"), F.size("parts") - 1, "_earlier")
    pieces = parts.select(*columns, "first", "_earlier", F.posexplode("parts").alias("_at", "_part")).withColumn("_element", F.col("_earlier") + F.col("_at") + 1)
    # the lines of one element; an array without elements has one blank one
    elements = pieces.groupBy("file_path", *keep, "first", "_element").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("line", "_part"))), lambda x: x["_part"]), "\n").alias("_text")).where(~F.col("_text").rlike(r"^\s*$"))
    parsed = elements.withColumn("parsed", strict_json("_text"))
    found = parsed.select("file_path", F.col("_element").cast("long").alias("line"), F.coalesce(F.to_json("parsed"), F.col("_text")).alias("value"), "parsed", *keep)
    rest = lines.join(one, "file_path", "left_anti")
    return found.unionByName(_numbered_values(rest, keep).select(*found.columns))


def _numbered_values(lines: DataFrame, keep: list[str]) -> DataFrame:
    """One value a line: the elements of arrays, and other values as they are, numbered through the file."""
    values = lines.withColumn("_v", strict_json("value"))
    is_array = F.substring(F.schema_of_variant("_v"), 1, 5) == "ARRAY"
    items = F.when(is_array, F.transform(F.try_variant_get("_v", "$", "array<variant>"), lambda v: F.struct(F.to_json(v).alias("value"), v.alias("parsed")))).otherwise(
        F.array(F.struct(F.coalesce(F.to_json("_v"), F.col("value")).alias("value"), F.col("_v").alias("parsed"))))
    rows = _running(materialised(values.select("file_path", "line", *keep, items.alias("_items")), "json-values"), F.size("_items"), "_earlier")
    return rows.select("file_path", *keep, "_earlier", F.posexplode("_items").alias("_i", "_r")).select(
        "file_path", (F.col("_earlier") + F.col("_i") + 1).cast("long").alias("line"), "_r.value", "_r.parsed", *keep)


def variant_landing(spark: SparkSession, path: str, file: str | None = None, pattern: str | None = None,
                    strip_outer_array: bool = False, recursive: bool = False, id_offset: int = 0,
                    keep: list[str] | None = None, date_property: str | None = None, where: Column | None = None,
                    line_numbers: bool = True) -> DataFrame:
    """Load JSON records as ``(id, load_time, origin_file_name, origin_file_line, origin_str, properties)``.

    ``strip_outer_array``: the elements of top-level arrays are the records, on one line or many.
    ``where`` is a condition on partition columns of the source; it reaches the scan.
    Without ``line_numbers`` the line is NULL, and the pass that counts lines isn't made.
    Invalid JSON keeps its ``origin_str`` and gets a NULL ``properties``.
    ``id`` is unique (not dense) above ``id_offset`` (pass the target's max id).
    ``date_property`` promotes ``date(properties:<prop>)`` to a real ``slice_date``
    column (``yyyy-MM-dd``), so a target can be partitioned by its slices and a
    guarded reload replaces one partition instead of rewriting the table.
    """
    rec = _records(spark, path, file, pattern, strip_outer_array, recursive, keep, where, line_numbers)
    return rec.select(
        (F.lit(id_offset).cast("long") + F.monotonically_increasing_id() + 1).alias("id"),
        F.current_timestamp().alias("load_time"),
        F.col("file_path").alias("origin_file_name"),
        F.col("line").alias("origin_file_line"),
        F.col("value").alias("origin_str"),
        F.col("parsed").alias("properties"),
        *(keep or []),
    ).transform(lambda d: _with_slice_date(d, "properties", date_property, cast_date=True))


def _with_slice_date(df: DataFrame, col: str, prop: str | None, cast_date: bool) -> DataFrame:
    if not prop:
        return df
    v = F.try_variant_get(F.col(col), f"$.{prop}", "date" if cast_date else "string")
    return df.withColumn("slice_date", F.date_format(v, "yyyy-MM-dd") if cast_date else v)


def session_landing(spark: SparkSession, path: str, ga_view_id: str, pattern: str = ".*",
                    file: str | None = None, recursive: bool = False, id_offset: int = 0,
                    keep: list[str] | None = None, date_key: str | None = None, where: Column | None = None,
                    line_numbers: bool = True) -> DataFrame:
    """Load one date of session records, tagged with the source dataset ``ga_view_id``.

    ``date_key`` promotes the session's date text (string, as the slice predicate
    compares it) to a ``slice_date`` column for partitioning the target.
    """
    rec = _records(spark, path, file, pattern, False, recursive, keep, where, line_numbers)
    return rec.select(
        (F.lit(id_offset).cast("long") + F.monotonically_increasing_id() + 1).alias("id"),
        F.current_timestamp().alias("load_time"),
        F.col("file_path").alias("origin_file_name"),
        F.col("line").alias("origin_file_line"),
        F.lit(ga_view_id).alias("ga_view_id"),
        F.col("parsed").alias("session"),
        *(keep or []),
    ).transform(lambda d: _with_slice_date(d, "session", date_key, cast_date=False))
