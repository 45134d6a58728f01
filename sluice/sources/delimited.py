"""Delimited text loads (schema from the target) and manifest driven loads."""

from __future__ import annotations

import os
import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import numbered_lines, object_inventory, read_text
from .records import Dialect, classified, records

# What a letter after the escape character stands for; any other character stands for itself
ESCAPES = (("n", "\n"), ("t", "\t"), ("r", "\r"), ("0", "\x00"), ("b", "\b"), ("Z", "\x1a"))
NULL_TEXT = "\\N"


def _none(v: str | None) -> str | None:
    return None if v in (None, "", "NONE") else v


def _unescaped(text: Column, escape: str) -> Column:
    """Text with its escapes resolved. Pairs of escape characters cut it into parts, so that in a part every escape
    character begins an escape."""
    e = re.escape(escape)

    def part(x: Column) -> Column:
        for letter, value in ESCAPES:
            x = F.replace(x, F.lit(escape + letter), F.lit(value))
        return F.regexp_replace(x, f"(?s){e}(.)", "$1")

    return F.when(F.contains(text, F.lit(escape)), F.array_join(F.transform(F.split(text, e + e), part), escape)).otherwise(text)


def _dialect(sep: str, quote: str | None, escape: str | None) -> Dialect:
    return Dialect(sep, quote, escape if escape != quote else None, lenient_end=False)


def split_fields(line: Column, sep: str, quote: str | None, escape: str | None) -> Column:
    """The raw fields of a record, with their quotes and escapes."""
    return _dialect(sep, quote, escape).raw_fields(line)


def _value(raw: Column, quote: str | None, escape: str | None, null_value: str) -> Column:
    own = escape if escape and escape != quote else None
    plain = _unescaped(raw, own) if own else raw
    plain = F.when(raw == F.lit(null_value), F.lit(None)).otherwise(plain)
    if not quote:
        return plain
    inner = F.replace(F.substr(raw, F.lit(2), F.length(raw) - 2), F.lit(quote * 2), F.lit(quote))
    enclosed = raw.startswith(quote) & raw.endswith(quote) & (F.length(raw) >= 2)
    return F.when(enclosed, _unescaped(inner, own) if own else inner).otherwise(plain)


def delimited_load(spark: SparkSession, path: str | list[str], schema_ddl: str, sep: str = ",",
                   quote: str | None = "", escape: str | None = "\\", ignore_lines: int = 0, null_value: str = NULL_TEXT,
                   multiline: bool = False, on_error: str = "raise") -> DataFrame:
    """Delimited files -> typed rows, as MySQL reads them. ``ignore_lines`` lines are skipped at the start of each file.

    ``escape`` (not if it is None or ``"NONE"``, or the quote itself) makes the next character text, also a separator or
    a line break, but for the letters of :data:`ESCAPES`; ``\\N`` alone is NULL, an empty field an empty string (NULL if
    the column is no text). Fields may be enclosed by ``quote``: it counts where a field begins and ends, a doubled one
    inside is one, any other is text. Files are read in splits. Line breaks inside fields need ``multiline``: then lines
    that belong together are joined first.

    A value that its column can't hold, and too few or too many fields, fail the job; with ``on_error="column"`` such
    values are NULL and ``_errors`` (array of text) says what was wrong.
    """
    quote, escape = _none(quote), _none(escape)
    schema = T._parse_datatype_string(schema_ddl)
    if ignore_lines or multiline:
        lines = numbered_lines(spark, path).where(F.col("line") > ignore_lines)
    else:
        lines = read_text(spark, path)
    if multiline:
        found = records(classified(lines, _dialect(sep, quote, escape))).select("value", "malformed")
    else:
        found = lines.select("value", F.lit(False).alias("malformed"))
    if len(schema.fields) > 1:
        found = found.where(F.col("value") != "")
    raw = found.select("value", "malformed", split_fields(F.col("value"), sep, quote, escape).alias("_raw"))
    n = len(schema.fields)
    values, errors = [], [
        F.when(F.size("_raw") != n, F.format_string(f"%d fields instead of {n}", F.size("_raw"))),
        F.when(F.col("malformed") | (F.aggregate("_raw", F.lit(0), lambda a, x: a + F.length(x) + 1) != F.length("value") + 1), F.lit("a field is not closed"))]
    for i, f in enumerate(schema.fields):
        v = _value(F.get("_raw", F.lit(i)), quote, escape, null_value)
        if isinstance(f.dataType, T.StringType):
            values.append(v.alias(f.name))
            continue
        typed = F.when(v != "", v).try_cast(f.dataType)
        values.append(typed.alias(f.name))
        errors.append(F.when((v != "") & typed.isNull(), F.concat(F.lit(f"{f.name} can't hold: "), v)))
    parsed = raw.select(*values, F.array_compact(F.array(*errors)).alias("_errors"))
    if on_error == "column":
        return parsed
    # the id keeps the check where it stands: moved below a join or filter, it would see lines that are no records
    fail = F.when((F.size("_errors") > 0) & (F.monotonically_increasing_id() >= 0), F.raise_error(F.array_join("_errors", "; ")).cast("boolean")).otherwise(F.lit(True))
    return parsed.where(fail).drop("_errors")


def _same_file(path: Column) -> Column:
    """A local path in one form, whatever the number of slashes after its scheme."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def manifest_entries(spark: SparkSession, manifest_path: str) -> DataFrame:
    """``{"entries":[{"url":..., "mandatory":...}]}``, on one line or many -> ``(url, mandatory)`` rows."""
    m = spark.read.schema("entries array<struct<url string, mandatory boolean>>").option("multiLine", "true").json(manifest_path)
    return m.select(F.explode("entries").alias("e")).select("e.url", "e.mandatory")


def _listed(spark: SparkSession, folders: list[str]) -> DataFrame:
    """``_url`` of every file of the folders, in one listing; folders that don't exist hold none."""
    none = spark.createDataFrame([], "_url string")
    if not folders:
        return none
    literal = lambda x: re.sub(r"([\\{}\[\]*?,])", r"\\\1", x)
    parent = os.path.commonprefix([f + "/" for f in folders])
    parent = parent[:parent.rindex("/") + 1]
    names = sorted({literal((f + "/")[len(parent):].rstrip("/")) for f in folders})
    # a pattern need not match everywhere, so a folder that is missing is no error
    pattern = literal(parent) + ("{" + ",".join(names) + "}" if any(names) else "*")
    try:
        return object_inventory(spark, pattern).select(_same_file(F.col("path")).alias("_url")).distinct()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return none


def manifest_load(spark: SparkSession, url: str, schema_ddl: str, manifest_name: str = "manifest.json",
                  **delimited_options) -> DataFrame:
    """Load the files listed in ``<url>/manifest.json``; a missing mandatory file is an error.

    Entries are held against a listing of their folders by joins; what is collected is the names of the files to read,
    which a scan needs.
    """
    entries = manifest_entries(spark, url.rstrip("/") + "/" + manifest_name).withColumn("_url", _same_file(F.col("url")))
    there = _listed(spark, [r[0] for r in entries.select(F.regexp_replace("url", "/[^/]*$", "")).distinct().collect()])
    missing = entries.where(F.coalesce("mandatory", F.lit(False))).join(there, "_url", "left_anti").select("url").limit(5).collect()
    if missing:
        raise FileNotFoundError(f"mandatory manifest entries are missing: {', '.join(r['url'] for r in missing)}")
    paths = [r["url"] for r in entries.join(there, "_url", "left_semi").select("url").distinct().collect()]
    if not paths:
        return spark.createDataFrame([], schema_ddl)
    return delimited_load(spark, sorted(paths), schema_ddl, **delimited_options)
