"""Nested events -> flat records by a ``{'root.a.b': field}`` mapping.

The mapping is compiled to a trie over lower-cased labels. Each document is parsed once and walked once, along the trie alone:
keys that lead to no mapped path are passed over with all that is below them. Rows stay where they are (no explode, no
shuffle); Arrow batches hold the walk's result, one typed column per field, and texts are escaped, shortened and read as
times by Spark's own expressions. Lists and nulls are skipped; when several mapped sources feed one field the last one in document
order wins.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.convert import FLOAT_TEXT, INT_TEXT, map_bool, map_datetime, map_float, map_int, map_string, parse_iso_utc
from ..spec import Field, RecordSpec

ROOT = "root"
_INT, _FLOAT = re.compile(INT_TEXT, re.A), re.compile(FLOAT_TEXT, re.A)
_LONG = 1 << 63


def convert_value(f: Field, c: Column) -> Column:
    """The mapping conversion applied to a plain column (calculated entries)."""
    v = c.cast("variant")
    if f.kind == "string":
        return map_string(v, f.length)
    own = {"integer": map_int, "float": map_float, "boolean": map_bool, "datetime": map_datetime}.get(f.kind)
    return own(v) if own else F.variant_get(v, "$", f.spark_type.simpleString())


def _whole(v) -> int | None:
    """A number of 64 bits: whole-number text, numbers cut toward zero, booleans 1 and 0."""
    if isinstance(v, str):
        v = int(v) if len(v) < 64 and _INT.match(v) else None
    elif isinstance(v, float):
        v = int(v) if math.isfinite(v) else None
    return None if v is None or not -_LONG <= v < _LONG else int(v)


def _double(v) -> float | None:
    if isinstance(v, str):
        return float(v) if _FLOAT.match(v) else None
    try:
        return float(v)
    except OverflowError:
        return None


def _true(v) -> bool:
    """Non-empty text, a number other than zero, the boolean itself."""
    return bool(v)


def _text(v) -> str:
    return v if isinstance(v, str) else str(v)


#: Per kind of field: what becomes of a value, whether a failed conversion keeps an earlier source, and the column's type.
_KINDS: dict[str, tuple[Callable, bool, pa.DataType]] = {
    "integer": (_whole, True, pa.int64()), "float": (_double, True, pa.float64()), "boolean": (_true, True, pa.bool_()),
    "string": (_text, False, pa.string()), "datetime": (lambda v: v if isinstance(v, str) else None, False, pa.string())}
_OTHER = (_text, False, pa.string())


class Trie:
    """A node: by label, the places of the fields that a value there feeds, and the node below."""

    def __init__(self):
        self.fields: list[int] = []
        self.below: dict[str, Trie] = {}

    def add(self, labels: list[str], field: int) -> None:
        node = self
        for label in labels:
            node = node.below.setdefault(label, Trie())
        node.fields.append(field)

    def find(self, key: str) -> Trie | None:
        """The node of a key; a dot in a key separates labels like a step into an object."""
        node = self.below.get(key)
        if node is None and "." in key:
            node = self
            for label in key.split("."):
                node = node.below.get(label) if node else None
        return node


def _walk(node: Trie, obj: dict, out: list, kinds: list[tuple[Callable, bool, pa.DataType]]) -> None:
    for key, value in obj.items():
        if value is None or isinstance(value, list):
            continue
        at = node.find(key.lower())
        if at is None:
            continue
        if isinstance(value, dict):
            _walk(at, value, out, kinds)
            continue
        for field in at.fields:
            convert, keeps, _ = kinds[field]
            got = convert(value)
            if got is not None or not keeps:
                out[field] = got


def _parsed(text: str | None):
    try:
        return json.loads(text) if text is not None else None
    except (ValueError, RecursionError):
        return None


def _column(values: list, kind: pa.DataType) -> pa.Array:
    try:
        return pa.array(values, kind)
    except UnicodeEncodeError:  # an escaped half of a surrogate pair
        return pa.array([v if v is None else v.encode("utf-8", "replace").decode() for v in values], kind)


def flatten_by_mapping(df: DataFrame, json_col: str, mapping: dict[str, str], spec: RecordSpec,
                       calculated: dict[str, Column] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Apply ``mapping`` (``'root.a.b' -> field``) to one JSON document per row.

    Fields without a mapped value are null (sparse record), and so are all of a text that is no JSON object. Conversions that
    fail leave the field unset (integer / float / boolean keep an earlier
    source), a failed datetime clears it, strings are escaped and shortened.
    """
    keep, calc = keep or [], calculated or {}
    mapped = [f for f in spec.fields if f.name in mapping.values() and f.name not in calc]
    kinds, trie = [_KINDS.get(f.kind, _OTHER) for f in mapped], Trie()
    for path, name in mapping.items():
        labels = path.lower().split(".")
        if labels[0] != ROOT or len(labels) < 2:
            raise ValueError(f"mapping keys start with '{ROOT}.': {path}")
        for i, f in enumerate(mapped):
            if f.name == name:
                trie.add(labels[1:], i)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = [None] * len(mapped)
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                out = nothing.copy()
                doc = _parsed(text)
                if isinstance(doc, dict):
                    _walk(trie, doc, out, kinds)
                rows.append(out)
            found = [_column(list(c), k[2]) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if mapped else []
            yield pa.record_batch([*batch.columns[1:], *found], names=[*names[1:], *[f"_v_{f.name}" for f in mapped]])

    # a VARIANT passes as its JSON text
    carried = [F.col(f"`{k}`") for k in keep]
    source = df.select(F.col(json_col).alias("_json"), *carried, *[convert_value(f, calc[f.name]).cast(f.spark_type).alias(f"_calc_{f.name}")
                                                                   for f in spec.fields if f.name in calc])
    variants = [f.name for f in source.schema.fields if isinstance(f.dataType, T.VariantType)]
    source = source.withColumns({c: F.to_json(F.col(f"`{c}`")) for c in variants})
    names = source.columns
    arrow = {pa.int64(): T.LongType(), pa.float64(): T.DoubleType(), pa.bool_(): T.BooleanType(), pa.string(): T.StringType()}
    schema = T.StructType([*source.schema.fields[1:], *[T.StructField(f"_v_{f.name}", arrow[k[2]]) for f, k in zip(mapped, kinds, strict=True)]])
    walked = source.mapInArrow(run, schema)

    def value(f: Field) -> Column:
        if f.name in calc:
            return F.col(f"_calc_{f.name}").alias(f.name)
        if f not in mapped:
            return F.lit(None).cast(f.spark_type).alias(f.name)
        v = F.col(f"_v_{f.name}")
        if f.kind == "string":
            v = map_string(v, f.length, is_variant=False)
        elif f.kind == "datetime":
            v = parse_iso_utc(v)
        return (v.try_cast(f.spark_type) if f.kind not in _KINDS else v.cast(f.spark_type)).alias(f.name)

    kept = [(F.parse_json(F.col(f"`{k}`")) if k in variants else F.col(f"`{k}`")).alias(k) for k in keep]
    return walked.select(*kept, *[value(f) for f in spec.fields])
