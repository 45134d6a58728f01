"""Typed records as table jobs: validation, conformance, replace, diff and the TSV codec."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.convert import FLOAT_TEXT, INT_TEXT, datetime_digits, python_float_text, strip_ws, variant_kind
from ..spec import Field, RecordSpec
from .sizing import materialised

# Validation messages
MSG_NULL = "The field cannot accept null values"
MSG_NOT_STRING = "The value is not a string"
MSG_TOO_LONG = "The string length exceeds the maximum allowed"
MSG_NOT_TUPLE = "The value is not a tuple"
MSG_NOT_BOOL = "The value is not a bool"
MSG_NOT_INT = "The value is not an integer"
MSG_NOT_DATE = "The value is not a date"
MSG_NOT_DATETIME = "The value is not a datetime"
MSG_NAIVE = "The value is a naive datetime."
MSG_NOT_UTC = "The value must use UTC timezone."
MSG_PRE_1900 = "The value must be a date after 1900."
MSG_NOT_FLOAT = "The value is not a floating point number"
UNKNOWN_FIELDS, REQUIRED_FIELDS = "Unknown fields specified: ", "Required fields not specified: "
MSG_ARITY = "The length of the tuple of strings must exactly match the number of fields in the Record"
HIVE_NULL = "\\N"
DELIMITED_SEP = "\x00"
ERROR_TYPE = "array<struct<field:string,message:string>>"


def _msgs(field: str, conds: list[tuple[Column, str]]) -> Column:
    """``struct(field, "msg1, msg2")`` of the failing checks of one field, or null (plain columns, no lambdas)."""
    text = F.concat_ws(", ", *[F.when(c, m if isinstance(m, Column) else F.lit(m)) for c, m in conds])
    return F.when(text != "", F.struct(F.lit(field).alias("field"), text.alias("message")))


def _collect(errs: list[Column]) -> Column:
    if not errs:
        return F.array().cast(ERROR_TYPE)
    # rows without an error, nearly all, skip the filter
    return F.when(F.coalesce(*errs).isNull(), F.array().cast(ERROR_TYPE)).otherwise(F.filter(F.array(*errs), lambda e: e.isNotNull()))


def error_text(errors) -> Column:
    """``field: msg; field: msg`` (empty string when there is no error)."""
    e = F.col(errors) if isinstance(errors, str) else errors
    return F.when(F.size(e) == 0, "").otherwise(
        F.array_join(F.transform(e, lambda x: F.concat(x["field"], F.lit(": "), x["message"])), "; "))


def field_checks(f: Field, c: Column) -> Column:
    """Checks of one typed column (types are static in Spark; value checks remain)."""
    conds = [(c.isNull(), MSG_NULL)] if not f.nullable else []
    if f.kind == "string" and f.length and not f.truncate:
        conds.append((F.length(c) > f.length, MSG_TOO_LONG))
    if f.kind == "datetime":
        conds.append((F.year(c) < 1900, MSG_PRE_1900))
    return _msgs(f.name, conds) if conds else F.lit(None)


def raise_on_errors(df: DataFrame, errors_col: str = "errors", label: str = "record") -> DataFrame:
    """Strict mode: fail the job on the first row with errors (the message names the fields)."""
    msg = F.concat(F.lit(f"Unable to assign the values of this {label}: "), error_text(errors_col))
    return df.withColumn(errors_col, F.when(F.size(errors_col) > 0, F.raise_error(msg))
                         .otherwise(F.col(errors_col)))


def record_validate(df: DataFrame, spec: RecordSpec, errors_col: str = "errors") -> DataFrame:
    """Add ``errors array<struct<field, message>>``; an empty array means a valid record."""
    return df.withColumn(errors_col, _collect([field_checks(f, F.col(f.name)) for f in spec.fields]))


def conform(df: DataFrame, spec: RecordSpec, sparse: bool = False) -> DataFrame:
    """Order and type columns like the spec. Unknown columns are an error; missing ones are an
    error unless ``sparse`` (then they are typed NULLs). Schema-level, checked before running."""
    unknown = [c for c in df.columns if c not in spec.names]
    if unknown:
        raise TypeError(UNKNOWN_FIELDS + ", ".join(unknown))
    missing = [n for n in spec.names if n not in df.columns]
    if missing and not sparse:
        raise TypeError(REQUIRED_FIELDS + ", ".join(missing))
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.spark_type).alias(f.name)
                       for f in spec.fields])


def record_replace(df: DataFrame, spec: RecordSpec, errors_col: str = "errors", **cols: Column) -> DataFrame:
    """Same rows with some fields overridden, then re-validated."""
    bad = [k for k in cols if k not in spec.names]
    if bad:
        raise TypeError(UNKNOWN_FIELDS + ", ".join(bad))
    return record_validate(df.withColumns(cols), spec, errors_col)


#: Bits of a row's hash that name its node, level by level of the hash tree.
TREE_BITS = (12, 24)


def _node_sums(rows: DataFrame, bits: int) -> DataFrame:
    """``(_node, _rows, _low, _high)``: per node the number of rows and the sum of their hashes in two halves, whatever their
    order. Partial sums, so a task sends a row per node."""
    return rows.groupBy(F.shiftrightunsigned("_h", 64 - bits).alias("_node")).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(F.col("_g").bitwiseAND(F.lit(0xFFFFFFFF))).alias("_low"), F.sum(F.shiftrightunsigned("_g", 32)).alias("_high"))


def differing_nodes(a: DataFrame, b: DataFrame, bits: int) -> DataFrame:
    """The nodes whose rows differ between two sides (``_h``, ``_g``: two hashes of a row), written as a table."""
    sums = ("_rows", "_low", "_high")
    both = _node_sums(a, bits).unionByName(_node_sums(b, bits).select("_node", *[(-F.col(c)).alias(c) for c in sums]))
    total = both.groupBy("_node").agg(*[F.sum(c).alias(c) for c in sums])
    return materialised(total.where(" or ".join(f"{c} <> 0" for c in sums)).select("_node"), "nodes")


def record_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows present on one side only (multiset difference both ways) with a ``side`` column.

    Records are equal when field names, order and values are equal; schemas
    are compared first. VARIANT columns are compared through their JSON text.

    Both sides are compared by a hash tree first: sums of row hashes per node, then per finer node below the nodes that
    differ. Only rows of nodes that differ are shuffled, so two equal tables compare by sums alone. (Two different sets of
    rows in one node would have to agree in their number and in a 64-bit sum to be missed.)
    """
    if [f.name for f in a.schema.fields] != [f.name for f in b.schema.fields]:
        raise ValueError("records differ in their fields")
    names = a.columns

    def comparable(df):
        rows = df.select(*[F.to_json(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "variant"
                           else F.col(f.name) for f in df.schema.fields])
        # a hash passes over nulls, so where they stand is hashed too
        cells = [*[F.col(f"`{c}`") for c in names], *[F.col(f"`{c}`").isNull() for c in names]]
        return rows.withColumns({"_h": F.xxhash64(F.lit(1), *cells), "_g": F.xxhash64(F.lit(2), *cells)})

    left, right = comparable(a), comparable(b)
    for bits in TREE_BITS:
        nodes = differing_nodes(left, right, bits)
        if nodes.isEmpty():
            return left.drop("_h", "_g").limit(0).withColumn("side", F.lit("left"))
        at = F.shiftrightunsigned("_h", 64 - bits) == F.col("_node")
        left, right = (x.join(nodes, at, "left_semi") for x in (left, right))
    # one shuffle: a row counts +1 on the left and -1 on the right
    both = left.select(*names, F.lit(1).alias("_n")).unionByName(right.select(*names, F.lit(-1).alias("_n")))
    extra = both.groupBy(*names).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    return extra.withColumn("side", F.when(F.col("_n") > 0, "left").otherwise("right")).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.abs("_n").cast("int")))).select(*names, "side")


# --- JSON rows -> records (row-level conformance) -----------------------------------------------

def _json_field(f: Field, v: Column, k: Column) -> tuple[Column, list[tuple[Column, str]]]:
    """Typed value and type checks for one field read from a VARIANT value of JSON kind ``k``."""
    present = k != "null"
    txt = F.variant_get(v, "$", "string")
    if f.kind == "string":
        val = F.when(k == "string", txt)
        checks = [(present & (k != "string"), MSG_NOT_STRING)]
        if f.length and not f.truncate:
            checks.append(((k == "string") & (F.length(txt) > f.length), MSG_TOO_LONG))
        if f.truncate:
            val = F.substring(val, 1, f.length)
        return val, checks
    if f.kind == "delimited":
        ok = k == "array"
        return F.when(ok, F.variant_get(v, "$", "array<string>")), [(present & ~ok, MSG_NOT_TUPLE)]
    if f.kind == "boolean":
        ok = k == "boolean"
        return F.when(ok, F.variant_get(v, "$", "boolean")), [(present & ~ok, MSG_NOT_BOOL)]
    if f.kind == "integer":
        ok = k.isin("int", "boolean")  # a boolean is an integer in the source language
        val = F.when(k == "int", F.try_variant_get(v, "$", "bigint")).when(
            k == "boolean", F.variant_get(v, "$", "boolean").cast("bigint"))
        # an integer of more than 64 bits is no value of the column
        return val, [(present & (~ok | val.isNull()), MSG_NOT_INT)]
    if f.kind == "float":
        ok = k.isin("int", "number", "boolean") | ((k == "string") & txt.rlike(FLOAT_TEXT))
        val = F.when(k.isin("int", "number"), F.variant_get(v, "$", "double")).when(
            k == "boolean", F.variant_get(v, "$", "boolean").cast("double")).when(
            (k == "string") & txt.rlike(FLOAT_TEXT), strip_ws(txt).try_cast("double"))
        return val, [(present & ~ok, MSG_NOT_FLOAT)]
    if f.kind == "date":
        d = F.when((k == "string") & txt.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.to_date(txt.try_cast("date")))
        return d, [(present & d.isNull(), MSG_NOT_DATE)]
    # datetime: ISO text; an offset is required and must be zero
    ts = F.when(k == "string", F.try_to_timestamp(txt))
    has_off = txt.rlike(r"(Z|z|[+-][0-9]{2}(:?[0-9]{2})?)$")
    zero_off = txt.rlike(r"(Z|z|[+-]00(:?00)?)$")
    msg = (F.when(present & ts.isNull(), F.lit(MSG_NOT_DATETIME))
           .when(present & ~has_off, F.lit(MSG_NAIVE))
           .when(present & ~zero_off, F.lit(MSG_NOT_UTC))
           .when(present & (F.year(ts) < 1900), F.lit(MSG_PRE_1900)))
    return F.when(msg.isNull(), ts), [(msg.isNotNull(), msg)]


def conform_json(df: DataFrame, json_col: str, spec: RecordSpec, sparse: bool = False,
                 keep: list[str] | None = None, errors_col: str = "errors") -> DataFrame:
    """One JSON object per row -> typed spec columns + ``errors``.

    Per row: keys outside the spec are an error, absent keys are an error
    unless ``sparse`` (absent = null), then every field is type checked.
    The document is parsed once; every field's value and kind are projected once.
    """
    keep = list(keep or [])
    parsed = df.select(*keep, F.from_json(F.col(json_col), "map<string,variant>").alias("_obj"))
    obj = F.col("_obj")
    fields = parsed.select(*keep, obj.isNull().alias("_bad"),
                           F.coalesce(F.map_keys(obj), F.array().cast("array<string>")).alias("_keys"),
                           *[obj[f.name].alias(f"_v{i}") for i, f in enumerate(spec.fields)])
    names = F.array(*[F.lit(n) for n in spec.names])
    unknown = F.array_except(F.col("_keys"), names)
    missing = F.array_except(names, F.col("_keys"))
    row_errs = [
        F.when(F.col("_bad"), F.struct(F.lit("*").alias("field"), F.lit("not a JSON object").alias("message"))),
        F.when(F.size(unknown) > 0, F.struct(F.lit("*").alias("field"), F.concat(
            F.lit(UNKNOWN_FIELDS), F.array_join(unknown, ", ")).alias("message"))),
    ]
    if not sparse:
        row_errs.append(F.when(F.size(missing) > 0, F.struct(F.lit("*").alias("field"), F.concat(
            F.lit(REQUIRED_FIELDS), F.array_join(missing, ", ")).alias("message"))))
    kinds = fields.select(*keep, "_bad", "_keys", *[F.col(f"_v{i}") for i in range(len(spec.fields))],
                          *[variant_kind(F.col(f"_v{i}")).alias(f"_k{i}") for i in range(len(spec.fields))])
    values, field_errs = [], []
    for i, f in enumerate(spec.fields):
        val, checks = _json_field(f, F.col(f"_v{i}"), F.col(f"_k{i}"))
        if not f.nullable:
            checks = [(val.isNull() & (F.col(f"_k{i}") == "null"), MSG_NULL)] + checks
        values.append(val.cast(f.spark_type).alias(f.name))
        field_errs.append(_msgs(f.name, checks))
    return kinds.select(*keep, *values, _collect(row_errs + field_errs).alias(errors_col))


# --- Hive TSV codec --------------------------------------------------------------------------------

def encode_field(f: Field, c: Column, normalize_ws: bool = False) -> Column:
    if f.kind == "string":
        s = F.substring(c, 1, f.length) if f.truncate else c
    elif f.kind == "delimited":
        s = F.array_join(c, DELIMITED_SEP)
    elif f.kind == "boolean":
        s = F.when(c, F.lit("1")).when(~c, F.lit("0"))
    elif f.kind == "date":
        s = F.date_format(c, "yyyy-MM-dd")
    elif f.kind == "datetime":
        s = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif f.kind == "float":
        s = python_float_text(c)
    else:
        s = c.cast("string")
    if normalize_ws or f.normalize_whitespace:
        s = F.regexp_replace(s, r"(?U)\s+", " ")
    return s


def tsv_encode(df: DataFrame, spec: RecordSpec, sep: str = "\t", null: str = HIVE_NULL,
               normalize_ws: bool = False, col: str = "line", keep: list[str] | None = None) -> DataFrame:
    """Fields in declaration order -> one separated line; null -> ``\\N``; no escaping."""
    parts = [F.coalesce(encode_field(f, F.col(f.name), normalize_ws), F.lit(null)) for f in spec.fields]
    return df.select(*(keep or []), F.concat_ws(sep, *parts).alias(col))


def decode_field(f: Field, s: Column) -> tuple[Column, list[tuple[Column, str]]]:
    if f.kind == "string":
        return s, []
    if f.kind == "delimited":
        return F.split(s, DELIMITED_SEP, -1), []
    if f.kind == "boolean":
        return s == "1", []
    if f.kind == "integer":
        ok = s.rlike(INT_TEXT)
        val = F.when(ok, strip_ws(s).try_cast("bigint"))
        return val, [(s.isNotNull() & val.isNull(), MSG_NOT_INT)]
    if f.kind == "float":
        ok = s.rlike(FLOAT_TEXT)
        return F.when(ok, strip_ws(s).try_cast("double")), [(s.isNotNull() & ~ok, MSG_NOT_FLOAT)]
    if f.kind == "date":
        p = F.split(s, "-", -1)
        d = F.when(F.size(p) == 3, F.try_make_timestamp_ntz(
            p[0].try_cast("int"), p[1].try_cast("int"), p[2].try_cast("int"), F.lit(0), F.lit(0), F.lit(0)))
        return F.to_date(d), [(s.isNotNull() & d.isNull(), MSG_NOT_DATE)]
    d = datetime_digits(s)
    return d.cast("timestamp"), [(s.isNotNull() & d.isNull(), MSG_NOT_DATETIME)]


def tsv_decode(df: DataFrame, spec: RecordSpec, col: str = "line", sep: str = "\t", null: str = HIVE_NULL,
               keep: list[str] | None = None, errors_col: str = "errors") -> DataFrame:
    """Separated lines -> typed spec columns + ``errors`` (arity, parse and validation errors).

    The line is split once (projected) and every field reads the shared cells.
    """
    keep = list(keep or [])
    pattern = "\\t" if sep == "\t" else re.escape(sep)
    split = df.select(*keep, F.split(F.regexp_replace(F.col(col), r"[\r\n]+$", ""), pattern, -1).alias("_cells"))
    cells = F.col("_cells")
    arity_ok = F.coalesce(F.size(cells) == len(spec.fields), F.lit(False))
    raws = split.select(*keep, arity_ok.alias("_ok"), *[
        F.when(arity_ok, F.nullif(cells[i], F.lit(null))).alias(f"_raw{i}") for i in range(len(spec.fields))])
    ok = F.col("_ok")
    vals, errs = [], [F.when(~ok, F.struct(F.lit("*").alias("field"), F.lit(MSG_ARITY).alias("message")))]
    for i, f in enumerate(spec.fields):
        v, checks = decode_field(f, F.col(f"_raw{i}"))
        v = v.cast(f.spark_type)
        checks = checks + _value_checks(f, v, ok)
        vals.append(v.alias(f.name))
        errs.append(_msgs(f.name, checks))
    return raws.select(*keep, *vals, _collect(errs).alias(errors_col))


def _value_checks(f: Field, v: Column, arity_ok: Column) -> list[tuple[Column, str]]:
    out = []
    if not f.nullable:
        out.append((arity_ok & v.isNull(), MSG_NULL))
    if f.kind == "string" and f.length and not f.truncate:
        out.append((F.length(v) > f.length, MSG_TOO_LONG))
    if f.kind == "datetime":
        out.append((F.year(v) < 1900, MSG_PRE_1900))
    return out
