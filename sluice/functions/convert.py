"""Value converters used when mapping semi-structured input onto typed fields.

Inputs are VARIANT values (types are kept), or plain strings where noted.
A conversion that fails gives null ("left unset"), never an exception.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
FLOAT_TEXT = (r"(?i)^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)\s*$")
# an explicit UTC offset (Z, +hh, +hhmm, +hh:mm) after a time
OFFSET_SUFFIX = r"[T ].*(Z|z|[+-][0-9]{2}(:?[0-9]{2})?)$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Remove leading / trailing whitespace of any kind (``trim`` removes only spaces)."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` (a lambda binding; subexpressions inside
    conditional branches are otherwise evaluated once per reference)."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _typed(v, fn, kind: Column | None = None) -> Column:
    """``fn(kind, value)`` with the JSON kind of the variant computed once (or given)."""
    if kind is not None:
        return fn(kind, _col(v))
    return let(F.struct(variant_kind(v).alias("k"), _col(v).alias("v")), lambda x: fn(x["k"], x["v"]))


def _shortest_text(d: Column) -> Column:
    """``d.ddd...e±XX`` with the fewest of 15, 16 or 17 significant digits that parses back to the
    same double (the JVM's own text can carry a digit too many, a known JDK 17 flaw)."""
    c15 = F.format_string("%.14e", d)
    c16 = F.format_string("%.15e", d)
    return (F.when(c15.cast("double") == d, c15)
            .when(c16.cast("double") == d, c16)
            .otherwise(F.format_string("%.16e", d)))


def python_float_text(d) -> Column:
    """Text of a double the way Python prints a float: shortest round-trip digits, plain notation
    for decimal exponents -4..15 (always with a fraction: ``3.0``), otherwise ``1.5e+16`` /
    ``2.5e-08``; ``nan``, ``inf``, ``-inf``.

    The chosen ``%e`` text is bound once (``let``) and read with plain string functions on its
    fixed layout (no regex).
    """
    d = _col(d)
    # a decimal of at most 15 digits that reads back as the same double is its shortest text
    short = d.try_cast("decimal(15,4)")
    return (F.when(d.isNull(), F.lit(None))
            .when((F.abs(d) >= 1e-3) & (short.cast("double") == d), F.regexp_replace(
                F.rtrim(short.cast("string"), F.lit("0")), r"\.$", ".0"))
            .when(F.isnan(d), F.lit("nan"))
            .when(d == float("inf"), F.lit("inf"))
            .when(d == float("-inf"), F.lit("-inf"))
            .otherwise(let(_shortest_text(d), _format_e_text)))


def _format_e_text(t: Column) -> Column:
    """``d.ddde±XX`` (bound once) -> Python float text."""
    neg = t.startswith("-")
    body = F.when(neg, F.substring(t, 2, 64)).otherwise(t)
    mant = F.substring_index(body, "e", 1)
    sci = F.substring_index(body, "e", -1).cast("int")
    digits = F.concat(F.substring(mant, 1, 1), F.substring_index(mant, ".", -1))
    sig = F.rtrim(digits, F.lit("0"))
    n = F.length(sig)
    int_len = sci + 1
    frac = F.when(n > int_len, sig.substr(int_len + 1, n)).otherwise(F.lit("0"))
    plain_pos = F.concat(F.rpad(F.substring(sig, 1, int_len), int_len, "0"), F.lit("."), frac)
    plain_neg = F.concat(F.lit("0."), F.repeat(F.lit("0"), -sci - 1), sig)
    exp_txt = F.when(F.abs(sci) < 10, F.concat(F.lit("0"), F.abs(sci).cast("string"))).otherwise(
        F.abs(sci).cast("string"))
    scientific = F.concat(F.substring(sig, 1, 1),
                          F.when(n > 1, F.concat(F.lit("."), sig.substr(F.lit(2), n))).otherwise(F.lit("")),
                          F.lit("e"), F.when(sci < 0, F.lit("-")).otherwise(F.lit("+")), exp_txt)
    text = (F.when(sig == "", F.lit("0.0"))
            .when((sci >= 0) & (sci < 16), plain_pos)
            .when((sci < 0) & (sci >= -4), plain_neg)
            .otherwise(scientific))
    return F.concat(F.when(neg, F.lit("-")).otherwise(F.lit("")), text)


def variant_kind(v) -> Column:
    """Coarse JSON type of a variant: null, boolean, int, number, string, object, array.

    The first character of the JSON text tells all but numbers, which their schema name does (a cast that
    fails, even a tried one, costs far more).
    """
    v = _col(v)

    def scalar(s):
        return (F.when(s.isNull() | (s == "VOID"), F.lit("null"))
                .when(s == "BOOLEAN", F.lit("boolean"))
                .when(s.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.lit("int"))
                # integer tokens that fit a long are BIGINT; a scale-0 decimal wider than that is a
                # big integer, a narrower one is a normalised float token such as 3.0
                .when(s.rlike(r"^DECIMAL\((19|[2-9][0-9]|1[0-9]{2}),0\)$"), F.lit("int"))
                .when(s.startswith("DECIMAL") | s.isin("DOUBLE", "FLOAT"), F.lit("number"))
                .when(s == "STRING", F.lit("string"))
                .otherwise(F.lit("other")))

    def by_first(c):
        return (F.when(c == "{", F.lit("object")).when(c == "[", F.lit("array")).when(c == '"', F.lit("string"))
                .when(c.isin("t", "f"), F.lit("boolean")).when(c == "n", F.lit("null")).otherwise(let(F.schema_of_variant(v), scalar)))
    return F.when(v.isNull(), F.lit("null")).otherwise(let(F.substring(F.to_json(v), 1, 1), by_first))


def variant_text(v, kind: Column | None = None) -> Column:
    """Python-like ``str(value)`` of a scalar variant: booleans print ``True`` / ``False``,
    JSON floats print like Python floats (``3.0``, ``1e+21``)."""
    return _typed(v, lambda k, x: F.when(k == "boolean", F.initcap(F.variant_get(x, "$", "string")))
                  .when(k == "number", python_float_text(F.variant_get(x, "$", "double")))
                  .otherwise(F.variant_get(x, "$", "string")), kind)


def escape_text(s) -> Column:
    """Backslash-encode ``\\``, CR, TAB and LF as two characters, NUL as ``\\0`` (backslash first)."""
    s = _col(s)
    out = F.replace(s, F.lit("\\"), F.lit("\\\\"))
    for raw, enc in (("\r", "\\r"), ("\t", "\\t"), ("\n", "\\n"), ("\x00", "\\0")):
        out = F.replace(out, F.lit(raw), F.lit(enc))
    return out


def map_string(v, length: int | None = None, is_variant: bool = True, kind: Column | None = None) -> Column:
    """Text of the value, escaped; longer than ``length`` -> first ``length-4`` chars + ``...``."""
    txt = variant_text(v, kind) if is_variant else _col(v)

    def shorten(esc):
        if length is None:
            return esc
        return F.when(F.length(esc) > length, F.concat(F.substring(esc, 1, max(length - 4, 0)), F.lit("...")))\
                .otherwise(esc)
    return let(escape_text(txt), shorten)


def map_int(v, kind: Column | None = None) -> Column:
    """Integer conversion: whole-number text, numbers truncated toward zero, booleans 1/0."""
    def conv(k, v):
        txt = F.variant_get(v, "$", "string")
        return (F.when(k == "int", F.try_variant_get(v, "$", "bigint"))
                .when(k == "number", F.variant_get(v, "$", "double").try_cast("bigint"))
                .when(k == "boolean", F.variant_get(v, "$", "boolean").cast("bigint"))
                .when((k == "string") & txt.rlike(INT_TEXT), strip_ws(txt).try_cast("bigint")))
    return _typed(v, conv, kind)


def map_float(v, kind: Column | None = None) -> Column:
    def conv(k, v):
        txt = F.variant_get(v, "$", "string")
        return (F.when(k.isin("int", "number"), F.variant_get(v, "$", "double"))
                .when(k == "boolean", F.variant_get(v, "$", "boolean").cast("double"))
                .when((k == "string") & txt.rlike(FLOAT_TEXT), strip_ws(txt).try_cast("double")))
    return _typed(v, conv, kind)


def map_bool(v, kind: Column | None = None) -> Column:
    """Truthiness: non-empty text, non-zero numbers, the boolean itself (``"false"`` is true)."""
    def conv(k, v):
        return (F.when(k == "boolean", F.variant_get(v, "$", "boolean"))
                .when(k.isin("int", "number"), F.variant_get(v, "$", "double") != 0)
                .when(k == "string", F.length(F.variant_get(v, "$", "string")) > 0))
    return _typed(v, conv, kind)


def parse_iso_utc(s) -> Column:
    """ISO-8601 text with an explicit offset -> UTC timestamp; naive, pre-1900 or bad text -> null."""
    return let(F.trim(_col(s)), _parse_iso_utc)


def _parse_iso_utc(s: Column) -> Column:
    ts = F.coalesce(
        F.try_to_timestamp(s),
        F.try_to_timestamp(s, F.lit("yyyyMMdd'T'HHmmss[.SSSSSS]X")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mmXXX")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd HH:mmXXX")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HH:mm[:ss][.SSSSSS]XX")),
        F.try_to_timestamp(s, F.lit("yyyy-MM-dd'T'HHX")),
    )
    return let(ts, lambda t: F.when(s.rlike(OFFSET_SUFFIX) & (F.year(t) >= 1900), t))


def map_datetime(v, kind: Column | None = None) -> Column:
    return _typed(v, lambda k, x: F.when(k == "string", parse_iso_utc(F.variant_get(x, "$", "string"))), kind)


def datetime_digits(s) -> Column:
    """All digit runs -> year, month, day[, hour, minute, second, fraction]; fraction read as an
    integer number of microseconds (``.5`` is 5 µs). Fewer than 3 or more than 7 runs -> null."""
    s = _col(s)
    parts = F.filter(F.split(F.regexp_replace(s, r"\D+", " "), " "), lambda x: x != "")
    # the codec's own layout, with six digits of fraction, reads the same as a plain timestamp
    own = s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{6}$")
    return F.when(own, s.try_cast("timestamp_ntz")).otherwise(let(parts, _digits_to_ts))


def _digits_to_ts(parts: Column) -> Column:
    n = F.size(parts)

    def part(i: int, default: int = 0) -> Column:
        return F.when(n > i, parts[i].try_cast("int")).otherwise(F.lit(default))

    sec = part(5).cast("decimal(16,6)") + (part(6).cast("decimal(16,6)") / F.lit(1000000)).cast("decimal(16,6)")
    ok = (n >= 3) & (n <= 7) & (part(6) < 1000000)
    return F.when(ok, F.try_make_timestamp_ntz(part(0), part(1), part(2), part(3), part(4),
                                              sec.cast("decimal(16,6)")))
