"""Report ingestion: file choice, control totals, report bodies, settlement and XML responses."""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import cents_error, cents_to_decimal, transaction_type
from ..sources.records import classified, csv_fields, records
from .datapages import plain_page
from .sizing import materialised

# Report row types and layout
ROW_TYPE_COL = "CH"
BODY = "SB"
FOOTER = "SF"
PREAMBLE_LINES = 3
# API response codes
SUCCESS_CODE = 100
STATUS_CREATED, STATUS_EXECUTING, STATUS_COMPLETE = 1, 2, 3
# Error texts that users match on
MISSING_ELEMENT = 'The required element "%s" was not found in the API response'
NO_BODY = 'Unable to find a valid response body, must be either "runReportResponse" or "getResultsResponse".'
# Settlement record fields, in order
SETTLEMENT_FIELDS = [
    "transaction_id", "time", "type", "tender_type", "account_number", "expires", "amount",
    "result_code", "response_msg", "comment_1", "comment_2", "batch_id", "currency_symbol",
    "paypal_transaction_id", "paypal_fees", "paypal_email_id", "original_pnref", "original_type",
    "original_amount", "original_time", "invoice_number", "purchase_order", "customer_ref",
]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- file choice -----------------------------------------------------------------------

def report_file_pick(files: DataFrame, prefix: str, dates: DataFrame, name_col: str = "name",
                     date_col: str = "report_date") -> DataFrame:
    """For each date: the file named like ``<prefix>*<yyyymmdd>*CSV`` without ``_TEST`` (min name).

    The name pattern is checked by position: every 8-digit window of a name
    that starts after the prefix and ends before the ``CSV`` suffix is a
    candidate date, so the match is an equi-join on the date (no pattern
    join, no per-row regex). Case-sensitive, whole name.
    """
    name = F.col(name_col)
    lo, suffix = len(prefix) + 1, 3
    cands = files.where(~name.contains("_TEST") & name.startswith(prefix) & name.endswith("CSV"))
    last_start = F.length(name) - suffix - 8 + 1
    windows = F.filter(
        F.transform(F.sequence(F.lit(lo), F.greatest(last_start, F.lit(lo))),
                    lambda i: F.struct(i.alias("i"), name.substr(i, F.lit(8)).alias("w"))),
        lambda x: (x["i"] <= last_start) & x["w"].rlike("^[0-9]{8}$"))
    cands = cands.select(name.alias("_name"), F.explode(F.array_distinct(
        F.transform(windows, lambda x: x["w"]))).alias("_ymd"))
    d = dates.select(F.col(date_col), F.date_format(F.col(date_col), "yyyyMMdd").alias("_ymd"))
    picked = d.join(cands, "_ymd").groupBy(date_col).agg(F.min("_name").alias(name_col))
    return dates.select(date_col).distinct().join(picked, date_col, "left")


# --- CSV report bodies and control totals ----------------------------------------------------

def header_columns(header_line: str) -> list[str]:
    """Column names of one header line (one bounded line parsed on the driver)."""
    return next(csv.reader(io.StringIO(header_line)))


def report_records(lines: DataFrame, preamble: int = PREAMBLE_LINES, keep: tuple[str, ...] = ()) -> DataFrame:
    """Numbered report lines -> ``(file_path, line, value, malformed)`` and ``keep`` columns (equal on all lines of a file): the
    records behind the preamble as Python's csv reader cuts them, so a quote counts only where a field begins. The header is
    the first of them. ``line`` is a record's first line; ``malformed`` marks one whose quote never closes."""
    body = lines.where(F.col("line") > preamble).select("file_path", "line", "value", *keep)
    return records(classified(body), keep)


def _as_records(frame: DataFrame, preamble: int) -> DataFrame:
    return frame if "malformed" in frame.columns else report_records(frame, preamble)


def report_layout(lines: DataFrame, preamble: int = PREAMBLE_LINES, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(file_path, header)`` and ``keep`` columns, one row per file of :func:`report_records` (or numbered lines): its own
    header, the record behind the preamble."""
    return materialised(_as_records(lines, preamble).groupBy("file_path", *keep).agg(
        F.max(F.when(F.col("line") == preamble + 1, F.col("value"))).alias("header")), "report-layout")


def report_columns(layout: DataFrame) -> list[str]:
    """Names of all columns of all files, in order of first mention (one row per distinct header is read)."""
    headers = layout.where("header is not null").groupBy("header").agg(F.min("file_path").alias("first"))
    names: dict[str, None] = {}
    for r in headers.orderBy("first").collect():
        names.update(dict.fromkeys(header_columns(r["header"])))
    return list(names)


def report_rows(lines: DataFrame, columns: list[str], layout: DataFrame | None = None, preamble: int = PREAMBLE_LINES,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """:func:`report_records` (or numbered lines) -> ``(file_path, line, <columns as strings>, <keep>, malformed)``.

    Each file is read by its own header (``layout``): a column is found by name, wherever the file has it, and is null in
    a file that doesn't have it (of a name that stands twice, the last counts). The header and what stands before it are
    dropped. Quoted line breaks belong to their field; ``line`` is the record's first line. ``malformed`` marks a record whose
    quotes never close.
    """
    lines = _as_records(lines, preamble)
    layout = report_layout(lines, preamble) if layout is None else layout
    # one row per file: each file's places of the wanted columns, from 0, null if it lacks one
    places = layout.withColumn("_names", csv_fields(F.col("header"))).select(F.col("file_path").alias("_file"), F.transform(
        F.array(*[F.lit(c) for c in columns]), lambda c: F.array_max(F.transform("_names", lambda x, i: F.when(x == c, i)))).alias("_at"))
    body = lines.where(F.col("line") > preamble + 1).join(places, F.col("file_path") == F.col("_file"))
    parsed = body.withColumn("_r", csv_fields(F.col("value"), F.col("malformed")))
    return parsed.select("file_path", "line", *[
        F.get("_r", F.get("_at", F.lit(k))).alias(c) for k, c in enumerate(columns)], *keep, "malformed")


def report_body(rows: DataFrame, report_date, columns: list[str]) -> DataFrame:
    """Body rows (``CH = 'SB'``, also those after the footer) stamped with ``report_date``; ``malformed`` stays if it is there."""
    return rows.where(F.col(ROW_TYPE_COL) == BODY).select(
        "file_path", "line", *columns, _col(report_date).alias("report_date"), *[c for c in ("malformed",) if c in rows.columns])


def control_total_check(rows: DataFrame, check_col: str, file_col: str = "file_path",
                        files: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """Per file: SB rows before the first SF row vs. the count in the footer's check column.

    No footer means 0 expected. ``files`` lists every report file (pass the
    numbered lines' files so that a report without body rows is checked too).
    ``strict`` fails the job on the first mismatch (the reference raises).
    Returns ``(file, found, expected, ok, error)``.
    """
    ct = F.col(ROW_TYPE_COL)
    # few columns of the rows, which are parsed once
    typed = materialised(rows.where(ct.isin(BODY, FOOTER)).select(
        file_col, "line", ct, F.when(ct == FOOTER, F.col(check_col)).alias("_text")), "typed-rows")
    footers = typed.where(ct == FOOTER).groupBy(file_col).agg(
        F.min("line").alias("_first_sf"), F.min_by(F.col("_text"), F.col("line")).alias("_check"))
    # one row per file with a footer, computed once: Spark broadcasts it if it is small, so that body
    # rows need no shuffle by file, and else splits a hot file in the join
    footers = materialised(footers, "footers")
    files = (files if files is not None else rows).select(file_col).distinct()
    bodies = typed.where(ct == BODY).select(file_col, "line")
    counted = bodies.join(footers, file_col, "left").where(
        F.col("_first_sf").isNull() | (F.col("line") < F.col("_first_sf"))
    ).groupBy(file_col).agg(F.count(F.lit(1)).alias("found"))
    out = files.join(footers, file_col, "left").join(counted, file_col, "left")
    expected_txt = F.trim(F.col("_check"))
    expected = F.when(F.col("_first_sf").isNull(), F.lit(0)).otherwise(
        F.when(expected_txt.rlike(r"^[+-]?[0-9]+$"), expected_txt.cast("long")))
    found = F.coalesce(F.col("found"), F.lit(0)).cast("long")
    result = out.select(
        F.col(file_col), found.alias("found"), expected.cast("long").alias("expected"),
        (found == expected).alias("ok"),
        F.when(expected.isNull(), F.concat(F.lit("Footer check value is not a number: "),
                                           F.coalesce(F.col("_check"), F.lit("None"))))
        .when(found != expected, F.format_string(
            "%s holds %d body rows before its footer, which says %d",
            F.col(file_col), found, expected)).alias("error"))
    if strict:
        result = result.withColumn("error", F.when(F.col("error").isNotNull(), F.raise_error(F.col("error"))))
    return result


# --- settlement records ---------------------------------------------------------------------

def settlement(df: DataFrame, cells_col: str = "cells") -> DataFrame:
    """23 positional cells -> named columns + ``transaction_type``, ``decimal_amount``, ``decimal_fees``."""
    cells = F.col(cells_col)
    named = [F.get(cells, i).alias(n) for i, n in enumerate(SETTLEMENT_FIELDS)]
    keep = [c for c in df.columns if c != cells_col and c not in SETTLEMENT_FIELDS]
    # NULL cells are an arity error too (size(NULL) differs between ANSI modes)
    out = df.select(*keep, *named, F.coalesce(F.size(cells) == len(SETTLEMENT_FIELDS), F.lit(False)).alias("_arity"))
    return out.select(
        *keep, *SETTLEMENT_FIELDS,
        transaction_type("type").alias("transaction_type"),
        cents_to_decimal("amount", "type").alias("decimal_amount"),
        cents_to_decimal("paypal_fees", "type").alias("decimal_fees"),
        F.when(~F.col("_arity"), F.lit(f"expected {len(SETTLEMENT_FIELDS)} cells"))
         .otherwise(F.coalesce(cents_error("amount", "type"), cents_error("paypal_fees", "type"))).alias("error"),
    )


# --- XML responses --------------------------------------------------------------------------

STATUS_BODY = "reportId string, statusCode string, statusMsg string"
RESPONSE_FIELDS = [
    ("baseResponse", "struct<responseCode: string, responseMsg: string>"),
    ("runReportResponse", f"struct<{STATUS_BODY.replace(' string', ': string')}>"),
    ("getResultsResponse", f"struct<Results: struct<{STATUS_BODY.replace(' string', ': string')}>>"),
    ("getMetaDataResponse", "struct<numberOfRows: string, numberOfPages: string, pageSize: string, "
                            "columnMetaData: array<struct<dataName: string, dataType: string>>>"),
    ("getDataResponse", "struct<reportDataRow: array<struct<columnData: array<struct<data: string>>>>>"),
    ("_corrupt_record", "string"),
]
RESPONSE_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in RESPONSE_FIELDS)
XML_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def parse_response(xml) -> Column:
    """One XML response document -> struct with every response body the API returns."""
    return F.from_xml(_col(xml), RESPONSE_SCHEMA, XML_OPTIONS)


def parse_page(xml) -> Column:
    """:func:`parse_response` of documents that are mostly data pages: the same struct, far less work for plain pages.

    ``from_xml`` builds several maps for every cell of a page. Plain pages are read by ElementTree in Arrow batches instead,
    every other document by ``from_xml``.
    """
    xml = _col(xml)
    page = plain_page(xml)
    parsed = [page[n].alias(n) if n in ("baseResponse", "getDataResponse") else F.lit(None).cast(t).alias(n) for n, t in RESPONSE_FIELDS]
    return F.when(page.isNotNull(), F.struct(*parsed)).otherwise(parse_response(xml))


def _missing(name: str) -> Column:
    return F.lit(MISSING_ELEMENT % name)


def _int_text(c: Column) -> Column:
    t = F.trim(c)
    return F.when(t.rlike(r"^[+-]?[0-9]+$"), t.cast("int"))


def response_ok(r) -> Column:
    """``struct<response_code, response_message, ok, error>`` of the base response."""
    r = _col(r)
    base = r["baseResponse"]
    code, msg = base["responseCode"], base["responseMsg"]
    error = (F.when(r["_corrupt_record"].isNotNull() | r.isNull(), F.lit("malformed XML document"))
             .when(base.isNull(), _missing("baseResponse"))
             .when(code.isNull(), _missing("responseCode"))
             .when(msg.isNull(), _missing("responseMsg"))
             .when(_int_text(code).isNull(), F.concat(F.lit("invalid response code: "), code))
             .when(_int_text(code) != SUCCESS_CODE, F.format_string(
                 "API request failed with code %d: %s", _int_text(code), msg)))
    return F.struct(_int_text(code).alias("response_code"), msg.alias("response_message"),
                    error.isNull().alias("ok"), error.alias("error"))


def report_status(r) -> Column:
    """``struct<report_id, status_code, status_message, error>`` from a run or results response."""
    r = _col(r)
    body = F.coalesce(r["runReportResponse"], r["getResultsResponse"]["Results"])
    error = (F.when(body.isNull(), F.lit(NO_BODY))
             .when(body["reportId"].isNull(), _missing("reportId"))
             .when(body["statusCode"].isNull(), _missing("statusCode"))
             .when(body["statusMsg"].isNull(), _missing("statusMsg"))
             .when(_int_text(body["statusCode"]).isNull(), F.concat(F.lit("invalid status code: "),
                                                                    body["statusCode"])))
    return F.struct(body["reportId"].alias("report_id"), _int_text(body["statusCode"]).alias("status_code"),
                    body["statusMsg"].alias("status_message"), error.alias("error"))


def report_state(code) -> Column:
    """running (1, 2) | ready (3) | failed (> 3) | unknown."""
    c = _col(code)
    return (F.when(c.isin(STATUS_CREATED, STATUS_EXECUTING), F.lit("running"))
            .when(c == STATUS_COMPLETE, F.lit("ready"))
            .when(c > STATUS_COMPLETE, F.lit("failed"))
            .otherwise(F.lit("unknown")))


def report_metadata(r) -> Column:
    """``struct<num_rows, num_pages, page_size, columns array<struct<name, data_type>>, error>``.

    A repeated column name keeps its first position and takes its last type.
    """
    r = _col(r)
    m = r["getMetaDataResponse"]
    cols = F.coalesce(m["columnMetaData"], F.array().cast("array<struct<dataName:string,dataType:string>>"))
    names = F.array_distinct(F.transform(cols, lambda c: c["dataName"]))
    ordered = F.transform(names, lambda n: F.struct(
        n.alias("name"),
        F.element_at(F.filter(cols, lambda c: c["dataName"] == n), -1)["dataType"].alias("data_type")))
    bad_col = F.exists(cols, lambda c: c["dataName"].isNull() | c["dataType"].isNull())
    error = (F.when(m.isNull(), _missing("getMetaDataResponse"))
             .when(m["numberOfRows"].isNull(), _missing("numberOfRows"))
             .when(m["numberOfPages"].isNull(), _missing("numberOfPages"))
             .when(m["pageSize"].isNull(), _missing("pageSize"))
             .when(bad_col, _missing("dataName/dataType")))
    return F.struct(_int_text(m["numberOfRows"]).alias("num_rows"), _int_text(m["numberOfPages"]).alias("num_pages"),
                    _int_text(m["pageSize"]).alias("page_size"), ordered.alias("columns"), error.alias("error"))


def report_page_rows(df: DataFrame, xml_col: str, keep: list[str] | None = None) -> DataFrame:
    """Data page documents -> one row per report row: ``(row_num, cells array<string>, error)``.

    Cells are untyped strings in document order; an empty ``<data/>`` is ``''``,
    a missing ``<data>`` is a malformed response. Each document is parsed once
    (page-level checks happen before the rows are exploded).
    """
    keep = keep or []
    parsed = df.select(*keep, parse_page(xml_col).alias("_r"))
    r = F.col("_r")
    rows = F.coalesce(r["getDataResponse"]["reportDataRow"],
                      F.array().cast("array<struct<columnData:array<struct<data:string>>>>"))
    page = parsed.select(*keep, F.coalesce(response_ok(r)["error"], F.when(
        r["getDataResponse"].isNull(), _missing("getDataResponse"))).alias("_page_err"), rows.alias("_rows"))
    exploded = page.select(*keep, "_page_err", F.posexplode_outer("_rows").alias("_pos", "_row"))
    cells = F.transform(F.coalesce(F.col("_row")["columnData"], F.array().cast("array<struct<data:string>>")),
                        lambda c: c["data"])
    return exploded.select(
        *keep, (F.col("_pos") + 1).cast("long").alias("row_num"), cells.alias("cells"),
        F.coalesce(F.col("_page_err"),
                   F.when(F.exists(cells, lambda x: x.isNull()), _missing("data"))).alias("error"))


def parse_once(df: DataFrame, xml_col: str, keep: list[str] | None = None, alias: str = "_r", pages: bool = False) -> DataFrame:
    """Project the parsed response once so later expressions share it (``pages``: most documents are data pages)."""
    return df.select(*(keep or []), (parse_page if pages else parse_response)(xml_col).alias(alias))
