"""Cells of data page documents, read by ElementTree in Arrow batches."""

from __future__ import annotations

import re
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

BASE = "struct<responseCode: string, responseMsg: string>"
ROWS = "array<struct<columnData: array<struct<data: string>>>>"
PAGE = f"struct<baseResponse: {BASE}, getDataResponse: struct<reportDataRow: {ROWS}>>"

# pages whose cells are Python strings at one time
AT_A_TIME = 500

_BLANK = " \t\r\n"
_NO_BLANKS = dict.fromkeys(map(ord, _BLANK))
_DECLARATION = re.compile(r'<\?xml version="1\.0"(?: encoding="(?:UTF|utf)-8")?\?>')
# a tag with an attribute or prefix; comments, CDATA, document types and instructions
_SIGNS = "=:!?"
_NOT_PLAIN = re.compile(f"<[^>]*[{_SIGNS}]")


def _trimmed(text: str) -> bool:
    return text.strip(_BLANK) == text


def _leaf(element) -> str | None:
    """Text of an element that has no children and no blanks around its text."""
    text = element.text or ""
    return text if not len(element) and _trimmed(text) else None


def page_cells(doc: str) -> tuple[str, str, list[list[str | None]]] | None:
    """Response code, message and rows of cells (None: a column without data) of a plain data page.

    Plain is a document of one base response and one data response, with their elements in order and nothing but blanks
    between them: no attributes, prefixes, comments, CDATA, repeated or unknown elements. None for any other text.
    """
    found = _DECLARATION.match(doc)
    doc = doc[found.end():] if found else doc
    if any(sign in doc for sign in _SIGNS) and _NOT_PLAIN.search(doc):
        return None
    try:
        root = ElementTree.fromstring(doc)
    except ElementTree.ParseError:
        return None
    if [e.tag for e in root] != ["baseResponse", "getDataResponse"] or [e.tag for e in root[0]] != ["responseCode", "responseMsg"]:
        return None
    code, message = _leaf(root[0][0]), _leaf(root[0][1])
    if code is None or message is None or not len(root[1]):
        return None
    rows, texts = [], []
    for row in root[1]:
        if row.tag != "reportDataRow" or not len(row):
            return None
        cells = []
        for column in row:
            if column.tag != "columnData":
                return None
            if len(column) == 1:
                data = column[0]
                if data.tag != "data" or len(data):
                    return None
                text = data.text or ""
                cells.append(text)
                texts.append(text)
            elif len(column) or column.text:
                return None
            else:
                cells.append(None)
        rows.append(cells)
    inside = "".join(texts)
    if any(blank in inside for blank in _BLANK) and not all(map(_trimmed, texts)):
        return None
    everything, inside = "".join(root.itertext()), code + message + inside
    if everything != inside and everything.translate(_NO_BLANKS) != inside.translate(_NO_BLANKS):
        return None
    return code, message, rows


def _page(doc: pa.Scalar) -> tuple[str, str, list[list[str | None]]] | None:
    try:
        return page_cells(doc.as_py()) if doc.is_valid else None
    except UnicodeDecodeError:  # from_xml reads broken bytes as U+FFFD
        return None


def _plain_pages(docs: pa.Array) -> pa.Array:
    return pa.concat_arrays([_pages(docs.slice(at, AT_A_TIME)) for at in range(0, max(1, len(docs)), AT_A_TIME)])


def _pages(docs: pa.Array) -> pa.Array:
    codes, messages, cells, plain = [], [], [], []
    row_ends, page_ends = [0], [0]
    for doc in docs:
        page = _page(doc)
        code, message, rows = page or (None, None, [])
        plain.append(page is not None)
        codes.append(code)
        messages.append(message)
        for row in rows:
            cells.extend(row)
            row_ends.append(len(cells))
        page_ends.append(len(row_ends) - 1)
    columns = pa.ListArray.from_arrays(pa.array(row_ends, pa.int32()), pa.StructArray.from_arrays([pa.array(cells, pa.string())], ["data"]))
    rows = pa.ListArray.from_arrays(pa.array(page_ends, pa.int32()), pa.StructArray.from_arrays([columns], ["columnData"]))
    base = pa.StructArray.from_arrays([pa.array(codes, pa.string()), pa.array(messages, pa.string())], ["responseCode", "responseMsg"])
    data = pa.StructArray.from_arrays([rows], ["reportDataRow"])
    return pa.StructArray.from_arrays([base, data], ["baseResponse", "getDataResponse"],
                                      mask=pa.array([not p for p in plain], pa.bool_()))


def plain_page(xml: Column) -> Column:
    """``struct<baseResponse, getDataResponse>`` of a plain data page document (:func:`page_cells`), null for any other."""
    return arrow_udf(_plain_pages, PAGE)(xml)
