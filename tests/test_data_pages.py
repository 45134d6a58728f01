import pyarrow as pa
from pyspark.sql import functions as F

from sluice.operators import datapages
from sluice.operators import reports as R
from sluice.operators.batching import global_rank
from sluice.operators.datapages import page_cells

HEAD = "<baseResponse><responseCode>100</responseCode><responseMsg>all well</responseMsg></baseResponse>"


def _cells(*values):
    return "".join(f"<columnData><data>{v}</data></columnData>" for v in values)


def _page(rows, head=HEAD, root="reportingEngineResponse"):
    return f"<{root}>{head}<getDataResponse>{rows}</getDataResponse></{root}>"


ROW = f"<reportDataRow>{_cells('1', 'x y')}</reportDataRow>"
PLAIN = {
    "rows": _page(ROW + f"<reportDataRow>{_cells('2', 'ü', '𝄞', '007')}</reportDataRow>"),
    "empty data": _page("<reportDataRow><columnData><data/></columnData><columnData><data></data></columnData></reportDataRow>"),
    "no data": _page("<reportDataRow><columnData></columnData><columnData/></reportDataRow>" + ROW),
    "declaration": '<?xml version="1.0" encoding="UTF-8"?>\n' + _page(ROW),
    "blanks between": _page(f"\n  <reportDataRow>\r\n\t{_cells('1', 'a b')} </reportDataRow>\n", f"\n {HEAD} \n"),
    "blanks around data": _page("<reportDataRow><columnData> <data>q</data>\n</columnData></reportDataRow>"),
    "entities": _page(f"<reportDataRow>{_cells('a &amp; b', '&lt;c&gt;', '&#65;&#x42;', '&quot;', 'x &amp;', '&amp; y')}</reportDataRow>"),
    "signs": _page(f"<reportDataRow>{_cells('a=b', 'c:d!', 'e?', 'f>g', 'it&apos;s')}</reportDataRow>"),
    "wide blank": _page(f"<reportDataRow>{_cells(chr(0xa0) + 'x' + chr(0x2003), 'l1' + chr(10) + 'l2', 'r1' + chr(13) + 'r2')}</reportDataRow>"),
    "failed": _page(ROW, HEAD.replace("100", "107").replace("all well", "")),
}
OTHER = {
    "attribute": _page(ROW.replace("<data>", '<data k="v">', 1)),
    "attribute of the row": _page(ROW.replace("<reportDataRow>", "<reportDataRow data='v'>", 1)),
    "attribute of the root": _page(ROW).replace("<reportingEngineResponse>", "<reportingEngineResponse corrupt_record='v'>"),
    "namespace": _page(ROW).replace("<reportingEngineResponse>", '<reportingEngineResponse xmlns="urn:x">'),
    "prefix": '<p:r xmlns:p="urn:x">' + HEAD + "</p:r>",
    "comment": _page(ROW.replace("<data>", "<data><!-- c -->", 1)),
    "comment between": _page("<!-- c -->" + ROW),
    "cdata": _page(f"<reportDataRow>{_cells('<![CDATA[<b>]]>')}</reportDataRow>"),
    "instruction": _page("<?go now?>" + ROW),
    "doctype": "<!DOCTYPE r>" + _page(ROW, root="r"),
    "other case": _page(ROW.replace("data>", "DATA>")),
    "unknown in row": _page("<reportDataRow><other>1</other>" + _cells("1") + "</reportDataRow>"),
    "unknown in data": _page(f"<reportDataRow>{_cells('<i>1</i>')}</reportDataRow>"),
    "unknown in response": _page("<total>1</total>" + ROW),
    "two data": _page("<reportDataRow><columnData><data>1</data><data>2</data></columnData></reportDataRow>"),
    "text between": _page(ROW + "loose" + ROW),
    "text beside data": _page("<reportDataRow><columnData>t<data>1</data>u</columnData></reportDataRow>"),
    "text for data": _page("<reportDataRow><columnData>t</columnData></reportDataRow>"),
    "blank for data": _page("<reportDataRow><columnData> </columnData></reportDataRow>"),
    "blanks in data": _page(f"<reportDataRow>{_cells(' 1 ', '  ', '&#32;z')}</reportDataRow>"),
    "row without columns": _page("<reportDataRow></reportDataRow><reportDataRow/>"),
    "no rows": _page(""),
    "responses turned": f"<r><getDataResponse>{ROW}</getDataResponse>{HEAD}</r>",
    "two bases": _page(ROW, HEAD + HEAD.replace("100", "104")),
    "no message": _page(ROW, "<baseResponse><responseCode>100</responseCode></baseResponse>"),
    "no base": _page(ROW, ""),
    "status": f"<r>{HEAD}<runReportResponse><reportId>R</reportId><statusCode>1</statusCode></runReportResponse></r>",
    "open": _page(ROW)[:-5],
    "wrong end": _page(ROW.replace("</data>", "</dat>", 1)),
    "cdata end in text": _page(f"<reportDataRow>{_cells('a]]>b')}</reportDataRow>"),
    "control character": _page(f"<reportDataRow>{_cells(chr(1))}</reportDataRow>"),
    "not a character": _page(f"<reportDataRow>{_cells(chr(0xfffe))}</reportDataRow>"),
    "unknown entity": _page(f"<reportDataRow>{_cells('&nope;')}</reportDataRow>"),
    "text behind": _page(ROW) + "behind",
    "second root": _page(ROW) + "<again/>",
    "other version": '<?xml version="1.1"?>' + _page(ROW),
    "other encoding": '<?xml version="1.0" encoding="ISO-8859-1"?>' + _page(f"<reportDataRow>{_cells('ü')}</reportDataRow>"),
    "not xml": "nothing", "empty": "", "null": None,
}


def test_pages_are_read_as_from_xml_reads_them(spark):
    docs = spark.createDataFrame([(k, d) for k, d in {**PLAIN, **OTHER}.items()], "k string, x string")
    got = docs.select("k", "x", R.parse_page("x").alias("got"))
    assert got.schema["got"].dataType == docs.select(R.parse_response("x").alias("r")).schema["r"].dataType
    expected = {r["k"]: r["r"] for r in docs.select("k", R.parse_response("x").alias("r")).collect()}
    found = {r["k"]: r["got"] for r in got.collect()}
    assert len(found) == len(PLAIN) + len(OTHER)
    assert {k: v for k, v in found.items() if v != expected[k]} == {}


def test_broken_bytes_are_left_to_from_xml(spark):
    doc = _page(f"<reportDataRow>{_cells('a?b')}</reportDataRow>").encode().replace(b"a?b", b"a\xffb")
    got = spark.createDataFrame([(bytearray(doc),)], "b binary").selectExpr("cast(b as string) as x").select(R.parse_page("x").alias("r")).first()["r"]
    assert got.getDataResponse.reportDataRow[0].columnData[0].data == "a\ufffdb"


def test_only_other_documents_need_from_xml():
    assert [k for k, d in PLAIN.items() if page_cells(d) is None] == []
    assert [k for k, d in OTHER.items() if d is not None and page_cells(d) is not None] == []
    assert page_cells(PLAIN["no data"]) == ("100", "all well", [[None, None], ["1", "x y"]])


def test_queries_of_pages_leave_plain_ones_to_arrow(spark):
    docs = spark.createDataFrame([(k, d) for k, d in PLAIN.items()], "k string, x string")
    scan = R.parse_once(docs, "x", ["k"], pages=True).select("k", F.size("_r.getDataResponse.reportDataRow").alias("n"), R.response_ok("_r")["ok"])
    for frame in (scan, R.report_page_rows(docs, "x", ["k"])):
        assert frame._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert {r["k"]: r["n"] for r in scan.collect()} == {k: len(page_cells(d)[2]) for k, d in PLAIN.items()}


def test_rank_keeps_named_columns_and_needs_no_shuffle_of_the_rows(spark):
    rows = spark.range(5000).select((F.col("id") * 7 % 5000).alias("k"), F.repeat(F.lit("x"), 50).alias("t"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")  # far below the written rows, as large tables are
    try:
        ranked = global_rank(rows, ["k"], "rank", partitions=6, keep=["k"])
        plan = ranked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert ranked.columns == ["k", "rank"]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert all(r["rank"] == r["k"] + 1 for r in ranked.collect())


def test_pages_of_several_slices_keep_their_order(monkeypatch):
    docs = list(OTHER.values()) + list(PLAIN.values()) + [None]
    whole = datapages._plain_pages(pa.array(docs, pa.string()))
    monkeypatch.setattr(datapages, "AT_A_TIME", 3)
    assert datapages._plain_pages(pa.array(docs, pa.string())).equals(whole)
    assert [d["baseResponse"] is not None if d else False for d in whole.to_pylist()] == [d in PLAIN.values() for d in docs]
    assert len(datapages._plain_pages(pa.array([], pa.string()))) == 0
