from pyspark.sql import functions as F

from sluice.operators import reports as R
from sluice.operators.sitemap import sitemap_index_urls, sitemap_urls
from sluice.sources.files import numbered_lines

BASE = "<baseResponse><responseCode>{code}</responseCode><responseMsg>{msg}</responseMsg></baseResponse>"


def doc(body, code="100", msg="ok"):
    return f"<reportingEngineResponse>{BASE.format(code=code, msg=msg)}{body}</reportingEngineResponse>"


def test_status_and_state(spark):
    docs = [doc("<runReportResponse><reportId>RE1</reportId><statusCode>1</statusCode><statusMsg>Created"
                "</statusMsg></runReportResponse>"),
            doc("<getResultsResponse><Results><reportId>RE2</reportId><statusCode>3</statusCode><statusMsg>Done"
                "</statusMsg></Results></getResultsResponse>"),
            doc("<runReportResponse><reportId>RE3</reportId><statusCode>5</statusCode></runReportResponse>"),
            doc("<runReportResponse><reportId>RE4</reportId><statusCode>2</statusCode><statusMsg>x</statusMsg>"
                "</runReportResponse>", code="104", msg="Invalid")]
    df = spark.createDataFrame([(d,) for d in docs], "x string")
    p = R.parse_once(df, "x")
    rows = p.select(R.report_status("_r").alias("s"), R.response_ok("_r").alias("b")).select(
        "s.*", R.report_state("s.status_code").alias("state"), "b.ok", F.col("b.error").alias("berr")).collect()
    assert [(r["report_id"], r["status_code"], r["state"]) for r in rows] == [
        ("RE1", 1, "running"), ("RE2", 3, "ready"), ("RE3", 5, "failed"), ("RE4", 2, "running")]
    assert rows[2]["error"] == 'The required element "statusMsg" was not found in the API response'
    assert rows[3]["ok"] is False and rows[3]["berr"] == "API request failed with code 104: Invalid"


def test_metadata_and_pages(spark):
    meta = doc("<getMetaDataResponse><numberOfRows>102</numberOfRows><numberOfPages>3</numberOfPages>"
               "<pageSize>50</pageSize>"
               "<columnMetaData><dataName>a</dataName><dataType>int</dataType></columnMetaData>"
               "<columnMetaData><dataName>b</dataName><dataType>string</dataType></columnMetaData>"
               "<columnMetaData><dataName>a</dataName><dataType>char</dataType></columnMetaData>"
               "</getMetaDataResponse>")
    m = R.parse_once(spark.createDataFrame([(meta,)], "x string"), "x").select(
        R.report_metadata("_r").alias("m")).first()["m"]
    assert (m["num_rows"], m["num_pages"], m["page_size"]) == (102, 3, 50)
    assert [(c["name"], c["data_type"]) for c in m["columns"]] == [("a", "char"), ("b", "string")]
    page = doc("<getDataResponse><reportDataRow><columnData><data>1</data></columnData><columnData><data/>"
               "</columnData><columnData><data>z</data></columnData></reportDataRow><reportDataRow><columnData>"
               "<data>2</data></columnData><columnData><data>y</data></columnData><columnData><data>w</data>"
               "</columnData></reportDataRow></getDataResponse>")
    missing = doc("<getDataResponse><reportDataRow><columnData></columnData></reportDataRow></getDataResponse>")
    rows = R.report_page_rows(spark.createDataFrame([(1, page), (2, missing)], "p int, x string"), "x",
                              keep=["p"]).orderBy("p", "row_num").collect()
    assert [r["cells"] for r in rows[:2]] == [["1", "", "z"], ["2", "y", "w"]]
    assert rows[0]["error"] is None and "data" in rows[2]["error"]


def test_settlement(spark):
    cells = ["T1", "t", "Credit", "C", "", "", "5000"] + [""] * 7 + ["140"] + [""] * 8
    s = R.settlement(spark.createDataFrame([(cells,)], "cells array<string>"), "cells").first()
    assert (s["transaction_type"], str(s["decimal_amount"]), str(s["decimal_fees"])) == ("refund", "-50.00", "-1.40")
    short = R.settlement(spark.createDataFrame([(cells[:5],)], "cells array<string>"), "cells").first()
    assert short["error"] == "expected 23 cells"


def test_report_file_pick(spark):
    names = ["TRR-20201209.01.009_TEST.CSV", "TRR-20201209.01.009.CSV", "TRR-20210114.01.009.CSV",
             "TRR-20210115.01.011.CSV"]
    files = spark.createDataFrame([(n,) for n in names], "name string")
    dates = spark.createDataFrame([("2020-12-09",), ("2021-01-15",), ("2021-02-01",)], "d string").select(
        F.to_date("d").alias("report_date"))
    got = {str(r["report_date"]): r["name"] for r in R.report_file_pick(files, "TRR", dates).collect()}
    assert got == {"2020-12-09": "TRR-20201209.01.009.CSV", "2021-01-15": "TRR-20210115.01.011.CSV",
                   "2021-02-01": None}


def _write(path, name, lines):
    import os
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_control_totals_and_body(spark, tmp):
    head = ["free 1", "free 2", "free 3", "CH,id,note,Count"]
    _write(tmp, "ok.csv", head + ["SB,1,a,", "SB,2,\"b, c\",", "XX,3,x,", "SF,,,2"])
    _write(tmp, "few.csv", head + ["SB,1,a,", "SF,,,2"])
    _write(tmp, "nofooter.csv", head)
    _write(tmp, "late.csv", head + ["SB,1,a,", "SF,,,1", "SB,2,b,", "SF,,,9"])
    lines = numbered_lines(spark, tmp)
    cols = R.report_columns(R.report_layout(lines))
    rows = R.report_rows(lines, cols)
    res = {r["file_path"].rsplit("/", 1)[1]: r for r in R.control_total_check(rows, "Count", files=lines).collect()}
    assert (res["ok.csv"]["found"], res["ok.csv"]["expected"], res["ok.csv"]["ok"]) == (2, 2, True)
    assert res["few.csv"]["ok"] is False and "holds 1 body rows before its footer, which says 2" in res["few.csv"]["error"]
    assert (res["nofooter.csv"]["expected"], res["nofooter.csv"]["ok"]) == (0, True)
    assert (res["late.csv"]["found"], res["late.csv"]["expected"]) == (1, 1)
    body = R.report_body(rows, F.lit("2020-12-09"), cols).where(F.col("file_path").endswith("ok.csv"))
    assert sorted(r["note"] for r in body.collect()) == ["a", "b, c"]
    late = R.report_body(rows, F.lit("d"), cols).where(F.col("file_path").endswith("late.csv")).count()
    assert late == 2  # body rows after the footer are kept


def test_sitemaps(spark):
    index = ('<?xml version="1.0" encoding="UTF-8"?><sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
             "<sitemap><loc> https://x.org/sitemap-0.xml </loc></sitemap>"
             "<sitemap><loc>https://x.org/sitemap-1.xml</loc><lastmod>2020</lastmod></sitemap></sitemapindex>")
    urlset = ('<s:urlset xmlns:s="http://www.sitemaps.org/schemas/sitemap/0.9"><s:url><s:loc>https://x.org/a?b=1&amp;c=2'
              "</s:loc><s:priority>1</s:priority></s:url><s:url><s:loc>https://x.org/b</s:loc></s:url>"
              "<s:url><s:loc>\n https://x.org/c\n</s:loc></s:url></s:urlset>")
    idx = sitemap_index_urls(spark.createDataFrame([(index,)], "doc string")).orderBy("pos").collect()
    assert [r["url"] for r in idx] == ["https://x.org/sitemap-0.xml", "https://x.org/sitemap-1.xml"]
    df = spark.createDataFrame([(urlset, "https://x.org/sitemap-0.xml")], "doc string, src string")
    rows = sitemap_urls(df, "doc", "2020-01-01", source_url_col="src").orderBy("pos").collect()
    assert [r["url"] for r in rows] == ["https://x.org/a?b=1&c=2", "https://x.org/b", "https://x.org/c"]
    assert {r["sitemap"] for r in rows} == {"sitemap-0"} and {r["scraped_at"] for r in rows} == {"2020-01-01"}
    broken = sitemap_urls(spark.createDataFrame([("<urlset><url>",)], "doc string"), "doc", "d").first()
    assert broken["error"] == "malformed XML document"


def test_control_totals_strict(spark, tmp):
    import pytest

    head = ["a", "b", "c", "CH,id,Count"]
    _write(tmp, "bad.csv", head + ["SB,1,", "SF,,5"])
    lines = numbered_lines(spark, tmp)
    rows = R.report_rows(lines, ["CH", "id", "Count"])
    with pytest.raises(Exception, match="holds 1 body rows before its footer, which says 5"):
        R.control_total_check(rows, "Count", files=lines, strict=True).collect()


def test_each_report_has_its_own_header_and_line_breaks(spark, tmp):
    head = ["a", "b", "c"]
    _write(tmp, "one.csv", head + ["CH,k,n,Count", 'SB,"two', 'lines",7,', 'SB,x,8,', 'SB,"a ""q"" b",9,', "SF,,,3"])
    _write(tmp, "two.csv", head + ["CH,Count,n,k,more", "SB,,1,y,z", "SF,1,,,"])
    _write(tmp, "open.csv", head + ["CH,k,n,Count", 'SB,"never', "closed"])
    lines = numbered_lines(spark, tmp)
    layout = R.report_layout(lines)
    assert R.report_columns(layout) == ["CH", "k", "n", "Count", "more"]
    rows = R.report_rows(lines, ["CH", "k", "n", "more", "Count"], layout)
    got = sorted((r["file_path"].rsplit("/", 1)[1], r["line"], r["k"], r["n"], r["more"]) for r in rows.where("CH = 'SB' and not malformed").collect())
    assert got == [("one.csv", 5, "two\nlines", "7", None), ("one.csv", 7, "x", "8", None), ("one.csv", 8, 'a "q" b', "9", None),
                   ("two.csv", 5, "y", "1", "z")]
    assert [(r["file_path"].rsplit("/", 1)[1], r["line"]) for r in rows.where("malformed").collect()] == [("open.csv", 5)]
    ok = {r["file_path"].rsplit("/", 1)[1]: r["ok"] for r in R.control_total_check(rows, "Count", files=lines).collect()}
    assert ok["one.csv"] and ok["two.csv"]


def test_sitemaps_without_entries_have_no_rows(spark):
    docs = spark.createDataFrame([(1, "<urlset/>"), (2, "<html><p>x</p></html>"), (3, "<urlset><url><loc/></url><url/></urlset>"), (4, None), (5, "<urlset><url><loc> u </loc></url></urlset>")],
                                 "k int, doc string")
    got = sorted((r["k"], r["pos"] or 0, r["url"], r["error"]) for r in sitemap_urls(docs, "doc", "d", keep=["k"]).collect())
    missing = "<url> entry without text in <loc>"
    assert got == [(3, 1, None, missing), (3, 2, None, missing), (4, 0, None, "malformed XML document"), (5, 1, "u", None)]
