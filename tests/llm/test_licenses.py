import re

from pyspark.sql import functions as F

from sluice.llm import licenses, queries
from tests.llm.conftest import edge_rows


def scanned(spark, texts):
    return [r["license"] for r in licenses.scan(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).orderBy("doc_id").collect()]


def test_canonical_forms_match(spark):
    mit = licenses._MIT
    texts = ["MIT License\n\nCopyright (c) 2020 Some One\n\n" + mit, mit.upper(), re.sub(r"\s+", "\n  ", mit), mit.replace(",", " ;").replace('"', "''"),
             "The MIT Licence\n(c) 1999 A. Person\n© 2001 more\n" + mit, licenses._ISC + "\n", licenses._ZERO_BSD, licenses._ZLIB, "  all rights reserved ",
             licenses._APACHE_NOTICE.replace("http://", "https://")]
    assert scanned(spark, texts) == ["MIT", "MIT", "MIT", "MIT", "MIT", "ISC", "0BSD", "Zlib", "LicenseRef-reserved", "Apache-2.0"]


def test_near_texts_do_not_match(spark):
    assert scanned(spark, [licenses._MIT + " more", licenses._MIT[:-9], "", None, "...", "MIT"]) == [None] * 6


def test_notices(spark):
    text = "Prose first.\nReleased under the MIT  License!\nprose\nALL RIGHTS RESERVED\n"
    rows = licenses.notices(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["line"], r["license"]) for r in rows) == [(1, 2, "MIT"), (1, 4, "LicenseRef-reserved")]


def test_edges(edge, empty):
    out = licenses.scan(edge)
    assert out.count() == len(edge_rows())
    assert out.where("doc_id = 1").first()["digest"] is None
    assert licenses.scan(empty).collect() == [] and licenses.notices(empty).collect() == []
    assert licenses.known_digests(edge.sparkSession).count() <= len(licenses.KNOWN)


def test_no_python_in_the_plan(spark, tables):
    plan = queries.op9_license_scan(spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan) and F is not None


def test_licences_as_source_files_carry_them(spark):
    mit = licenses._MIT
    commented = lambda lead, first="", last="": first + "".join(f"{lead}{x}\n" for x in ("Copyright (c) 2020 A. Person", "", *mit.split("\n"))) + last
    texts = ["Copyright Jane Doe\n" + mit, commented("# "), commented(" * ", "/*\n", " */\n"), commented("// "), commented(";; "), commented("-- "),
             "Copyright (c) 2001 X\nPortions Copyright (c) 2003 Y\nPortions Copyright Some Body\n" + mit, mit.replace('"Software"', "“Software”").replace('"AS IS"', "“AS IS”"),
             mit.replace("NONINFRINGEMENT", "NON-\nINFRINGEMENT"), mit.replace("sublicense", "sub  \n license"), mit.replace("and/or", "and&or").replace("and&or", "and/or"),
             "/* COPYRIGHT: The Authors */\n" + mit, commented("# ").replace("NONINFRINGEMENT", "NON-\n# INFRINGEMENT")]
    assert scanned(spark, texts) == ["MIT"] * len(texts)


def test_wrapped_words_of_a_licence_stay(spark):
    # lines of a licence that begin with its own words about copyright are no notices
    mit = licenses._MIT.replace("The above copyright notice", "The above\ncopyright notice").replace("AUTHORS OR\nCOPYRIGHT HOLDERS", "AUTHORS OR\n\nCOPYRIGHT HOLDERS")
    assert scanned(spark, [mit, mit.replace("copyright notice and", "")]) == ["MIT", None]
    rows = spark.createDataFrame([("Copyright Holder means you\nx",), ("Copyright Act 1999\nx",), ("copyright 1999\nx",)], "t string")
    assert [r[0] for r in rows.select(licenses.canonical(F.col("t"))).collect()] == ["copyright holder means you x", "copyright act 1999 x", "x"]
