import re

from sluice.llm import licenses
from tests.llm.test_licenses import scanned


def published(name):
    return (licenses.TEXTS / f"{name}.txt").read_text(encoding="utf-8")


def test_whole_texts_are_known(spark):
    names = sorted(p.stem for p in licenses.TEXTS.glob("*.txt"))
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Unlicense"} <= set(names)
    assert scanned(spark, [published(n) for n in names]) == [n.split("~")[0] for n in names]
    assert scanned(spark, [re.sub(r"\s+", "\n ", published(n)) for n in ("Unlicense", "BSL-1.0")]) == ["Unlicense", "BSL-1.0"]


def test_usual_forms(spark):
    bsd, apache, gpl = published("BSD-3-Clause"), published("Apache-2.0"), published("GPL-2.0")
    body = bsd[bsd.index("Redistribution and use"):]
    texts = ["New BSD License\n\nCopyright (c) 2011 A. Person\n" + body, body.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* "),
             apache.replace("[yyyy] [name of copyright owner]", "2019 Some One"), apache[:apache.index("APPENDIX")], apache.replace("[yyyy]", "{yyyy}"),
             gpl[:gpl.index("How to Apply These")], gpl.replace("51 Franklin Street, Fifth Floor,", "59 Temple Place, Suite 330,").replace("02110-1301", "02111-1307"),
             "MIT License\n\nCopyright (c) 2020 X\nAll rights reserved.\n\n" + licenses._MIT, published("MPL-2.0")[:-200], body[:-30]]
    assert scanned(spark, texts) == ["BSD-3-Clause", "BSD-3-Clause", "Apache-2.0", "Apache-2.0", "Apache-2.0", "GPL-2.0", "GPL-2.0", "MIT", None, None]


def test_notices_over_names_and_versions(spark):
    lines = ["Licensed under the GNU Lesser General Public License, version 2.1.", "This software is released under the BSD 3-Clause License.",
             "Licensed under CC BY-SA 3.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
             "SPDX-License-Identifier: GPL-2.0-or-later", "Licensed under the Mozilla Public License 2.0", "Released under the GNU GPLv3 or later.",
             "This work is licensed under the GNU General Public License, version 2.", "Licensed under the plan, version 2."]
    rows = licenses.notices(spark.createDataFrame([(1, "\n".join(lines))], "doc_id long, text string")).orderBy("line").collect()
    assert [(r["line"], r["license"]) for r in rows] == [(1, "LGPL-2.1"), (2, "BSD-3-Clause"), (3, "CC-BY-SA-3.0"), (4, "CC-BY-4.0"), (5, "GPL-2.0-or-later"),
                                                         (6, "MPL-2.0"), (7, "GPL-3.0-or-later"), (8, "GPL-2.0")]


def test_no_digest_stands_for_two_licences(spark):
    rows = spark.createDataFrame(list(licenses.KNOWN), "license string, kind string, text string").select(licenses.digest("text").alias("d"), "license")
    assert rows.groupBy("d").agg({"license": "count"}).count() == rows.distinct().count()
