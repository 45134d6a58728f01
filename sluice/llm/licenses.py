"""License scans: canonical texts, their digests, and a hash join with the digests of known licences."""

from __future__ import annotations

import re
from functools import reduce
from itertools import product
from operator import or_
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings that license matching treats as equal: written form, canonical form, in canonical text (no punctuation, single blanks). Applied in
#: this order.
EQUIVALENT = (
    ("licence", "license"), ("sub license", "sublicense"), ("organisation", "organization"), ("favour", "favor"), ("judgement", "judgment"),
    ("merchantibility", "merchantability"), ("non infringement", "noninfringement"), ("copyright owner", "copyright holder"), ("https ", "http "),
)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
_ZERO_BSD = _ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License."""

#: Whole texts as published, one file a text; what follows "~" in a file's name tells editions of one licence apart.
TEXTS = Path(__file__).with_name("license_texts")
#: Addresses of the Free Software Foundation that editions of its older licences give.
_ADDRESS = r"51 Franklin St(reet)?, Fifth Floor,\s+Boston,\s+MA\s+02110-1301,?\s+USA"
_ADDRESSES = ("59 Temple Place, Suite 330, Boston, MA 02111-1307 USA", "59 Temple Place - Suite 330, Boston, MA 02111-1307, USA",
              "675 Mass Ave, Cambridge, MA 02139, USA", "51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA")
#: Usual titles of texts that are published without one, or with one that is often left out.
_TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"), "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD", "0BSD"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng license"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License", "FreeBSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License",
                     "Modified BSD License", "BSD License"),
    "Unlicense": ("The Unlicense", "Unlicense"), "BSL-1.0": ("Boost Software License 1.0",),
}


def _short(name: str, body: str) -> list[str]:
    """A text under each of its usual titles and under none, and with the line that often ends its copyright notice."""
    return [f"{title}\n{reserved}{body}" for title in ("", *_TITLES[name]) for reserved in ("", "All rights reserved.\n")]


def _bsd(body: str) -> list[str]:
    """Usual wordings of a BSD text: conditions with numbers or marks, and who disclaims."""
    out = []
    for mark, (many, one), name in product(
            (r"\1. ", "* "),
            (("COPYRIGHT HOLDERS AND", "COPYRIGHT HOLDER OR"), ("COPYRIGHT HOLDERS AND", "COPYRIGHT HOLDERS OR"), ("AUTHOR AND", "AUTHOR OR"),
             ("REGENTS AND", "REGENTS OR")),
            ("the copyright holder", "the University", "the author")):
        text = re.sub(r"(?m)^([123])\. ", mark, body)
        text = re.sub(r"COPYRIGHT\s+HOLDERS\s+AND", many, re.sub(r"COPYRIGHT\s+HOLDER\s+OR", one, text))
        out.append(re.sub(r"name\s+of\s+the\s+copyright\s+holder", f"name of {name}", text))
    return list(dict.fromkeys(out))


def _editions(name: str, text: str) -> list[str]:
    """Usual forms of one published text."""
    if name.startswith("BSD-"):
        body = text[text.index("Redistribution and use"):]
        return [x for b in _bsd(body) for x in _short(name, b)]
    if name in _TITLES:
        return _short(name, text)
    whole = [text] + ([re.sub(_ADDRESS, x, text) for x in _ADDRESSES] if re.search(_ADDRESS, text) else [])
    out = list(whole)
    for x in whole:
        # the terms alone: without the advice on applying them, with or without the line that ends them
        end = re.search(r"(?i)END OF TERMS AND CONDITIONS", x)
        if end:
            out += [x[:end.end()], x[:end.start()]]
        # a copyright line that was filled in goes in the canonical form; the published one stays there
        if name == "Apache-2.0":
            out.append(re.sub(r"(?m)^[ \t]*Copyright \[yyyy\][^\n]*", "", x))
        if name.startswith("CC-"):
            out += [x[x.index("Creative Commons Attribution"):], re.sub(r"(?s)^.*?=+\s*Creative Commons Attribution", "Creative Commons Attribution", x)]
    head = {"CC0-1.0": "Creative Commons Legal Code"}.get(name)
    if head:
        out += [x.replace(head, "", 1) for x in out]
    return out


def _whole_texts() -> list[tuple[str, str, str]]:
    rows = [(name, "text", x) for name, body in (("MIT", _MIT), ("ISC", _ISC), ("0BSD", _ZERO_BSD), ("Zlib", _ZLIB)) for x in _short(name, body)]
    for path in sorted(TEXTS.glob("*.txt")):
        name = path.stem.split("~")[0]
        rows += [(name, "text", x) for x in dict.fromkeys(_editions(name, path.read_text(encoding="utf-8")))]
    return rows


_GNU = {"GPL": ("General Public License", ("1.0", "2.0", "3.0")), "LGPL": ("Lesser General Public License", ("2.1", "3.0")),
        "AGPL": ("Affero General Public License", ("3.0",)), "GFDL": ("Free Documentation License", ("1.1", "1.2", "1.3"))}
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
       "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_NAMED = {"MIT": ("MIT",), "ISC": ("ISC",), "0BSD": ("Zero-Clause BSD", "BSD Zero Clause"), "Zlib": ("zlib",), "Unlicense": ("Unlicense",),
          "BSD-2-Clause": ("BSD 2-Clause", "2-Clause BSD", "Simplified BSD"), "BSD-3-Clause": ("BSD 3-Clause", "3-Clause BSD", "New BSD", "Modified BSD")}
_VERSIONED = {"Apache": ("Apache", ("1.1", "2.0")), "MPL": ("Mozilla Public", ("1.0", "1.1", "2.0")), "EPL": ("Eclipse Public", ("1.0", "2.0")),
              "BSL": ("Boost Software", ("1.0",)), "EUPL": ("European Union Public", ("1.1", "1.2")), "OFL": ("SIL Open Font", ("1.1",)),
              "CDDL": ("Common Development and Distribution", ("1.0", "1.1")), "Artistic": ("Artistic", ("1.0", "2.0"))}
#: Ways in which a line names its licence.
_WAYS = [f"{what}{verb} under {the}{{}}" for what, verb, the in product(
    ("", "This work is ", "This software is ", "This project is "),
    ("licensed", "released"), ("the ", "the terms of the ", ""))] + ["Distributed under the {}", "This work is licensed under a {}", "License: {}", "SPDX-License-Identifier: {}"]


def _names() -> dict[str, list[str]]:
    """Each licence with the names that notices give it, over its versions."""
    out = {k: [k, *[form for x in names for form in (x, f"{x} License")]] for k, names in _NAMED.items()}

    def versions(v: str) -> list[str]:
        return [v, v.removesuffix(".0")] if v.endswith(".0") else [v]

    for short, (name, all_versions) in _VERSIONED.items():
        for v in all_versions:
            out[f"{short}-{v}"] = [f"{short}-{v}", f"{short} {v}", *[x for w in versions(v) for x in (
                f"{name} License, Version {w}", f"{name} License {w}", f"{name} License v{w}", f"{name} {w} License")]]
    for short, (name, all_versions) in _GNU.items():
        for v in all_versions:
            for end, later in (("", ""), ("-or-later", " or later"), ("-only", " only")):
                names = [x + later for w in versions(v) for x in (
                    f"GNU {name}, version {w}", f"GNU {name} v{w}", f"GNU {short} v{w}", f"GNU {short}v{w}", f"{short} version {w}", f"{short} v{w}",
                    f"{short}v{w}", f"{short} {w}")]
                out.setdefault(f"{short}-{v}{end}", [f"{short}-{v}{end}"]).extend(names)
    for short, name in _CC.items():
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            kind = {"4.0": "International"}.get(v, "Unported")
            out[f"CC-{short}-{v}"] = [f"CC {short} {v}", f"Creative Commons {name} {v}", f"Creative Commons {name} {v} License",
                                      f"Creative Commons {name} {v} {kind}", f"Creative Commons {name} {v} {kind} License"]
    out["CC0-1.0"] = ["CC0 1.0", "CC0", "CC0 1.0 Universal", "Creative Commons Zero v1.0 Universal"]
    return out


def _line_notices() -> list[tuple[str, str, str]]:
    return [(k, "notice", way.format(name)) for k, names in _names().items() for name in dict.fromkeys(names) for way in _WAYS]


#: Known texts: licence, kind of text, text. Public licence texts, and one-line notices over names and versions.
KNOWN = (
    *_whole_texts(), ("Apache-2.0", "notice", _APACHE_NOTICE), ("LicenseRef-reserved", "notice", "All rights reserved."), *_line_notices(),
)

_TYPOGRAPHIC = "\u00a0«·»\u2010\u2011\u2012\u2013\u2014\u2015\u2018\u2019\u201a\u201b\u201c\u201d\u201e\u201f\u2022\u2026\ufeff"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _TYPOGRAPHIC, "abcdefghijklmnopqrstuvwxyz" + " " * len(_TYPOGRAPHIC)


#: What stands before a line's words: white space and the signs that comments begin with.
_LEADER = r"(^|\n)[\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]*"
#: Words with which "Copyright" begins a phrase of a licence rather than a notice.
_PHRASE = "(Holder|Owner|Notice|License|Licence|Law|Act|Statement|Permission)"
#: Copyright notices, a line each: a mark, a year, "by" or a name follows the word; or a year follows the mark.
_NOTICE = (_LEADER + r"(?:(?:Portions|portions|PORTIONS)[ \t]+(?:of [a-z ]{1,40} )?)?(?:[Cc]opyright|COPYRIGHT)[ \t]*(?:\([Cc]\)|©|:|[0-9]{4}|[Bb]y |[A-Z][a-z])[^\n]*",
           _LEADER + r"(?:\([Cc]\)|©)[ \t]*[0-9]{4}[^\n]*")
#: What becomes a blank: ASCII white space and punctuation (typographic quotes, dashes, dots and blanks are folded to a blank before).
_GAP = r"[\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+"


def canonical(text: Column | str) -> Column:
    """The canonical form of a text: copyright notices left out, line by line and also behind a comment's signs; A-Z folded; every run of
    punctuation and white space, and with it comment signs, made one blank, none at the ends; then equal spellings made one, so
    that a line break inside one doesn't matter. Null stays null."""
    text = F.col(text) if isinstance(text, str) else text
    marks = [F.contains(text, F.lit(x)) for x in ("opyright", "OPYRIGHT", "©", "(c)", "(C)")]
    c = F.regexp_replace(text, f"Copyright {_PHRASE}", "copyright-$1")
    for notice in _NOTICE:
        c = F.regexp_replace(c, notice, "\n")
    c = F.when(reduce(or_, marks), c).otherwise(text)
    c = F.translate(F.replace(c, F.lit("&"), F.lit(" and ")), _UPPER, _LOWER)
    c = F.trim(F.regexp_replace(c, _GAP, " "))
    for written_form, form in EQUIVALENT:
        c = F.replace(c, F.lit(written_form), F.lit(form))
    return c


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark: SparkSession, known: tuple[tuple[str, str, str], ...] = KNOWN) -> DataFrame:
    """(digest, license, kind), one row a digest: as many rows as ``known`` at most."""
    rows = spark.createDataFrame(pa.table(dict(zip(("license", "kind", "text"), map(list, zip(*known, strict=True)), strict=True))))
    return (rows.select(digest(F.col("text")).alias("digest"), "license", "kind")
            .groupBy("digest").agg(F.min(F.struct("license", "kind")).alias("k")).select("digest", "k.license", "k.kind"))


def scan(docs: DataFrame, text: str = "text", known: tuple[tuple[str, str, str], ...] = KNOWN) -> DataFrame:
    """``docs`` with ``digest`` (sha-256 of the whole canonical text), ``license`` and ``kind`` of the known text that it
    equals (null if none).

    A null text has a null digest and matches nothing; an empty text, or one of punctuation alone, has the digest of the
    empty string and matches nothing unless that is listed. Texts are digested whole, at any length. Repeated rows match
    each; an empty table gives an empty result. Only the known digests are broadcast, a list in the code."""
    table = F.broadcast(known_digests(docs.sparkSession, known)).select(F.col("digest").alias("__digest"), F.col("license").alias("__license"), F.col("kind").alias("__kind"))
    scanned = docs.withColumn("__d", digest(F.col(text)))
    kept = [c for c in docs.columns if c not in ("digest", "license", "kind")]
    return (scanned.join(table, F.col("__d") == F.col("__digest"), "left")
            .select(*[F.col(f"`{c}`") for c in kept], F.col("__d").alias("digest"), F.col("__license").alias("license"), F.col("__kind").alias("kind")))


def notices(docs: DataFrame, text: str = "text", known: tuple[tuple[str, str, str], ...] = KNOWN) -> DataFrame:
    """``docs`` with one row for every line that, as a text of its own, equals a known text: ``line`` (from 1), ``license``,
    ``kind``. Lines are digested like texts and joined with the same digests."""
    lines = docs.select("*", F.posexplode(F.split(F.col(text), "\n")).alias("__at", "__line"))
    hit = scan(lines, "__line", known).where(F.col("license").isNotNull())
    return hit.withColumn("line", F.col("__at") + 1).drop("__at", "__line", "digest")
