import hashlib
import re

import pytest
from pyspark.sql import functions as F

from sluice.llm import pii, queries

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def good(kind, text):
    digits = [int(c) for c in text if c.isascii() and c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        total = sum(sum(divmod(d * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    """The plain patterns, as they are written."""
    found = [(m.start(), k, m.end()) for k, kind in enumerate(pii.KINDS) for m in re.finditer(PATTERNS[kind], text or "") if good(kind, m.group())]
    return sorted(found)


HARD = ["", "a@b.c._x@y.z", "a@b@c.d.e", "@x.y a@b", "x@y..z", "1.2.3.4.5.6.7.8", "1.2.3.400 1.2.3.4", "0001.02.3.255.1", "300.1.2.3.4.5", "4111 1111 1111 1111",
        "4111-1111 1111-1111 42", "4111  1111 1111 1111", "+1 (555) 555-1234 +44 20 7946 0958.", "+1" + " " * 50 + "2", "++1.2.3.4.5.6.7.8.9+1234567890123456",
        "mail me.you@x-y.co.uk, or 10.0.0.1:80", "tel:+4930123456 12 4242424242424242", "é@ü.de ab%c@d.e-f.g-", "+1 555 555 1234 4111111111111111 192.168.0.1"]

DISGUISED = [("write to john [at] example [dot] com now", "email", "john [at] example [dot] com"),
             ("john dot doe at example dot co dot uk, please", "email", "john dot doe at example dot co dot uk"),
             ("a jоhn@exаmple.com b", "email", "jоhn@exаmple.com"),
             ("ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
             ("🙂 john&#64;example&#46;com", "email", "john&#64;example&#46;com"),
             ("ana arroba correo punto es hoy", "email", "ana arroba correo punto es"),
             ("jane_at_example_dot_org", "email", "jane_at_example_dot_org"),
             ("john @ example . com", "email", "john @ example . com"),
             ("jo​hn@exam­ple.com", "email", "jo​hn@exam­ple.com"),
             ("at one nine two dot one six eight dot one dot one end", "ip", "one nine two dot one six eight dot one dot one"),
             ("192[.]168(dot)1[.]1 x", "ip", "192[.]168(dot)1[.]1"),
             ("192 dot 168 dot one dot 1 x", "ip", "192 dot 168 dot one dot 1"),
             ("١٩٢.168.0.1", "ip", "١٩٢.168.0.1"),
             ("card four one one one, one one one one, one one one one, one one one one ok", "card", "four one one one, one one one one, one one one one, one one one one"),
             ("vier eins eins eins eins eins eins eins eins eins eins eins eins eins eins eins", "card", "vier" + " eins" * 15),
             ("four triple one 1111 1111 1111", "card", "four triple one 1111 1111 1111"),
             ("4111‑1111‑1111‑1111", "card", "4111‑1111‑1111‑1111"),
             ("plus one four one five five five five one two three four now", "phone", "plus one four one five five five five one two three four"),
             ("tel. plus 49 one five one two three four five six seven", "phone", "plus 49 one five one two three four five six seven"),
             ("＋1 (555) 555‑1234", "phone", "＋1 (555) 555‑1234")]

CLEAN = ["look at the dot com boom. He stopped at some point the car", "one, two, three. One day at a time", "+1 (848) 555-1373 Un autre", "+1 (848) 555-1373 One two",
         "me@b.c dot product", "room 12 one floor up", "Привет, мир: это текст о 5 книгах", "f(x) = a[at] + b[.]", "array[at]", "x at y", "10.5 at 3.2", "see (at) home"]


@pytest.mark.parametrize("text", HARD)
def test_plain_spans_are_the_patterns(text):
    assert pii.find(text) == brute(text)


def test_random_texts():
    import random

    r = random.Random(7)
    for _ in range(4000):
        text = "".join(r.choice(["1", "25", "4", ".", " ", "-", "+", "@", "a", "b.c", "(", ")", "x@y.z", "4111111111111111", "%", "é", "\n"]) for _ in range(r.randint(0, 30)))
        assert pii.find(text) == brute(text), text
        plain = [(a, k, b) for a, k, b, p in pii.spans(text) if p]
        assert plain == brute(text)


@pytest.mark.parametrize(("text", "kind", "want"), DISGUISED)
def test_disguised_spans_map_back_to_the_source(text, kind, want):
    added = [(pii.KINDS[k], text[a:b]) for a, k, b, plain in pii.spans(text) if not plain]
    assert added == [(kind, want)]


@pytest.mark.parametrize("text", CLEAN + [h for h in HARD])
def test_nothing_is_added_to_clean_texts(text):
    assert [s for s in pii.spans(text) if not s[3]] == []


def test_long_texts_take_linear_time():
    import time

    for text in ["one " * 100_000, "1 " * 200_000, "a@" * 100_000, "+1" + " " * 300_000, "x" * 500_000, "." * 300_000 + "@", "1" * 300_000, "1." * 200_000,
                 " at dot " * 50_000, "а" * 300_000, "@ " * 100_000 + " dot ", "[at]" * 50_000, "1.2.3.4 " * 50_000 + "​"]:
        start = time.process_time()
        assert len([s for s in pii.spans(text) if s[3]]) == len(pii.find(text))
        assert time.process_time() - start < 5


def test_view_keeps_source_ranges():
    view = pii.View("abcdef").edited([(1, 3, "X"), (4, 5, "yz")]).edited([(0, 2, ""), (3, 4, "!")])
    assert view.text == "d!zf" and [view.source(i, i + 1) for i in range(4)] == [(3, 4), (4, 5), (4, 5), (5, 6)]


def test_query_on_tables_and_edges(spark, tables, edge, empty):
    rows = {r["doc_id"]: r for r in queries.op12_pii(spark, tables).collect()}
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(docs)
    for d in docs:
        found, r = brute(d["text"]), rows[d["doc_id"]]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(f[1] == i for f in found) for i in range(4)]
        said = [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in found]
        assert r["base_sha256"] == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert r["spans"] == ",".join(said)  # the supplied texts hold no disguise
    got = pii.detect(edge.withColumn("text", F.concat_ws("", "text", F.lit(" a@b.c"))), keep=("doc_id", "source")).collect()
    assert len(got) == edge.count() and all([s["kind"] for s in r["spans"]] == ["email"] for r in got)
    assert [r["spans"] for r in pii.detect(edge.where("text is null or text = ''")).collect()] == [[], []]
    assert pii.detect(empty).collect() == []
