"""Records of delimited text by composed line transitions, against Python's csv reader and a plain walk over characters."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from sluice.operators import reports as R
from sluice.sources import records as S
from sluice.sources.delimited import delimited_load
from sluice.sources.files import numbered_lines

PIECES = ['"', '"', '""', ",", ",", "a", "b c", "\n", "\n", '5" pipe', '"x"', '"y', 'z"']


def as_lines(spark, texts):
    rows = [(f"f{i}", n + 1, x) for i, t in enumerate(texts) for n, x in enumerate(t.split("\n"))]
    return spark.createDataFrame(rows, "file_path string, line long, value string")


def read(spark, texts):
    rows = S.records(S.classified(as_lines(spark, texts)))
    rows = rows.withColumn("fields", S.csv_fields(F.col("value"), F.col("malformed"))).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r["file_path"], r["line"])):
        out.setdefault(r["file_path"], []).append(r)
    return [out[f"f{i}"] for i in range(len(texts))]


@pytest.mark.parametrize("chunk", [1, 3, 65_536])
def test_records_and_fields_are_those_of_the_csv_module(spark, monkeypatch, chunk):
    monkeypatch.setattr(S, "CHUNK", chunk)
    r = random.Random(chunk)
    texts = ["".join(r.choice(PIECES) for _ in range(r.randint(1, 40))) for _ in range(150)]
    texts += ["plain,a\nplain,b", '"never closed\n1,2\n3,4', 'x,5" pipe\ny,6" pipe\nz,1', '"a""b","c\n\nd"\n"e"f,g', "", "\n\n", '""', '"a\n"b,c\n"']
    for text, rows in zip(texts, read(spark, texts), strict=True):
        want = list(csv.reader(io.StringIO(text + ("" if text.endswith("\n") else "\n"), newline="")))
        got = [x["fields"] for x in rows]
        if any(x["malformed"] for x in rows):  # the file ends inside quotes: the last record holds all the rest
            assert [x["malformed"] for x in rows] == [False] * (len(rows) - 1) + [True]
            want[-1][-1] = want[-1][-1].removesuffix("\n")
            got[-1][-1] = got[-1][-1].removesuffix("\n")
        assert [g for g in got if g] == [w for w in want if w], text


def walk(text, sep, quote, escape):
    """Line numbers on which a record begins, by MySQL's rules, a character at a time."""
    begins, line, i, state, at_field = [1], 1, 0, "plain", True
    while i < len(text):
        c = text[i]
        if c == escape:
            line += text[i + 1:i + 2] == "\n"
            i, at_field = i + 2, False
            continue
        if state == "quoted":
            if c == quote:
                if text[i + 1:i + 2] == quote:
                    i += 1
                elif text[i + 1:i + 2] in (sep, "\n", ""):
                    state = "plain"
            line += c == "\n"
        elif c == quote and at_field:
            state, at_field = "quoted", False
        elif c == "\n":
            line, at_field = line + 1, True
            begins.append(line)
        else:
            at_field = c == sep
        i += 1
    return begins


@pytest.mark.parametrize("chunk", [1, 4])
def test_escapes_and_quotes_as_mysql_reads_them(spark, monkeypatch, chunk):
    monkeypatch.setattr(S, "CHUNK", chunk)
    r = random.Random(chunk)
    texts = ["".join(r.choice([*PIECES, "\\", "\\\n", '\\"', "\\,"]) for _ in range(r.randint(1, 30))) for _ in range(150)]
    rows = S.records(S.classified(as_lines(spark, texts), S.Dialect(",", '"', "\\", lenient_end=False))).collect()
    for i, t in enumerate(texts):
        got = sorted(x["line"] for x in rows if x["file_path"] == f"f{i}")
        assert got == walk(t, ",", '"', "\\"), t


def test_plain_input_takes_no_second_pass(spark):
    lines = S.classified(as_lines(spark, ['a,"b"\n"c,d",e\nf']))
    assert S.shared_lines(lines) is None


def test_a_quote_that_never_closes_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(S, "RECORD_BYTES", 100)
    text = "1,a\n2,\"b\n" + "\n".join(f"{i},{'x' * 10}" for i in range(50))
    rows = sorted(S.records(S.classified(as_lines(spark, [text]))).collect(), key=lambda r: r["line"])
    assert len(rows) == 52 and [r["malformed"] for r in rows] == [False] + [True] * 51
    assert all("\n" not in r["value"] for r in rows)


def test_report_rows_keep_stray_quotes(spark, tmp):
    import os

    os.makedirs(tmp + "/in")
    with open(tmp + "/in/a.csv", "w") as f:
        f.write('x\ny\nz\nCH,n,note,Count\nSB,1,5" pipe,\nSB,2,"a\nb",\nSB,3,6" pipe,\nSB,4,"q"uote"d,\n\nSF,,,4\nSB,9,late,\n')
    rows = R.report_rows(numbered_lines(spark, tmp + "/in"), ["CH", "n", "note", "Count"])
    got = [tuple(r) for r in R.report_body(rows, F.lit("d"), ["n", "note"]).orderBy("line").select("n", "note").collect()]
    assert got == [("1", '5" pipe'), ("2", "a\nb"), ("3", '6" pipe'), ("4", 'quote"d'), ("9", "late")]
    check = R.control_total_check(rows, "Count").first()
    assert (check["found"], check["expected"], check["ok"]) == (4, 4, True)


def test_delimited_load_keeps_rows_around_stray_quotes(spark, tmp):
    import os

    os.makedirs(tmp + "/in")
    with open(tmp + "/in/a.csv", "w") as f:
        f.write('1,5" pipe\n2,x\n3,6" pipe\n4,"a\nb"\n5,"The "BIG" one"\n6,c\\\nd\n')
    want = [(1, '5" pipe'), (2, "x"), (3, '6" pipe'), (4, "a\nb"), (5, 'The "BIG" one'), (6, "c\nd")]
    got = delimited_load(spark, tmp + "/in", "id int, s string", quote='"', multiline=True).orderBy("id").collect()
    assert [tuple(r) for r in got] == want
    with open(tmp + "/in/a.csv", "w") as f:
        f.write('1,"open\n2,x\n')
    (row,) = delimited_load(spark, tmp + "/in", "id int, s string", quote='"', multiline=True, on_error="column").collect()
    assert "a field is not closed" in row["_errors"]
