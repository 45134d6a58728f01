import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.operators import records as rec
from sluice.operators.mapping import flatten_by_mapping
from sluice.spec import (BooleanField, DateTimeField, DelimitedStringField, FloatField, IntegerField, RecordSpec,
                         StringField)

SPEC = RecordSpec(IntegerField("id", nullable=False), StringField("name", length=5), FloatField("x"),
                  BooleanField("ok"), DateTimeField("t"))


def test_spec_rules():
    with pytest.raises(ValueError):
        StringField("s", length=0)
    with pytest.raises(ValueError):
        StringField("s", truncate=True)
    assert SPEC.sql_columns()[0] == ("id", "INT NOT NULL")


def test_conform_json_errors(spark):
    rows = ['{"id":1,"name":"abc","x":1.5,"ok":true,"t":"2020-01-01T00:00:00Z"}',
            '{"id":3.7,"name":"toolong","x":"nan?","ok":"yes","t":"2020-01-01T00:00:00"}',
            '{"name":"a","extra":1}',
            '{"id":2,"name":null,"x":"3.5","ok":false,"t":"1899-01-01T00:00:00+00:00"}',
            '{"id":4,"name":"a","x":1,"ok":false,"t":"2020-01-01T00:00:00+02:00"}']
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "n int, j string")
    out = {r["n"]: r for r in rec.conform_json(df, "j", SPEC, keep=["n"]).select(
        "n", "x", rec.error_text("errors").alias("e")).collect()}
    assert out[0]["e"] == ""
    assert "id: The value is not an integer" in out[1]["e"]
    assert "name: The string length exceeds the maximum allowed" in out[1]["e"]
    assert "t: The value is a naive datetime." in out[1]["e"]
    assert "Unknown fields specified: extra" in out[2]["e"] and "Required fields not specified" in out[2]["e"]
    assert out[3]["x"] == 3.5 and "t: The value must be a date after 1900." in out[3]["e"]
    assert "t: The value must use UTC timezone." in out[4]["e"]
    sparse = rec.conform_json(df.where("n = 2"), "j", SPEC, sparse=True).select(rec.error_text("errors")).first()[0]
    assert "Required" not in sparse and "id: The field cannot accept null values" in sparse


def test_conform_schema_level(spark):
    df = spark.createDataFrame([(1, "a")], "id bigint, name string")
    with pytest.raises(TypeError, match="Required fields not specified"):
        rec.conform(df, SPEC)
    assert rec.conform(df, SPEC, sparse=True).columns == SPEC.names
    with pytest.raises(TypeError, match="Unknown fields specified: zz"):
        rec.conform(df.withColumn("zz", F.lit(1)), SPEC, sparse=True)


def test_tsv_round_trip(spark):
    spec = RecordSpec(IntegerField("id"), StringField("s", length=3, truncate=True), BooleanField("b"),
                      DateTimeField("t"), FloatField("f"), DelimitedStringField("d"))
    df = spark.createDataFrame([(1, "abcdef", True, dt.datetime(2020, 1, 2, 3, 4, 5, 6), 1.5, ["x", "y"]),
                                (2, None, False, None, None, None)],
                               "id bigint, s string, b boolean, t timestamp, f double, d array<string>")
    lines = rec.tsv_encode(df, spec)
    got = sorted(r[0] for r in lines.collect())
    assert got[0] == "1\tabc\t1\t2020-01-02 03:04:05.000006\t1.5\tx\x00y"
    assert got[1] == "2\t\\N\t0\t\\N\t\\N\t\\N"
    back = rec.tsv_decode(lines, spec).orderBy("id").collect()
    assert back[0]["t"] == dt.datetime(2020, 1, 2, 3, 4, 5, 6) and back[0]["d"] == ["x", "y"] and back[0]["b"] is True
    assert back[1]["s"] is None and back[1]["errors"] == []
    bad = rec.tsv_decode(spark.createDataFrame([("1\t2",)], "line string"), spec).first()
    assert bad["errors"][0]["message"].startswith("The length of the tuple")


def test_record_diff(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id int, v string")
    b = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    got = sorted((r["side"], r["id"]) for r in rec.record_diff(a, b).collect())
    assert got == [("left", 2), ("right", 3)]


def test_flatten_by_mapping(spark):
    spec = RecordSpec(IntegerField("a"), StringField("s", length=6), IntegerField("n"), FloatField("x"),
                      StringField("lst"))
    mapping = {"root.A.B": "a", "root.one.S": "s", "root.two.s": "s", "root.n": "n", "root.x": "x", "root.L": "lst"}
    docs = ['{"A":{"B":3},"one":{"S":"first"},"two":{"s":"second-long"},"n":"7","x":"bad","L":[1,2]}',
            '{"two":{"s":"z"},"one":{"S":"y"},"n":2.9,"x":1.5,"A":null}',
            '{"n":"3.7","a":{"b":5}}']
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, j string")
    out = {r["i"]: r for r in flatten_by_mapping(df, "j", mapping, spec, keep=["i"]).collect()}
    assert (out[0]["a"], out[0]["s"], out[0]["n"], out[0]["x"], out[0]["lst"]) == (3, "se...", 7, None, None)
    assert (out[1]["a"], out[1]["s"], out[1]["n"], out[1]["x"]) == (None, "y", 2, 1.5)  # last in document order
    assert (out[2]["a"], out[2]["n"]) == (5, None)  # keys are matched case-insensitively


def test_raise_on_errors(spark):
    df = spark.createDataFrame([('{"id":"x","name":"a","x":1,"ok":true,"t":"2020-01-01T00:00:00Z"}',)], "j string")
    checked = rec.raise_on_errors(rec.conform_json(df, "j", SPEC))
    with pytest.raises(Exception, match="id: The value is not an integer"):
        checked.collect()
    good = spark.createDataFrame([('{"id":1,"name":"a","x":1,"ok":true,"t":"2020-01-01T00:00:00Z"}',)], "j string")
    assert rec.raise_on_errors(rec.conform_json(good, "j", SPEC)).count() == 1


def test_flatten_by_mapping_edges(spark):
    from sluice.spec import DateTimeField as When

    spec = RecordSpec(IntegerField("i"), FloatField("f"), BooleanField("b"), StringField("s"), When("t"), StringField("u"))
    mapping = {"root.a.i": "i", "root.f": "f", "root.f2": "f", "root.b": "b", "root.s.t": "s", "root.when": "t", "root.u": "u"}
    docs = [('{"A":{"I":"12"},"F":"x","f2":1,"b":"","s":{"T":true},"when":"2020-01-02T03:04:05Z"}', (12, 1.0, False, "True", dt.datetime(2020, 1, 2, 3, 4, 5), None)),
            ('{"f":2.5,"f2":"bad","b":0.0,"a.i":7,"s.t":3.0,"when":"2020-01-02"}', (7, 2.5, False, "3.0", None, None)),  # dots in keys; a failed float keeps, a failed time clears
            ('{"a":{"i":1},"A":{"i":2},"s":{"t":1e21},"b":[1],"u":null}', (2, None, None, "1e+21", None, None)),
            ('{"a":{"i":9223372036854775808},"f":true,"u":"\\ud800x"}', (None, 1.0, None, None, None, "?x")),
            ('[1]', (None,) * 6), ('{"a":', (None,) * 6), (None, (None,) * 6), ('{"a":{"i":-3.9},"f":" 1e3 ","u":"tab\\t"}', (-3, 1000.0, None, None, None, "tab\\t"))]
    df = spark.createDataFrame([(n, d) for n, (d, _) in enumerate(docs)], "n int, j string").withColumn("v", F.parse_json(F.lit('{"k":1}')))
    rows = flatten_by_mapping(df, "j", mapping, spec, {"u": F.lit("calc")} if False else None, keep=["n", "v"]).orderBy("n").collect()
    for r, (_, want) in zip(rows, docs, strict=True):
        assert tuple(r[c] for c in spec.names) == want
    assert rows[0]["v"].toPython() == {"k": 1}


def test_flatten_by_mapping_parses_each_document_once(spark, monkeypatch):
    from sluice.operators import mapping as M

    plan = flatten_by_mapping(spark.createDataFrame([('{"a":1}',)], "j string"), "j", {"root.a": "n"}, RecordSpec(IntegerField("n")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "from_json" not in plan and "parse_json" not in plan and M.ROOT == "root"
