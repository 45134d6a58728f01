from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sluice.functions import convert as C
from sluice.functions import money as M
from sluice.functions import text as X


def one(spark, expr, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


def test_safe_course_id(spark):
    assert one(spark, X.safe_course_id("v"), "course-v1:OrgX+DemoX+2015") == "OrgX_DemoX_2015"
    assert one(spark, X.safe_course_id("v"), "OrgX/DemoX/2015") == "OrgX_DemoX_2015"
    assert one(spark, X.safe_course_id("v"), "not a key") == "not_a_key"
    assert one(spark, X.safe_course_id("v", "-"), "not a key") == "not-a-key"
    assert one(spark, X.safe_course_id("v"), "course-v1:Ünï+DemoX+2015") == "Ünï_DemoX_2015"
    assert one(spark, X.safe_course_id("v"), "library-v1:OrgX+lib") == "OrgX_lib"
    assert one(spark, X.safe_course_id("v"), "library-v1:Org X+lib") == "library-v1_Org_X_lib"


def test_url_file_stem(spark):
    cases = {"https://x.org/a/sitemap-0.xml": "sitemap-0", "http://h/a/.hid": ".hid", "http://h/a/b.tar.gz": "b.tar",
             "http://h/a/": "", "https://h/fr/825?page=2&ref=x": "825", "http://h/x.html#top": "x", "http://h/a.": "a"}
    for url, stem in cases.items():
        assert one(spark, X.url_file_stem("v"), url) == stem, url


def test_delimited_list(spark):
    assert one(spark, X.delimited_list("v"), None) == []
    assert one(spark, X.delimited_list("v"), "") == []
    assert one(spark, X.delimited_list("v"), "a") == ["a"]
    assert one(spark, X.delimited_list("v"), "a;;b;") == ["a", "", "b", ""]
    assert one(spark, X.delimited_list_cap("v", cap=25), ";".join(["x"] * 25)) == ["x"] * 25
    assert one(spark, X.delimited_list_cap("v", cap=25), ";".join(["x"] * 26)) is None
    assert "26" in one(spark, X.list_cap_error("v", cap=25), ";".join(["x"] * 26))


def test_cents_to_decimal(spark):
    expected = {"0": Decimal("0.00"), "-1": Decimal("-0.01"), "10": Decimal("0.10"), "100": Decimal("1.00"),
                "1000": Decimal("10.00"), "": Decimal("0.00")}
    df = spark.createDataFrame([(k, "Sale") for k in expected], "a string, t string")
    got = {r["a"]: r["d"] for r in df.select("a", M.cents_to_decimal("a", "t").alias("d")).collect()}
    assert got == expected
    refund = spark.createDataFrame([("5000", "140", "Credit")], "a string, f string, t string")
    r = refund.select(M.cents_to_decimal("a", "t").alias("a"), M.cents_to_decimal("f", "t").alias("f")).first()
    assert (r["a"], r["f"]) == (Decimal("-50.00"), Decimal("-1.40"))
    bad = spark.createDataFrame([("50.5", "Sale"), ("1e3", "Sale"), ("10", "Void")], "a string, t string")
    rows = bad.select(M.cents_to_decimal("a", "t").alias("d"), M.cents_error("a", "t").alias("e")).collect()
    assert all(r["d"] is None and r["e"] for r in rows)
    assert rows[2]["e"] == "Unknown transaction type: Void"


def test_transaction_type(spark):
    df = spark.createDataFrame([("Sale",), ("Credit",), ("Other",)], "t string")
    assert [r[0] for r in df.select(M.transaction_type("t")).collect()] == ["sale", "refund", None]


def test_iso_format(spark):
    df = spark.createDataFrame([("2020-01-01 10:00:00",), ("2020-01-01 10:00:00.000123",)], "v string")
    got = [r[0] for r in df.select(X.iso_format(F.col("v").cast("timestamp_ntz"))).collect()]
    assert got == ["2020-01-01T10:00:00", "2020-01-01T10:00:00.000123"]


def test_datetime_digits(spark):
    import datetime as dt
    assert one(spark, C.datetime_digits("v"), "2020-01-01 10:11:12.5") == dt.datetime(2020, 1, 1, 10, 11, 12, 5)
    assert one(spark, C.datetime_digits("v"), "2020/01/02") == dt.datetime(2020, 1, 2)
    assert one(spark, C.datetime_digits("v"), "2020") is None
    assert one(spark, C.datetime_digits("v"), "1-2-3-4-5-6-7-8") is None


def test_converters(spark):
    doc = ('{"a":3.7,"b":"3.7","c":true,"d":"false","e":" 12 ","f":"a\\tb\\\\c","g":1e3,'
           '"h":"2024-01-01T10:00:00+02:00","i":"20240101T100000Z","j":"2024-01-01T10:00:00","k":"","l":0}')
    df = spark.createDataFrame([(doc,)], "j string").select(F.explode(F.from_json("j", "map<string,variant>")))
    r = {row["key"]: row for row in df.select(
        "key", C.map_string("value", 8).alias("s"), C.map_int("value").alias("i"), C.map_float("value").alias("f"),
        C.map_bool("value").alias("b"), F.date_format(C.map_datetime("value"), "yyyy-MM-dd HH:mm").alias("t")
    ).collect()}
    assert (r["a"]["i"], r["b"]["i"], r["e"]["i"], r["c"]["i"]) == (3, None, 12, 1)
    assert (r["b"]["f"], r["g"]["f"]) == (3.7, 1000.0)
    assert (r["d"]["b"], r["k"]["b"], r["l"]["b"], r["c"]["b"]) == (True, False, False, True)
    assert r["c"]["s"] == "True" and r["f"]["s"] == "a\\tb\\\\c"
    assert r["h"]["t"] == "2024-01-01 08:00" and r["i"]["t"] == "2024-01-01 10:00" and r["j"]["t"] is None


def test_map_string_truncates(spark):
    assert one(spark, C.map_string("v", 10, is_variant=False), "abcdefghijkl") == "abcdef..."
    assert one(spark, C.map_string("v", is_variant=False), "a\x00b") == "a\\0b"


def test_checkpoint_root_when_unset():
    from sluice.session import checkpoint_root

    class Conf:
        def get(self, k, d=None):
            return d

        def set(self, k, v):
            raise RuntimeError("read-only")

    class Ctx:
        dir, master = None, "local[2]"

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d

    class Session:
        conf, sparkContext = Conf(), Ctx()

    s = Session()
    root = checkpoint_root(s)
    assert root and s.sparkContext.dir == root and checkpoint_root(s) == root


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_checkpoint_root_on_a_cluster(master):
    from types import SimpleNamespace as N

    from sluice.session import checkpoint_root

    ctx = N(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
    with pytest.raises(RuntimeError):
        checkpoint_root(N(conf=N(get=lambda k, d=None: d), sparkContext=ctx))
    ctx.getCheckpointDir = lambda: "s3://shared/ckpt/"
    assert checkpoint_root(N(conf=N(get=lambda k, d=None: d), sparkContext=ctx)) == "s3://shared/ckpt"
    assert checkpoint_root(N(conf=N(get=lambda k, d=None: "hdfs://named"), sparkContext=ctx)) == "hdfs://named"


def test_json_number_text_like_python(spark):
    import json

    docs = [(json.dumps({"v": v}),) for v in (3.0, 100.0, 2.5e-08, 1e21, 12.3, 10, 123456789012345678901234567890)]
    df = spark.createDataFrame(docs, "j string")
    got = [r[0] for r in df.select(C.map_string(F.from_json("j", "map<string,variant>")["v"])).collect()]
    assert got == ["3.0", "100.0", "2.5e-08", "1e+21", "12.3", "10", "123456789012345678901234567890"]


def test_api_surface():
    import sluice.api as api

    for name in ("guarded_slice_load", "variant_landing", "global_rank", "flatten_by_mapping", "control_total_check",
                 "page_positions", "python_float_text", "RecordSpec"):
        assert name in api.__all__


def test_list_cap_raise_mode(spark):
    import pytest

    df = spark.createDataFrame([(";".join(["x"] * 26), "h1")], "v string, id string")
    with pytest.raises(Exception, match="26 items, the cap is 25"):
        df.select(X.delimited_list_cap("v", cap=25, row_id=F.col("id"), on_error="raise")).collect()
