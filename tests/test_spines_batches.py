from pyspark.sql import functions as F

from sluice.operators.batching import batch_pack, global_rank
from sluice.operators.spines import date_spine, missing_slices, month_spine, param_product


def test_date_spine(spark):
    assert [r[0] for r in date_spine(spark, "2020-01-01", "2020-01-05").orderBy("date").collect()] == [
        "20200101", "20200102", "20200103", "20200104"]
    assert date_spine(spark, "2020-01-05", "2020-01-01").count() == 0
    assert date_spine(spark, "2020-01-05", "2020-01-05").count() == 0


def test_month_spine(spark):
    got = [r[0] for r in month_spine(spark, "2023-01-31", "2023-05-05").orderBy("month_start").collect()]
    assert got == ["2023-01-01", "2023-02-01", "2023-03-01", "2023-04-01", "2023-05-01"]


def test_missing_slices(spark):
    spine = date_spine(spark, "2020-01-01", "2020-01-05")
    loaded = spark.createDataFrame([("20200102",), ("20200104",)], "date string")
    assert sorted(r[0] for r in missing_slices(spine, loaded).collect()) == ["20200101", "20200103"]


def test_param_product(spark):
    a = spark.createDataFrame([(1,), (2,), (3,)], "n int")
    b = spark.createDataFrame([("a",), ("b",), ("c",)], "s string")
    rows = [tuple(r) for r in param_product(a, b).collect()]
    assert rows == [(1, "a"), (1, "b"), (1, "c"), (2, "a"), (2, "b"), (2, "c"), (3, "a"), (3, "b"), (3, "c")]


def test_global_rank_exact(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5003).alias("k"), F.lit("x").alias("v"))
    r = global_rank(df, ["k"], "rank", partitions=5)
    exp = {row["k"]: i + 1 for i, row in enumerate(sorted(df.collect(), key=lambda x: x["k"]))}
    assert {row["k"]: row["rank"] for row in r.collect()} == exp


def test_batch_pack_bounds(spark):
    df = spark.range(0, 1234, 1, 5).withColumnRenamed("id", "k")
    packed = batch_pack(df, 75, ["k"]).collect()
    assert max(r["n"] for r in packed) <= 75
    keys = sorted(x["k"] for r in packed for x in r["rows"])
    assert keys == list(range(1234))
    first = {r["batch_id"]: r["rows"][0]["k"] for r in packed}
    assert first[0] == 0 and first[1] == 75
    fast = batch_pack(df, 50).collect()
    assert max(r["n"] for r in fast) <= 50 and sum(r["n"] for r in fast) == 1234


def test_global_rank_string_and_composite_keys(spark):
    rows = [(f"k{i % 97:03d}", i // 97, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "a string, b long, v long")
    got = {(r["a"], r["b"]): r["rank"] for r in global_rank(df, ["a", "b"], "rank", partitions=9).collect()}
    exp = {k: i + 1 for i, k in enumerate(sorted((a, b) for a, b, _ in rows))}
    assert got == exp
    ts = spark.range(0, 500, 1, 3).select(F.timestamp_seconds(F.col("id") * 7 % 501).alias("t"), "id")
    ranked = global_rank(ts, ["t"], "rank", partitions=6).orderBy("t").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 501))


def test_batch_pack_rows_with_variant(spark):
    df = spark.range(0, 30, 1, 3).select(F.col("id").alias("k"), F.parse_json(F.lit('{"a":1}')).alias("v"))
    packed = batch_pack(df, 7, ["k"]).orderBy("batch_id").collect()
    assert [r["n"] for r in packed] == [7, 7, 7, 7, 2]
    assert [x["k"] for x in packed[0]["rows"]] == list(range(7))
