"""Plan-level checks: pushdown, pruning and file selection reach the scan."""

import os

import pytest
from pyspark.sql import functions as F

from sluice.sources.apipages import api_pages_flatten, dangling_pages
from sluice.sources.files import numbered_lines
from sluice.sources.scan import projected_scan

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF), reason="supplied tables not present")
def test_projected_scan_pushes_filters_and_prunes(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    plan = _plan(projected_scan(o, ["o_orderkey"], "WHERE o_totalprice > 1000"))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,1000.0)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_file_selection_prunes_files(spark, tmp):
    for name in ("keep-1.txt", "keep-2.txt", "skip-1.txt"):
        with open(os.path.join(tmp, name), "w") as f:
            f.write("a\nb\n")
    d = numbered_lines(spark, tmp, pattern=".*/keep-[0-9]+\\.txt")
    assert sorted(os.path.basename(p) for p in d.inputFiles() if p.endswith(".txt")) == ["keep-1.txt", "keep-2.txt"]
    assert d.count() == 4


def test_api_pages(spark):
    pages = spark.createDataFrame([
        ("u1", '{"results":[{"a":1},{"a":2}],"pagination":{"next":"u2"}}'),
        ("u2", '{"results":[{"a":3},{"a":4}],"pagination":{"next":"u3"}}'),
        ("u3", '{"results":[{"a":5},{"a":6}],"pagination":{"next":null}}')], "url string, body string")
    flat = api_pages_flatten(pages, next_path="$.pagination.next")
    vals = sorted(r[0] for r in flat.select(F.variant_get("item", "$.a", "int")).collect())
    assert vals == [1, 2, 3, 4, 5, 6]
    assert {r["url"] for r in flat.where("is_last").collect()} == {"u3"}
    assert dangling_pages(flat.where("url != 'u2'")).collect()[0]["url"] == "u2"


def test_page_positions(spark):
    from sluice.sources.apipages import page_positions

    chain = [("p3", "p4"), ("p1", "p2"), ("p4", None), ("p2", "p3"), ("q1", "q2"), ("q2", "gone")]
    pos = {r["url"]: (r["chain"], r["page_pos"]) for r in page_positions(
        spark.createDataFrame(chain, "url string, next_url string")).collect()}
    assert pos == {"p1": ("p4", 0), "p2": ("p4", 1), "p3": ("p4", 2), "p4": ("p4", 3),
                   "q1": ("q2", 0), "q2": ("q2", 1)}
    n = 300
    long_chain = [(f"u{i}", f"u{i + 1}" if i + 1 < n else None) for i in range(n)]
    got = {r["url"]: r["page_pos"] for r in page_positions(
        spark.createDataFrame(long_chain, "url string, next_url string")).collect()}
    assert got == {f"u{i}": i for i in range(n)}


def test_page_positions_cycle(spark):
    import pytest

    from sluice.sources.apipages import page_positions

    with pytest.raises(RuntimeError, match="cycle"):
        page_positions(spark.createDataFrame([("a", "b"), ("b", "a")], "url string, next_url string"))


def test_landing_prunes_folders_and_counts_lines_only_when_asked(spark, tmp):
    from sluice.sources.landing import variant_landing

    spark.createDataFrame([("a", '{"k":1}'), ("b", '{"k":2}')], "kind string, value string").write.partitionBy("kind").text(tmp + "/in")
    some = variant_landing(spark, tmp + "/in", keep=["kind"], where=F.col("kind") == "a", line_numbers=False)
    plan = _plan(some)
    assert "PartitionFilters: [isnotnull(kind#" in plan and plan.count("FileScan") == 1 and "Join" not in plan
    assert [r["origin_str"] for r in some.collect()] == ['{"k":1}']
    numbered = variant_landing(spark, tmp + "/in", keep=["kind"], where=F.col("kind") == "b")
    assert "PartitionFilters: [isnotnull(kind#" in _plan(numbered)
    assert [(r["kind"], r["origin_file_line"]) for r in numbered.collect()] == [("b", 1)]


def test_equal_leading_keys_are_split_between_tasks(spark):
    from sluice.operators.batching import global_rank

    rows = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("j"))
    ranked = global_rank(rows, ["k", "j"], "rank", partitions=8)
    per_file = [spark.read.parquet(f).count() for f in set(ranked.inputFiles())]
    assert sum(per_file) == 20_000 and max(per_file) <= 2 * 20_000 / 8
    assert ranked.where(F.col("rank") != F.col("j") + 1).isEmpty() and ranked.count() == 20_000
