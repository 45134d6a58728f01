from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from sluice.llm import queries
from tests.llm.conftest import edge_rows
from tests.llm.test_quality import brute as quality_counts
from tests.llm.test_simhash import brute_components, brute_fingerprint


def test_stages_in_order_on_all_rows(spark, tables, documents):
    assert [n for n, _ in cp.STAGES] == ["language_id", "quality_rules", "near_dedup", "mix", "encode"]
    docs, kept = documents, {}
    for name, stage in cp.STAGES:
        out = cp.written(stage(spark, docs, tables), "t")
        if name != "encode":
            assert out.columns == documents.columns
        kept[name] = [r.asDict() for r in out.collect()]
        before, docs = docs, out
    ids = lambda name: [r["doc_id"] for r in kept[name]]
    all_docs = {r["doc_id"]: r.asDict() for r in documents.collect()}
    assert sorted(ids("language_id")) == sorted(i for i, r in all_docs.items() if any(c.isalpha() for c in r["text"]))
    for i in ids("language_id"):
        c = quality_counts(all_docs[i]["text"])
        if i in ids("quality_rules"):
            assert c[0] >= 50 and 100 * c[4] <= 50 * c[0]
    pairs = [(r["doc_id"], brute_fingerprint(r["text"])) for r in kept["quality_rules"]]
    assert sorted(ids("near_dedup")) == sorted({c for _, _, c in brute_components(pairs)})
    assert set(ids("mix")) <= set(ids("near_dedup")) and max(Counter(ids("mix")).values()) <= 2
    assert all(r in [all_docs[r["doc_id"]]] for r in kept["mix"])
    assert sorted(ids("encode")) == sorted(ids("mix")) and all(r["lossless"] for r in kept["encode"])
    assert "text" not in kept["encode"][0]
    assert queries.pipeline(spark, tables).count() == len(kept["encode"])


@pytest.mark.parametrize("stage", [f for _, f in cp.STAGES], ids=[n for n, _ in cp.STAGES])
def test_edges(spark, edge, empty, stage):
    out = stage(spark, edge, "")
    rows = out.collect()
    if stage is not cp.encode:
        assert out.columns == edge.columns
        want = Counter(tuple(r) for r in edge.collect())
        assert set(map(tuple, rows)) <= set(want)
    else:
        assert len(rows) == len(edge_rows()) and set(edge.columns) - {"text", "ids"} <= set(out.columns)
    if stage is cp.near_dedup:
        assert sum(r["doc_id"] == 7 for r in rows) == 1 and not any(r["doc_id"] == 8 for r in rows)
    assert stage(spark, empty, "").collect() == []


def test_dedup_keeps_one_of_a_third_of_all_rows(spark):
    docs = spark.range(900).select(
        F.when(F.col("id") < 300, F.lit(None)).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") < 400, F.lit("one text that is the same in all of them")).otherwise(F.concat(F.lit("text"), F.col("id"))).alias("text"))
    rows = cp.near_dedup(spark, docs, "").collect()
    assert sum(r["text"].startswith("one") for r in rows) == 1
    assert next(r["doc_id"] for r in rows if r["text"].startswith("one")) == 300
