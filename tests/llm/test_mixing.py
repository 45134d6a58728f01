from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sluice.llm import mixing, queries
from tests.llm.conftest import edge_rows


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, full = {}, {s for s in names if not sizes[s]}
    while True:
        rest = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        free = sum(w[s] for s in names if s not in full)
        if not free:
            break
        level = rest / free
        more = {s for s in names if s not in full and most * sizes[s] <= level * w[s]}
        if not more:
            break
        full |= more
    for s in names:
        target[s] = most * sizes[s] if s in full else level * w[s]
    return target


def check(rows, near):
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
    want, taken = brute_targets(sizes), Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"] and len(r["shards"]) == (-(-r["taken"] // r["size"]) if r["size"] else len(r["shards"]))
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= near + 1, s
    cut = Counter(r["source"] for r in rows if r["size"] and r["taken"] % r["size"])
    assert not cut or max(cut.values()) == 1


def test_query_contract(spark, tables, documents):
    rows = queries.op7_mix(spark, tables).collect()
    assert len(rows) == documents.count()
    check(rows, 0)
    again = {(r["doc_id"], r["taken"], tuple(r["shards"])) for r in queries.op7_mix(spark, tables).collect()}
    assert again == {(r["doc_id"], r["taken"], tuple(r["shards"])) for r in rows}


@pytest.fixture(scope="module")
def many(spark):
    # source 0 holds a third of all rows
    i = F.col("id")
    return mixing.written(spark.range(6000).select(
        i.alias("doc_id"), F.when(i % 3 == 0, "s0").when(i % 7 == 0, None).otherwise(F.concat(F.lit("s"), i % 11)).alias("source"),
        (F.pmod(F.xxhash64("id"), F.lit(90)) + 1).alias("size")).select(
        "doc_id", mixing.null_first_key(F.col("source")).alias("key"), "source", "size", mixing.position(1, 0, F.col("doc_id")).alias("place")), "t")


def test_targets_are_met_with_many_documents(many):
    check(mixing.assigned(many, mixing.plan(many, 8, block_words=500)).collect(), 0)


def test_blocks_are_dealt_whole_and_evenly(many):
    plan = mixing.plan(many, 8, block_words=500)
    quotas = plan.quotas.collect()
    by_shard, by_source = Counter(), defaultdict(list)
    for q in quotas:
        by_shard[q["shard"]] += q["quota"]
        by_source[q["key"], q["pass"]].append((q["start"], q["quota"]))
    assert max(by_shard.values()) - min(by_shard.values()) <= 3 and len(by_shard) == 8
    for runs in by_source.values():  # disjoint runs without gaps
        at = 0
        for start, n in sorted(runs):
            assert start == at
            at += n
    copies = mixing.drawn(many, plan).collect()
    blocks = {(r["key"], r["pass"], r["block"]): r["shard"] for r in plan.deal.collect()}
    assert sum(q["quota"] for q in quotas) == len(blocks)
    taken = mixing.assigned(many, plan).agg(F.sum("taken")).first()[0]
    assert sum(r["words"] for r in copies) == taken
    assert len({(r["doc_id"], r["pass"]) for r in copies}) == len(copies)


def test_tree_draws_are_hypergeometric(spark):
    """Mean and variance, over seeds, of what one source has in the first of four shards."""
    drawn = spark.createDataFrame([("+a", 0, 40), ("+b", 0, 60)], "key string, pass int, quota long")
    got = []
    for seed in range(40):
        got.append(sum(r["quota"] for r in mixing.split_tree(drawn, 4, seed).where("key = '+a' and shard = 0").collect()))
    mean = sum(got) / len(got)
    var = sum((x - mean) ** 2 for x in got) / len(got)
    assert abs(mean - 10) < 1.2 and 1.5 < var < 10  # 25 of 100, 40 of the kind: mean 10, variance 4.5


def test_edges(edge, empty):
    rows = mixing.records(edge)
    plan = mixing.plan(rows, 3, block_words=1000)
    out = mixing.assigned(rows, plan).collect()
    assert len(out) == len(edge_rows())
    assert all(r["taken"] <= 2 * r["size"] for r in out)
    mixed = mixing.mix_documents(edge, plan)
    assert mixed.columns == edge.columns
    assert 0 <= sum(len(r["shards"]) for r in out) - mixed.count() <= 6
    none = mixing.records(empty)
    plan = mixing.plan(none, 3)
    assert mixing.assigned(none, plan).collect() == [] and mixing.mix_documents(empty, plan).collect() == []


@pytest.fixture(scope="module")
def hot(spark):
    """A third of 20,000 rows is one row of six words."""
    i = F.col("id")
    return spark.range(20_000).select(F.when(i % 3 == 0, 7).otherwise(i).alias("doc_id"),
                                      F.when(i % 3 == 0, "one text of only six words").otherwise(F.concat_ws(" ", F.array_repeat(i.cast("string"), (i % 9 + 1).cast("int")))).alias("text"),
                                      F.when(i % 3 == 0, "s0").otherwise(F.concat(F.lit("s"), i % 4)).alias("source"), F.lit(1).alias("shard"))


def test_equal_rows_meet_their_target_to_the_word(hot):
    rows = mixing.records(hot)
    check(mixing.assigned(rows, mixing.plan(rows, 8, block_words=2000)).collect(), 0)


def test_documents_stand_by_shard_and_shuffle_key(hot):
    rows = mixing.records(hot)
    plan = mixing.plan(rows, 8, block_words=2000)
    copies = mixing.drawn(rows, plan)
    # the stage keeps documents whole: a part copy counts as whole if it has half of the words or more
    want = Counter(r["doc_id"] for r in copies.where("2 * words >= size").collect())
    mixed = mixing.mix_documents(hot, plan)
    assert mixed.columns == hot.columns
    got = mixed.collect()
    assert Counter(r["doc_id"] for r in got) == want
    order = [r["doc_id"] for r in copies.where("2 * words >= size").orderBy("shard", "shuffle_key").collect()]
    assert [r["doc_id"] for r in got] == order  # shards one after the other, each in its own order
    assert order != sorted(order)
