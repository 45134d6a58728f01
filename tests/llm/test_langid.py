import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import langid, queries


@pytest.fixture(scope="module")
def model(documents):
    return langid.fit(documents, learn=~langid.held_out(F.col("doc_id")))


def test_held_out_accuracy_and_contract(spark, tables, documents):
    rows = {r["doc_id"]: r for r in queries.op1_language_id(spark, tables).collect()}
    docs = documents.collect()
    assert len(rows) == len(docs)
    held = [d for d in docs if zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0]
    assert {d["doc_id"] for d in held} == {k for k, r in rows.items() if r["held_out"]}
    right = sum(rows[d["doc_id"]]["lang_pred"] == d["lang"] for d in held)
    assert right / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_counts_are_those_of_all_learned_rows(documents, model):
    n = np.full((langid.N_FEATURES, len(model.langs)), 0.5)
    for d in documents.collect():
        if zlib.crc32(str(d["doc_id"]).encode()) % 5:
            np.add.at(n[:, model.langs.index(d["lang"])], langid.features(d["text"].encode()), 1)
    assert np.allclose(model.logp, np.log(n / n.sum(axis=0)), atol=1e-5)


def _likelihood(raw, logp, chosen):
    f, c = np.unique(langid.features(raw), return_counts=True)
    p, share = np.exp(logp[f][:, chosen].astype(float)), np.full(len(chosen), 1 / len(chosen))
    for _ in range(500):
        q = p * share
        share = (c / q.sum(axis=1)) @ q / c.sum()
    return c @ np.log(p @ share) / 3, share


def test_mixture_matches_a_search_of_all_sets(documents, model):
    by = {}
    for d in documents.collect():
        if len(d["text"]) > 1500 and "|" not in d["text"]:
            by.setdefault(d["lang"], []).append(d["text"])
    texts = [by["en"][0][:1200], by["fr"][0][:700] + " " + by["en"][1][:700], by["de"][0][:400] + " " + by["es"][0][:900],
             by["en"][2][:600] + " " + by["fr"][1][:600] + " " + by["de"][1][:600]]
    for text, n in zip(texts, (1, 2, 2, 3), strict=True):
        raw = text.encode()
        total = len(langid.features(raw)) / 3
        best = max((_likelihood(raw, model.logp, list(s))[0] - (len(s) - 1) * (4 + 0.5 * np.log(total)), s)
                   for k in range(1, 5) for s in combinations(range(4), k))[1]
        chosen, share = langid.mixture(raw, model.logp)
        assert sorted(chosen) == list(best) and len(best) == n
        assert np.allclose(share, _likelihood(raw, model.logp, list(chosen))[1], atol=0.03)


def test_edges(spark, edge, empty):
    model = langid.fit(edge)
    assert model.langs == ["de", "en", "fr", "ja"]
    out = langid.identify(edge, model, keep=("doc_id", "n_chars")).collect()
    assert len(out) == 15
    by = {r["doc_id"]: r for r in out}
    assert [(by[i]["lang_pred"], by[i]["score"]) for i in (1, 2, 3, 4)] == [("und", 0.0)] * 4
    assert by[9]["lang_pred"] == "ja"
    nothing = langid.fit(empty)
    assert nothing.langs == [] and langid.identify(empty, nothing).collect() == []
    assert {r["lang_pred"] for r in langid.identify(edge, nothing).collect()} == {"und"}


def test_more_languages_than_a_block_holds(spark, documents, model, monkeypatch):
    docs = documents.where("length(text) > 50").limit(60)
    want = {r["doc_id"]: (r["lang_pred"], r["score"], r["mixture"]) for r in langid.identify(docs, model).collect()}
    monkeypatch.setattr(langid, "BLOCK_LANGUAGES", 3)
    blocked = langid.fit(documents, learn=~langid.held_out(F.col("doc_id")))
    assert [b.shape[1] for b in blocked.blocks] == [3, 1] and blocked.langs == model.langs
    assert {r["doc_id"]: (r["lang_pred"], r["score"], r["mixture"]) for r in langid.identify(docs, blocked).collect()} == want


def test_three_hundred_languages(spark):
    import random

    r = random.Random(3)
    rows = []
    for k in range(300):
        letters = r.sample("abcdefghijklmnopqrstuvwxyzäöüßñç", 7)
        word = lambda: "".join(r.choice(letters) for _ in range(r.randint(3, 8)))
        rows += [(k * 2 + i, " ".join(word() for _ in range(150)), f"l{k:03d}") for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert len(model.langs) == 300 and len(model.blocks) == 2
    got = {x["doc_id"]: x["lang_pred"] for x in langid.identify(df, model).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) == 600
