import random

import pytest

from sluice.llm import queries, tokencount
from tests.llm.conftest import edge_rows

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def count(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_query_matches_the_library(spark, tables, documents, library):
    texts = {d["doc_id"]: d["text"] for d in documents.collect()}
    rows = queries.op10_token_counts(spark, tables).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = count(library, texts[r["doc_id"]])
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 1024)


def test_hard_texts(library):
    counter = tokencount.PieceCounter(PATH)
    r = random.Random(2)
    alphabet = list("abAB '’\n\t  \r\x0b\x1c\x85\xa0éß12٣½²_-.,!<|>日本🙂́ ­Ǆ") + ["<|endoftext|>", "'s", "'ll", "'S", "   ", "​", "ſ"]
    texts = ["", "<|endoftext|>", "<|endoftext|><|endoftext|> a", "a <|endoftext|>", "<|endoftext", "it's  we'll\n\n x"]
    texts += ["".join(r.choice(alphabet) for _ in range(r.randint(1, 40))) for _ in range(3000)]
    for t in texts:
        tokens, added = counter.pre_tokens(t)
        assert added + sum(map(counter.pieces, tokens)) == count(library, t), repr(t)


def test_edges_and_small_cache(edge, empty, library, monkeypatch):
    out = tokencount.count_tokens(edge, PATH, keep=("doc_id", "text")).collect()
    assert len(out) == len(edge_rows())
    for r in out:
        assert r["n_tokens"] == count(library, r["text"]) and r["n_bytes"] == len((r["text"] or "").encode())
    assert tokencount.count_tokens(empty, PATH).collect() == []


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        tokencount.PieceCounter(public_tokenizers.path("word_bpe_49k.json"))


def test_many_blocks_and_a_hot_pre_token(spark, library, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(tokencount, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(tokencount, "KEPT", 50)
    i = F.col("id")
    docs = spark.range(0, 1200, 1, 3).select((i % 1000).alias("doc_id"), F.concat_ws(" ", F.lit("xqzzkwort xqzzkwort"), F.concat(F.lit("w"), i % 97, F.lit("gk")), F.lit("the")).alias("text"))
    rows = tokencount.count_tokens(docs, PATH, keep=("doc_id", "text")).collect()
    assert len(rows) == 1200
    counts = {}
    for r in rows:
        assert r["n_tokens"] == counts.setdefault(r["text"], count(library, r["text"]))


def test_packed_numbers_come_back():
    import numpy as np

    r = np.random.default_rng(3)
    for n in (1, 3, 4, 5, 1000):
        x = (r.integers(0, 2 ** 32, n) >> r.integers(0, 32, n)).astype(np.int64)
        assert tokencount.unpacked(tokencount.packed(x), n).tolist() == x.tolist()
