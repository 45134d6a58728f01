import random

import pytest

from sluice.llm import pieces, queries
from tests.llm.conftest import edge_rows

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoder():
    return pieces.PieceEncoder(PATH)


def test_without_dropout_pieces_are_the_librarys(encoder, documents):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=PATH)
    r = random.Random(1)
    texts = [d["text"] for d in documents.limit(150).collect()]
    texts += ["", " ", "  a   b ", "a\n\n\tb", "naïve café 日本語 🙂 \x00\x1f", "x" * 300] + [
        "".join(r.choice(" abcde\nÄé.▁,12"[:13]) for _ in range(60)).replace("▁", "") for _ in range(100)]
    plain = pieces.Segmenter(encoder, dropout=0.0)
    for t in texts:
        assert plain.encode(t, b"n") == library.encode(t)


def test_dropout_varies_and_decodes(encoder):
    text = "The generalised segmentation of wonderful sentences is international. " * 3 + "▁ own ▁▁ marks▁"
    plain = pieces.Segmenter(encoder, dropout=0.0).encode(text, b"1")
    seen = set()
    for seed in range(20):
        s = pieces.Segmenter(encoder, 0.1, seed)
        ids = s.encode(text, b"1")
        assert ids == pieces.Segmenter(encoder, 0.1, seed).encode(text, b"1")
        assert encoder.decode(ids) == text
        seen.add(tuple(ids))
    assert len(seen) == 20 and tuple(plain) not in seen
    everything = pieces.Segmenter(encoder, 1.0).encode(text, b"1")
    assert encoder.decode(everything) == text and len(everything) >= len(text)
    assert encoder.decode(plain) == text


def test_share_of_skipped_merges(encoder):
    many = [f"{a}{b}" for a in ("inter", "over", "under", "trans") for b in ("national", "view", "stand", "form", "port", "lay")]
    one = sum(map(len, encoder.encode_chunks(["▁" + w for w in many], [0] * len(many), 0.0)))
    ten = sum(map(len, encoder.encode_chunks(["▁" + w for w in many for _ in range(50)], [k * 7919 for _ in many for k in range(50)], 0.1))) / 50
    assert one < ten < 2 * one


def test_heap_and_side_by_side_agree(encoder):
    r = random.Random(3)
    for n in range(2, 60):
        for _ in range(20):
            chunk = "▁" + "".join(r.choice("etaoinshrdl,▁"[:12]) for _ in range(n))
            for key, dropout in ((n, 0.0), (n * 31, 0.1), (n * 77, 0.5)):
                if n < pieces.LONG:
                    assert encoder._by_heap(chunk, key, dropout) == encoder.encode_chunks([chunk, "▁the"], [key, 1], dropout)[0]


def test_hash_is_uniform():
    got = [pieces._hash(k * 7919, p, i) for k in range(20) for p in range(10) for i in range(300, 400)]
    share = sum(x < int(0.1 * pieces._RANGE) for x in got) / len(got)
    assert abs(share - 0.1) < 0.01 and len(set(got)) > 0.99 * len(got)


def test_cache_generations_change_nothing(encoder, documents, monkeypatch):
    texts = [d["text"] for d in documents.limit(20).collect()]
    want = [pieces.Segmenter(encoder).encode(t, b"k") for t in texts]
    monkeypatch.setattr(pieces, "KEPT", 50)
    small = pieces.Segmenter(encoder)
    assert [small.encode(t, b"k") for t in texts] == want


def test_query_and_edges(spark, tables, documents, edge, empty):
    texts = {d["doc_id"]: d["text"] for d in documents.collect()}
    rows = queries.op5_piece_dropout(spark, tables)
    assert all(r["lossless"] and len(r["ids"]) == r["n_pieces"] for r in rows.collect())
    back = pieces.decode_documents(rows, PATH).collect()
    assert {r["doc_id"]: r["text"] for r in back} == texts
    out = pieces.encode_documents(edge, PATH, keep=("doc_id", "n_chars")).collect()
    assert len(out) == len(edge_rows())
    for r in out:
        if r["doc_id"] == 1:
            assert (r["ids"], r["n_pieces"], r["lossless"]) == (None, 0, None)
        else:
            assert r["lossless"]
    again = pieces.decode_documents(pieces.encode_documents(edge, PATH, keep=("doc_id",)), PATH).collect()
    assert sorted((r["text"] or "-") for r in again) == sorted((t or "-") for _, t, *_ in edge_rows())
    assert pieces.encode_documents(empty, PATH).collect() == []
