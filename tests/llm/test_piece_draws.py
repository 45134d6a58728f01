from collections import Counter

import pytest

from sluice.llm import pieces

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def encoder():
    return pieces.PieceEncoder(public_tokenizers.path("piece_bpe_32k.model"))


def one_by_one(encoder, text, name, dropout=pieces.DROPOUT):
    chunks = encoder.split(text)
    keys = pieces._keys(pieces.SEED, name, len(chunks)).tolist()
    return [encoder.encode_chunks([c], [k], dropout)[0] for c, k in zip(chunks, keys, strict=True)]


def test_every_occurrence_draws_by_itself(encoder):
    for word in ("international", "i" * 40 + "nternational"):
        text = " ".join([word] * 2000)
        drawn = one_by_one(encoder, text, b"1")
        assert pieces.Segmenter(encoder).encode(text, b"1") == [x for ids in drawn for x in ids]
        assert len(Counter(map(tuple, drawn))) > 10
    texts, names = ["international"] * 3000, [str(i).encode() for i in range(3000)]
    assert len(set(map(tuple, pieces.Segmenter(encoder).encode_many(texts, names)))) > 10


def test_what_is_kept_changes_no_draw(encoder, documents, monkeypatch):
    rows = [(d["text"], str(d["doc_id"]).encode()) for d in documents.limit(40).collect()]
    want = [[x for ids in one_by_one(encoder, t, n) for x in ids] for t, n in rows]
    whole = pieces.Segmenter(encoder)
    assert whole.encode_many(*map(list, zip(*rows, strict=True))) == want
    assert [whole.encode(t, n) for t, n in rows] == want
    monkeypatch.setattr(pieces, "KEPT", 30)
    small = pieces.Segmenter(encoder)
    assert [small.encode(t, n) for t, n in rows] == want
