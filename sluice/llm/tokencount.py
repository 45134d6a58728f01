"""Token counts without ids: pieces are counted once per distinct pre-token and joined to pre-token frequencies."""

from __future__ import annotations

import json
import os
import re
import struct
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes

# The split pattern of byte-level tokenizers of this kind.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts of these characters alone are split here; their classes are the same in every version of Unicode. Any other text is
#: split by the tokenizer's own pre-tokenizer.
_PLAIN = re.compile("[\x00-\x1b\x20-\x7e\xa1-ɏ]*")
#: Text of a block of documents, in bytes.
BLOCK_BYTES = 8 << 20
#: Distinct pre-tokens whose counts a partition keeps before it starts anew: far above a partition's share with enough partitions.
KEPT = 2_000_000


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, and that byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _texts_of(vocabulary: Iterable[str], byte: dict[str, int]) -> Iterator[str]:
    """The pieces that are whole texts."""
    for piece in vocabulary:
        try:
            yield bytes(map(byte.__getitem__, piece)).decode()
        except (KeyError, UnicodeDecodeError):
            continue


class PieceCounter:
    """Splits texts into pre-tokens as a tokenizer of the ``tokenizers`` library does, and counts a pre-token's pieces."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = spec.get("added_tokens") or []
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added) or spec.get("normalizer"):
            raise ValueError("this tokenizer's added tokens or normalizer don't act on pre-tokens alone")
        # where one added token begins another, the longer one is found first
        names = sorted((t["content"] for t in added), key=lambda x: (-len(x), x))
        self.added = re.compile("|".join(map(re.escape, names))) if names else None
        pre = spec.get("pre_tokenizer") or {}
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("only byte-level pre-tokenizers without a prefix space are supported")
        self.pattern = regex.compile(BYTE_LEVEL)
        self.byte = _byte_alphabet()
        self.char = {b: c for c, b in self.byte.items()}
        self.vocabulary = self.tokenizer.get_vocab()
        #: The pre-tokens that are a piece as they stand.
        self.single = frozenset(_texts_of(self.vocabulary, self.byte))

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text, and the number of added tokens in it."""
        parts = self.added.split(text) if self.added else [text]
        out: list[str] = []
        for part in parts:
            if _PLAIN.fullmatch(part):
                out += self.pattern.findall(part)
            else:
                out += [bytes(map(self.byte.__getitem__, x)).decode() for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)]
        return out, len(parts) - 1

    def pieces(self, token: str) -> int:
        mapped = "".join(map(self.char.__getitem__, token.encode()))
        return 1 if mapped in self.vocabulary else len(self.tokenizer.model.tokenize(mapped))


@lru_cache(maxsize=2)
def _counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def packed(x: np.ndarray) -> bytes:
    """Numbers below 2^32: two bits of length each, then the bytes that each needs."""
    size = 1 + (x > 0xFF) + (x > 0xFFFF) + (x > 0xFFFFFF)
    heads = (np.append(size - 1, np.zeros(-len(size) % 4, np.int64)).reshape(-1, 4) << np.array([0, 2, 4, 6])).sum(axis=1).astype(np.uint8)
    return heads.tobytes() + x.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]].tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers that :func:`packed` took."""
    raw = np.frombuffer(data, np.uint8)
    heads = raw[:-(-n // 4)]
    size = (((heads[:, None] >> np.array([0, 2, 4, 6], np.uint8)) & 3) + 1).reshape(-1)[:n]
    out = np.zeros((n, 4), np.uint8)
    out[np.arange(4) < size[:, None]] = raw[len(heads):]
    return out.view("<u4").reshape(-1).astype(np.int64)


class Block:
    """Documents side by side, with the frequencies of their pre-tokens that are no piece of the vocabulary by themselves."""

    def __init__(self):
        self.size, self.single, self.n_bytes = 0, [], []
        self.place: dict[str, int] = {}
        self.who, self.what, self.often = array("I"), array("I"), array("I")

    def add(self, raw: bytes, counter: PieceCounter) -> None:
        tokens, ones = counter.pre_tokens(raw.decode())
        k, place = len(self.single), self.place
        for token, n in Counter(tokens).items():
            if token in counter.single:
                ones += n
            else:
                self.who.append(k)
                self.what.append(place.setdefault(token, len(place)))
                self.often.append(n)
        self.single.append(ones)
        self.n_bytes.append(len(raw))
        self.size += len(raw) + 100

    def parts(self, parts: int) -> Iterator[tuple[int, int, bytes, int, bytes]]:
        """(partition, number of texts, texts, number of frequencies, frequencies) of every partition that a text is dealt to."""
        raw = [t.encode() for t in self.place]
        part = np.fromiter((xxhash.xxh64_intdigest(x) % parts for x in raw), np.int64, len(raw))
        by_part = np.argsort(part, kind="stable")
        first = np.searchsorted(part[by_part], np.arange(parts + 1))
        number = np.empty(len(raw), np.int64)
        number[by_part] = np.arange(len(raw)) - first[part[by_part]]
        who, what, often = (np.frombuffer(x, np.uint32).astype(np.int64) for x in (self.who, self.what, self.often))
        order = np.argsort(part[what], kind="stable")
        edge = np.searchsorted(part[what][order], np.arange(parts + 1))
        for p in np.unique(part).tolist():
            texts, rows = [raw[i] for i in by_part[first[p]:first[p + 1]].tolist()], order[edge[p]:edge[p + 1]]
            lengths = packed(np.fromiter(map(len, texts), np.int64, len(texts)))
            columns = [packed(np.diff(who[rows], prepend=0)), packed(number[what[rows]]), packed(often[rows])]
            yield p, len(texts), lengths + b"".join(texts), len(rows), _joined(columns)


def _joined(parts: list[bytes]) -> bytes:
    return struct.pack(f"<{len(parts)}I", *map(len, parts)) + b"".join(parts)


def _split(data: bytes, n: int) -> list[bytes]:
    sizes, out, at = struct.unpack_from(f"<{n}I", data), [], 4 * n
    for size in sizes:
        out.append(data[at:at + size])
        at += size
    return out


def _texts(data: bytes, n: int) -> list[bytes]:
    heads = np.frombuffer(data, np.uint8)[:-(-n // 4)]
    size = (((heads[:, None] >> np.array([0, 2, 4, 6], np.uint8)) & 3) + 1).reshape(-1)[:n]
    at = len(heads) + int(size.sum())
    ends = (at + np.cumsum(unpacked(data[:at], n))).tolist()
    return [data[a:b] for a, b in zip([at, *ends], ends)]


def count_tokens(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with ``n_bytes`` (UTF-8) and ``n_tokens``, as the library counts them for the tokenizer file at
    ``path``, which every executor can read. A null text counts as empty (0 and 0). Special strings inside a text are one
    token each, the library's default. Texts are split whole, whatever their length. An empty table gives an empty result.

    Each document becomes frequencies of pre-tokens. Pre-tokens that are a piece themselves count one, by the vocabulary alone. The
    others are dealt by their hash, so that a distinct one meets all of its frequencies in one partition: there its pieces are
    counted once and joined to the frequencies, and the products are summed by document. The sums go back to their documents'
    block. No ids are made. A block of documents sends a partition one row, with each text once and a few bytes a frequency, so a very common
    pre-token is no more than that in every block."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = docs.select(F.col(text).alias("__text"), F.struct(F.lit(0).alias("__none"), *[F.col(c).alias(c) for c in keep]).alias("__keep"))
    kind = kept.schema["__keep"].dataType
    of_document = [T.StructField("block", T.LongType()), T.StructField("at", T.IntegerType()), T.StructField("keep", kind),
                   T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    of_part = [T.StructField("part", T.IntegerType()), T.StructField("n_texts", T.IntegerType()), T.StructField("texts", T.BinaryType()),
               T.StructField("n_often", T.IntegerType()), T.StructField("often", T.BinaryType())]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, seq, task = _counter(path), 0, TaskContext.get().partitionId()
        none = lambda n, kind: pa.nulls(n, kind)
        for batch in batches:
            raws, at = as_bytes(batch.column(0)), 0
            while at < len(raws):
                block, begin = Block(), at
                while at < len(raws) and block.size < BLOCK_BYTES:
                    block.add(raws[at] or b"", counter)
                    at += 1
                name, n = (task << 32) + seq, at - begin
                seq += 1
                own = batch.column(1).slice(begin, n)
                yield pa.record_batch([pa.array([name] * n, pa.int64()), pa.array(range(n), pa.int32()), own, pa.array(block.n_bytes, pa.int64()),
                                       pa.array(block.single, pa.int64()), pa.array([(seq + k) % parts for k in range(n)], pa.int32()), none(n, pa.int32()), none(n, pa.binary()),
                                       none(n, pa.int32()), none(n, pa.binary())], names=names)
                for p, n_texts, texts, n_often, often in block.parts(parts):
                    yield pa.record_batch([pa.array([name], pa.int64()), none(1, pa.int32()), none(1, own.type), none(1, pa.int64()), none(1, pa.int64()),
                                           pa.array([p], pa.int32()), pa.array([n_texts], pa.int32()), pa.array([texts], pa.binary()),
                                           pa.array([n_often], pa.int32()), pa.array([often], pa.binary())], names=names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, pieces = _counter(path), {}
        for batch in batches:
            names_of, sums = [], []
            for name, n_texts, texts, n_often, often in zip(*[batch.column(c).to_pylist() for c in ("block", "n_texts", "texts", "n_often", "often")], strict=True):
                if n_texts is None:
                    continue
                own = _texts(texts, n_texts)
                for t in own:
                    if t not in pieces:
                        pieces[t] = counter.pieces(t.decode())
                each = np.fromiter(map(pieces.__getitem__, own), np.int64, len(own))
                who, what, n = (unpacked(x, n_often) for x in _split(often, 3))
                who = np.cumsum(who)
                total = np.zeros(int(who[-1]) + 1, np.int64)
                np.add.at(total, who, each[what] * n)
                there = np.flatnonzero(total)
                names_of.append(name)
                sums.append((len(there), _joined([packed(np.diff(there, prepend=0)), _wide(total[there])])))
                if len(pieces) > KEPT:
                    pieces.clear()
            documents = batch.filter(pc.is_valid(batch.column("at"))).select(["block", "at", "keep", "n_bytes", "n_tokens"])
            yield pa.record_batch([*documents.columns, pa.nulls(len(documents), pa.int32()), pa.nulls(len(documents), pa.binary())], names=back)
            m = len(sums)
            yield pa.record_batch([pa.array(names_of, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, documents.column(2).type), pa.nulls(m, pa.int64()),
                                   pa.nulls(m, pa.int64()), pa.array([x for x, _ in sums], pa.int32()), pa.array([x for _, x in sums], pa.binary())], names=back)

    def added(block: pa.Table) -> pa.Table:
        documents = block.filter(pc.is_valid(block["at"])).select(["at", "keep", "n_bytes", "n_tokens"]).combine_chunks()
        total = np.zeros(len(documents), np.int64)
        at = documents["at"].to_numpy()
        total[at] = documents["n_tokens"].to_numpy()
        for n, sums in zip(block["n"].to_pylist(), block["sums"].to_pylist(), strict=True):
            if n:
                who, what = _split(sums, 2)
                total[np.cumsum(unpacked(who, n))] += np.frombuffer(what, "<i8")
        fields = documents["keep"].combine_chunks()
        fields = fields.flatten() if isinstance(fields, pa.StructArray) else fields.chunk(0).flatten()
        return pa.table([*fields[1:], documents["n_bytes"], pa.array(total[at])], names=[*keep, "n_bytes", "n_tokens"])

    names, back = [f.name for f in [*of_document, *of_part]], [*[f.name for f in of_document], "n", "sums"]
    dealt = kept.mapInArrow(split, T.StructType([*of_document, *of_part])).repartitionById(parts, F.col("part"))
    summed = dealt.mapInArrow(count, T.StructType([*of_document, T.StructField("n", T.IntegerType()), T.StructField("sums", T.BinaryType())]))
    return summed.groupBy("block").applyInArrow(added, T.StructType([*kind.fields[1:], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]))


def _wide(x: np.ndarray) -> bytes:
    return x.astype("<i8").tobytes()
