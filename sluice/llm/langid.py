"""Language identification as mixture inference over byte n-grams."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, written

#: Features are byte trigrams hashed to 16 bits: the model has 65,536 values a language.
N_FEATURES = 1 << 16
#: Languages of a block of the model (64 MB). A task holds one block at a time, however many languages are learned.
BLOCK_LANGUAGES = 256
UNDETERMINED = "und"

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def features(raw: bytes) -> np.ndarray:
    """Hashed byte trigrams of a text: A-Z folded, other ASCII taken as one blank between words."""
    a = np.frombuffer(b" " + b" ".join(raw.translate(_FOLD).split()) + b" ", np.uint8).astype(np.uint32)
    if len(a) < 3:
        return np.empty(0, np.uint16)
    return ((a[:-2] * 40503 + a[1:-1] * 30011 + a[2:] * 271) * np.uint32(2654435761) >> np.uint32(16)).astype(np.uint16)


def held_out(doc_id: Column) -> Column:
    """True for the fold that is never learned from: crc32 of the id as text, modulo 5, is 0. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    waiting: dict[str, list[np.ndarray]] = {}

    def add() -> None:
        for lang, parts in waiting.items():
            n = counts.setdefault(lang, np.zeros(N_FEATURES, np.int64))
            n += np.bincount(np.concatenate(parts), minlength=N_FEATURES)
        waiting.clear()

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, n in counts.items():
            f = np.flatnonzero(n)
            yield pa.record_batch({"lang": pa.array([lang] * len(f), pa.string()), "feature": pa.array(f, pa.int32()),
                                   "n": pa.array(n[f], pa.int64())})
        counts.clear()

    held = 0
    for batch in batches:
        for lang, raw in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
            waiting.setdefault(lang, []).append(features(raw))
            held += len(raw)
            if held > 1 << 22 or len(waiting) >= 64:
                add()
                held = 0
            if len(counts) >= 64:
                yield from flush()
    add()
    yield from flush()


@dataclass(frozen=True)
class LanguageModel:
    """Log probabilities of the features in blocks of languages: one row a feature, one column a language, in code-point order."""

    langs: list[str]
    blocks: list[np.ndarray]

    @property
    def logp(self) -> np.ndarray:
        return np.concatenate(self.blocks, axis=1) if self.blocks else np.zeros((N_FEATURES, 0), np.float32)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", learn: Column | None = None) -> LanguageModel:
    """Counts over *all* rows with a text and a language (and ``learn``, if given), added up by (language, feature)
    with one row a task, language and feature; add-1/2 smoothing. The counts are collected block by block."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.lit(True) if learn is None else learn))
    counts = written(rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
                     .mapInArrow(_count, "lang string, feature int, n bigint")
                     .groupBy("lang", "feature").agg(F.sum("n").alias("n")), "language-counts")
    # names of languages: a learned language has a text
    langs = sorted((r[0] for r in rows.select(lang).distinct().collect()), key=lambda x: x.encode())
    blocks = []
    for at in range(0, len(langs), BLOCK_LANGUAGES):
        own = langs[at:at + BLOCK_LANGUAGES]
        table = (counts if len(langs) == len(own) else counts.where(F.col("lang").isin(own))).toArrow()  # at most BLOCK_LANGUAGES x N_FEATURES rows
        n = np.full((N_FEATURES, len(own)), 0.5)
        named = table.column("lang").combine_chunks().dictionary_encode()
        column = np.array([own.index(x) for x in named.dictionary.to_pylist()], np.int64)
        if len(table):
            n[table.column("feature").to_numpy(), column[named.indices.to_numpy()]] += table.column("n").to_numpy()
        blocks.append(np.log(n / n.sum(axis=0, keepdims=True)).astype(np.float32))
    return LanguageModel(langs, blocks)


class Inference:
    """The mixture of one text, as far as the blocks of the model that were shown to it tell."""

    def __init__(self, raw: bytes, penalty: float, rounds: int):
        self.f, c = np.unique(features(raw), return_counts=True)
        self.c = c / 3.0
        self.total = self.c.sum()
        self.rounds, self.cost = rounds, penalty + 0.5 * np.log(max(self.total, 1.0))
        self.chosen: list[int] = []
        self.share, self.mixed, self.columns = np.empty(0), None, None
        self.done = False
        self._begin()

    def _begin(self) -> None:
        self.best, self.gain, self.column = -1, -np.inf if not self.chosen else self.cost, None

    def show(self, logp: np.ndarray, first: int) -> None:
        """Compare the languages of a block, numbered from ``first``, with the best so far."""
        lp = logp[self.f].astype(np.float64)
        if not self.chosen:
            score = self.c @ lp
            k = int(np.argmax(score)) if len(score) else 0
            if len(score) and score[k] > self.gain:
                self.best, self.gain, self.column = first + k, score[k], lp[:, k]
            return
        for k in range(lp.shape[1]):
            if first + k not in self.chosen:
                got = self._gain(np.exp(lp[:, k] - self.mixed))
                if got > self.gain:
                    self.best, self.gain, self.column = first + k, got, lp[:, k]

    def _gain(self, ratio: np.ndarray) -> float:
        """What a language adds to the likelihood with its best share, or less than the best gain so far."""
        c, total, gain = self.c, self.total, self.gain
        if c @ ratio - total <= gain:
            return 0.0
        t, got = 0.1, 0.0
        for _ in range(self.rounds):
            denominator = (1 - t) + t * ratio
            got = c @ np.log(denominator)
            new = t * (c @ (ratio / denominator)) / total
            # concave: what is left to gain lies under the tangent at t
            slope = (c @ ((ratio - 1) / denominator))
            if got + max(slope * (1 - t), -slope * t) <= gain:
                break
            if abs(new - t) < 1e-3:
                break
            t = new
        return got

    def step(self, languages: int) -> None:
        """After all blocks were shown: take the best language in, or end."""
        if self.best < 0 or len(self.chosen) == languages:
            self.done = True
            return
        self.chosen.append(self.best)
        self.columns = self.column[:, None] if self.columns is None else np.column_stack([self.columns, self.column])
        self.share = np.append(self.share * 0.9, 0.1) if len(self.share) else np.ones(1)
        if len(self.chosen) == 1:
            self.mixed = self.columns[:, 0]
        else:
            top = self.columns.max(axis=1)
            p = np.exp(self.columns - top[:, None])
            for _ in range(4 * self.rounds):
                q = p * self.share
                new = (self.c / q.sum(axis=1)) @ q / self.total
                done = np.abs(new - self.share).max() < 1e-4
                self.share = new
                if done:
                    break
            self.mixed = np.log((p * self.share).sum(axis=1)) + top
        self.done = len(self.chosen) == languages
        self._begin()


def mixtures(raws: list[bytes], blocks: Iterable[Callable[[], np.ndarray]], languages: int, penalty: float = 4.0, rounds: int = 25) -> list[tuple[np.ndarray, np.ndarray]]:
    """The selected languages and their proportions for each text.

    Languages join greedily, the one that raises the likelihood most first, while the gain exceeds
    ``penalty`` + half the log of the number of n-grams. Overlapping trigrams count a third each.
    Likelihoods are concave in the proportions, so the slope at zero bounds a language's gain: where the
    slope stays under the penalty no iteration is needed. In each round all texts that go on meet one block of the model
    after the other, so the number of blocks changes no result."""
    texts = [Inference(raw, penalty, rounds) for raw in raws]
    going = texts
    while going:
        first = 0
        for block in blocks:
            table = block()
            for t in going:
                t.show(table, first)
            first += table.shape[1]
        for t in going:
            t.step(languages)
        going = [t for t in going if not t.done]
    return [(np.array(t.chosen), t.share / t.share.sum()) for t in texts]


def mixture(raw: bytes, logp: np.ndarray, penalty: float = 4.0, rounds: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """:func:`mixtures` of one text under a model of one block."""
    return mixtures([raw], [lambda: logp], logp.shape[1], penalty, rounds)[0]


def _has_letter(raw: bytes) -> bool:
    return any(map(str.isalpha, raw.decode("utf-8", "replace")))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
             penalty: float = 4.0) -> DataFrame:
    """``keep`` columns of every row with ``lang_pred``, ``score`` (the language's share) and ``mixture``
    (JSON, language to share, of the selected set).

    ``und`` with score 0 and an empty mixture where the text is null, empty or has no letter, or where no language
    was learned. Ties go to the language first in code-point order. Texts are read whole, whatever their length;
    repeated rows each get a row. An empty table gives an empty result."""
    langs = model.langs
    shared = [docs.sparkSession.sparkContext.broadcast(b) for b in model.blocks]

    def table(block) -> np.ndarray:
        """A block of the model; of several, the worker holds one at a time."""
        if len(shared) > 1:
            for other in shared:
                if other is not block:
                    other.__dict__.pop("_value", None)
        return block.value

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [partial(table, b) for b in shared]
        for batch in batches:
            raws = as_bytes(batch.column(0))
            there = [i for i, raw in enumerate(raws) if raw is not None and langs and _has_letter(raw)]
            pred, score, mix = [UNDETERMINED] * len(raws), [0.0] * len(raws), ["{}"] * len(raws)
            size = len(there) if len(shared) > 1 else 1  # with one block, a text at a time
            for at in range(0, len(there), max(1, size)):
                some = there[at:at + size]
                for i, (chosen, share) in zip(some, mixtures([raws[i] for i in some], blocks, len(langs), penalty), strict=True):
                    order = sorted(range(len(chosen)), key=lambda k: (-share[k], chosen[k]))
                    pred[i], score[i] = langs[chosen[order[0]]], float(min(1.0, share[order[0]]))
                    mix[i] = json.dumps({langs[chosen[k]]: round(float(share[k]), 4) for k in order}, ensure_ascii=False)
            out = [batch.column(i + 1) for i in range(len(keep))]
            yield pa.record_batch([*out, pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                                   pa.array(mix, pa.string())], names=[*keep, "lang_pred", "score", "mixture"])

    kept = docs.select(F.col(text).alias("__text"), *[F.col(c) for c in keep])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[1:])
    return kept.mapInArrow(predict, f"{fields}, lang_pred string, score double, mixture string")
