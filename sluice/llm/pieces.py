"""Byte-pair encoding with seeded merge-dropout for SentencePiece vocabularies, and its exact decoding."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, pairwise, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes

BLANK = "▁"
#: Stands for a blank mark that the text itself holds; no valid text holds this code point. It is encoded as bytes, so that
#: decoding can tell it from a blank.
_OWN_BLANK = "\udc81"
#: Share of candidate merges that are skipped.
DROPOUT = 0.1
SEED = 11
#: Chunks up to this length are kept with their decision trees, so many at most, with so many nodes.
KEEP_LENGTH, KEPT, NODES = 32, 300_000, 3_000_000
#: Chunks that are encoded at a time.
AT_ONCE = 60_000
_BANDS = np.array([4, 6, 8, 10, 13, 18, 24, 32])
_SLOT_BITS = 20
_SLOTS = 1 << _SLOT_BITS
#: A branch of a decision tree that no occurrence took yet.
_MISSING = -1
#: Chunks above this length have a heap each; up to it, so many symbols go side by side, in bands of like length.
LONG, SIDE_BY_SIDE = 32, 400_000
_RANGE = 1 << 30
_NONE = 1 << 30
_MASK = _RANGE - 1


def _candidate(place, piece):
    """What a candidate adds to its occurrence's key."""
    return place * 40503 + piece * 625_010_129


def _hash(key, place, piece):
    """A number below 2^30 for a candidate, or an array of them; no step leaves 64 bits."""
    return _mixed(key + _candidate(place, piece))


def _mixed(x):
    x = x & _MASK
    x = ((x ^ (x >> 15)) * 0x2C1B3C6D) & 0x3FFFFFFF
    x = ((x ^ (x >> 12)) * 0x297A2D39) & 0x3FFFFFFF
    return x ^ (x >> 15)


def _slices(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places starts[k], starts[k] + 1, .. (n[k] of them) of all k in a row."""
    ends = np.cumsum(n)
    return np.repeat(starts - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)


@dataclass
class Runs:
    """Agendas that were run: the ids of each chunk, and the candidates that it tested, in order, with what became of them."""

    ids: np.ndarray
    n_ids: np.ndarray
    tested: np.ndarray
    skipped: np.ndarray
    n_tested: np.ndarray

    @staticmethod
    def none() -> Runs:
        return Runs(np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, bool), np.empty(0, np.int64))

    @staticmethod
    def joined(parts: list[Runs]) -> Runs:
        return Runs(*[np.concatenate([getattr(p, f.name) for p in parts]) for f in fields(Runs)])

    def taken(self, which: np.ndarray) -> Runs:
        """The runs at the given places, in that order."""
        at = _slices((np.cumsum(self.n_ids) - self.n_ids)[which], self.n_ids[which])
        tests = _slices((np.cumsum(self.n_tested) - self.n_tested)[which], self.n_tested[which])
        return Runs(self.ids[at], self.n_ids[which], self.tested[tests], self.skipped[tests], self.n_tested[which])


def _slot(key: np.ndarray) -> np.ndarray:
    return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)


class PieceEncoder:
    """Merges and decoding tables of a BPE model of the ``sentencepiece`` library with byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.ids, self.text, self.scores = {}, [], []
        self.byte = [-1] * 256
        for i in range(n):
            piece = model.id_to_piece(i)
            self.scores.append(model.get_score(i))
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte[value] = i
                self.text.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.text.append(b"")
            else:
                self.ids[piece] = i
                self.text.append(piece.replace(BLANK, " ").encode())
        self.text_size = np.fromiter(map(len, self.text), np.int64, n)
        self.text_start = np.cumsum(self.text_size) - self.text_size
        self.text_bytes = np.frombuffer(b"".join(self.text), np.uint8)
        if min(self.byte) < 0:
            raise ValueError("the model has no byte fallback, so not every text can be decoded")
        order = {x: i for i, x in enumerate(sorted({-x for x in self.scores}))}
        #: The place of each piece's score among all scores, the best first; equal scores share it.
        self.rank = {p: order[-self.scores[i]] for p, i in self.ids.items()}
        self.n_pieces = n
        #: Characters that stand in pieces without being one have symbols of their own.
        self.others = sorted({c for p in self.ids for c in p if c not in self.ids})
        self.symbol = np.full(0x110000, -1, np.int64)
        for i, c in enumerate(self.others):
            self.symbol[ord(c)] = n + i
        for p, i in self.ids.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        number = self.ids | {c: n + i for i, c in enumerate(self.others)}
        pairs = sorted((number[p[:k]] * (1 << 32) + number[p[k:]], self.rank[p], i) for p, i in self.ids.items()
                       for k in range(1, len(p)) if p[:k] in number and p[k:] in number)
        keys, rank, piece = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        by_slot = np.argsort(_slot(keys), kind="stable")
        self.pairs, self.pair_rank = keys[by_slot], rank[by_slot].astype(np.int32)
        self.in_slot = np.bincount(_slot(keys), minlength=_SLOTS).astype(np.int8)
        self.slots = np.minimum(np.cumsum(self.in_slot, dtype=np.int64) - self.in_slot, len(keys) - 1).astype(np.int32)
        self.pair_piece = piece[by_slot].astype(np.int32)
        #: The piece of a rank, -1 where several share it.
        self.piece_of_rank = np.full(len(order), -1, np.int32)
        self.piece_of_rank[rank] = piece
        self.piece_of_rank[rank[self.piece_of_rank[rank] != piece]] = -1
        joined = {c for p in self.ids if len(p) > 1 for c in p}
        alone = "".join(c for c in "\n\t\r" if c not in joined) + _OWN_BLANK
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.ids):
            raise ValueError("a piece spans words")
        #: No piece spans two chunks, so chunks are encoded one by one: words with the blanks before them.
        self.chunks = re.compile(f"[{re.escape(alone)}]|{BLANK}*[^{BLANK}{re.escape(alone)}]+|{BLANK}+")

    def encode_chunks(self, chunks: list[str], keys: list[int], dropout: float) -> list[list[int]]:
        """The ids of each chunk. Candidates are pairs of neighbours that join to a piece; they are taken by score, then from
        the left. One that is taken is skipped for good if its keyed hash - of the chunk's key, its place and its piece -
        lies under the dropout; merges around it make new candidates. Short chunks go side by side, one step of each
        agenda at a time; long ones have an agenda on a heap each, to the same effect."""
        out: list[list[int]] = [[]] * len(chunks)
        short = [i for i, c in enumerate(chunks) if len(c) <= LONG]
        for i in sorted(set(range(len(chunks))) - set(short)):
            out[i] = self._by_heap(chunks[i], keys[i], dropout)
        runs = self.encode_short([chunks[i] for i in short], np.array([keys[i] for i in short], np.int64), dropout)
        for i, ids in zip(short, np.split(runs.ids, np.cumsum(runs.n_ids)[:-1]), strict=True) if short else ():
            out[i] = ids.tolist()
        return out

    def encode_short(self, chunks: list[str], keys: np.ndarray, dropout: float) -> Runs:
        """The runs of chunks of up to LONG characters, in order; chunks of like length go side by side."""
        if not chunks:
            return Runs.none()
        lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
        band = np.searchsorted(_BANDS if len(chunks) > 2000 else _BANDS[-2:], lengths)
        order, parts = np.argsort(band, kind="stable"), []
        edges = np.flatnonzero(np.diff(band[order], prepend=-1))
        for lo, hi in zip(edges, np.append(edges[1:], len(order)), strict=True):
            step = max(1, SIDE_BY_SIDE // int(lengths[order[lo:hi]].max()))
            for at in range(lo, hi, step):
                rows = order[at:min(hi, at + step)]
                parts.append(self._side_by_side([chunks[i] for i in rows.tolist()], lengths[rows], keys[rows], dropout))
        return Runs.joined(parts).taken(np.argsort(order, kind="stable"))

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the piece that each pair of symbols joins to (no candidate: _NONE)."""
        at, hit = self._find(left, right)
        return np.where(hit, self.pair_rank[at], _NONE)

    def _find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of pairs of symbols in the hash table of the pairs, and whether they are there."""
        key = left.astype(np.int64) * (1 << 32) + right
        slot = _slot(key)
        at = self.slots[slot]
        hit = self.pairs[at] == key
        more = np.flatnonzero(~hit.ravel() & (self.in_slot[slot].ravel() > 1))
        if len(more):
            at, hit = at.ravel(), hit.ravel()
            for k in range(1, int(self.in_slot.max())):
                own = key.ravel()[more]
                found = self.pairs[np.minimum(at[more] + k, len(self.pairs) - 1)] == own
                hit[more[found]] = True
                at[more[found]] += k
                more = more[~found]
            at, hit = at.reshape(key.shape), hit.reshape(key.shape)
        return at, hit

    def _joined(self, rank: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The pieces of candidates of these ranks; where several pieces share a rank, that of the pair."""
        piece = self.piece_of_rank[rank]
        shared = np.flatnonzero(piece < 0)
        if len(shared):
            piece[shared] = self.pair_piece[self._find(left[shared], right[shared])[0]]
        return piece

    def _side_by_side(self, chunks: list[str], lengths: np.ndarray, keys: np.ndarray, dropout: float) -> Runs:
        limit = int(dropout * _RANGE)
        code = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        width = int(lengths.max())
        columns = np.arange(width)
        symbols = np.full((len(chunks), width), -1, np.int32)
        known = self.symbol[code]
        symbols[columns < lengths[:, None]] = np.where(known >= 0, known, -2 - code)
        key, result, row = keys, symbols.copy(), np.arange(len(chunks))
        place = np.broadcast_to(columns.astype(np.int32), symbols.shape).copy()
        steps = []
        # a column more than there are pairs: no candidate ever stands in it
        rank = np.full(symbols.shape, _NONE, np.int32)
        if width > 1:
            rank[:, :-1] = self._look_up(symbols[:, :-1], symbols[:, 1:])
        while len(row):
            each = np.arange(len(row))
            i = rank.argmin(axis=1)
            least = rank[each, i]
            going = least != _NONE
            if not going.all():
                result[row[~going]] = symbols[~going]
                row, key, symbols, place, rank, i, least = (x[going] for x in (row, key, symbols, place, rank, i, least))
                each = np.arange(len(row))
                if not len(row):
                    break
            taken = self._joined(least, symbols[each, i], symbols[each, i + 1])
            tested = _candidate(place[each, i].astype(np.int64), taken.astype(np.int64)) & _MASK
            skipped = _mixed(key + tested) < limit
            steps.append((row, tested, skipped))
            rank[each[skipped], i[skipped]] = _NONE
            m = np.flatnonzero(~skipped)
            if not len(m):
                continue
            i, n, merged = i[m], np.arange(len(m)), taken[m]
            # the symbol right of the merged one leaves its row, and so does the candidate that began with it
            source = columns + (columns > i[:, None])
            flat = np.minimum(source, width - 1) + (m * width)[:, None]
            after = symbols.ravel()[flat]
            after[:, -1] = -1
            after[n, i] = merged
            symbols[m], place[m] = after, place.ravel()[flat]
            moved = rank.ravel()[flat]
            moved[:, -1] = _NONE
            for j in (i - 1, i):
                ok = np.flatnonzero((j >= 0) & (j < width - 1))
                moved[ok, j[ok]] = self._look_up(after[ok, j[ok]], after[ok, j[ok] + 1])
            rank[m] = moved
        there = result >= 0
        ids, n_ids = result[there], there.sum(axis=1)
        odd = np.flatnonzero(((result >= self.n_pieces) | (result < -1)).any(axis=1))
        if len(odd):
            lists = np.split(ids, np.cumsum(n_ids)[:-1])
            for r in odd.tolist():
                lists[r] = np.array(self._with_bytes(result[r].tolist()), np.int64)
            ids, n_ids = np.concatenate(lists), np.fromiter(map(len, lists), np.int64, len(lists))
        who, what, skipped = (np.concatenate(x) for x in zip(*steps, strict=True)) if steps else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))
        order = np.argsort(who, kind="stable")
        return Runs(ids.astype(np.int32), n_ids, what[order].astype(np.int32), skipped[order], np.bincount(who, minlength=len(chunks)))

    def _with_bytes(self, symbols: list[int]) -> list[int]:
        out = []
        for x in symbols:
            if 0 <= x < self.n_pieces:
                out.append(x)
            elif x != -1:
                out += self._bytes_of(self.others[x - self.n_pieces] if x >= 0 else chr(-2 - x))
        return out

    def _bytes_of(self, char: str) -> list[int]:
        return [self.byte[b] for b in (BLANK if char == _OWN_BLANK else char).encode()]

    def _by_heap(self, chunk: str, key: int, dropout: float) -> list[int]:
        ids, rank, limit = self.ids, self.rank, int(dropout * _RANGE)
        parts: list[str | None] = list(chunk)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(rank[a + b], i, i + 1, 2) for i, (a, b) in enumerate(pairwise(chunk)) if a + b in rank]
        heapify(agenda)
        while agenda:
            _, i, j, length = heappop(agenda)
            a, b = parts[i], parts[j]
            if a is None or b is None or after[i] != j or len(a) + len(b) != length:
                continue
            merged = a + b
            if limit and _hash(key, i, ids[merged]) < limit:
                continue
            parts[i], parts[j] = merged, None
            nxt = after[i] = after[j]
            if nxt < n:
                before[nxt] = i
                other = merged + parts[nxt]
                if other in rank:
                    heappush(agenda, (rank[other], i, nxt, len(other)))
            prev = before[i]
            if prev >= 0:
                other = parts[prev] + merged
                if other in rank:
                    heappush(agenda, (rank[other], prev, i, len(other)))
        return self._out([p for p in parts if p is not None])

    def _out(self, parts: list[str]) -> list[int]:
        out = []
        for p in parts:
            k = self.ids.get(p)
            if k is not None:
                out.append(k)
            else:
                out += self._bytes_of(p)
        return out

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        return self.chunks.findall(BLANK + text.replace(BLANK, _OWN_BLANK).replace(" ", BLANK))

    def decode(self, ids: list[int]) -> str:
        """The text that was encoded: pieces joined, without the blank that encoding puts first."""
        return b"".join(map(self.text.__getitem__, ids))[1:].decode()

    def decode_flat(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The UTF-8 texts of ids in a row, ``counts`` of them a text."""
        size = self.text_size[ids]
        steps = [slice(at, at + AT_ONCE) for at in range(0, len(ids), AT_ONCE)]
        raw = b"".join(self.text_bytes[_slices(self.text_start[ids[x]], size[x])].tobytes() for x in steps)
        ends = np.cumsum(np.append(0, size))[np.cumsum(np.append(0, counts))].tolist()
        return [raw[a + 1:b] for a, b in pairwise(ends)]


@lru_cache(maxsize=2)
def _encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def _keys(seed: int, name: bytes, n: int) -> np.ndarray:
    """Keys of the n chunks of a document: each occurrence has its own, of seed, document and place."""
    x = np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(xxhash.xxh64_intdigest(name, seed))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(34)).astype(np.int64)


class Segmenter:
    """Encodes texts, each occurrence of a chunk by its own draws.

    Of short chunks it keeps a decision tree: a node is a candidate that the chunk's agenda tests, its branches lead on from
    taking and from skipping it, a leaf holds the ids. An occurrence walks the tree with its own hashes; where a branch is missing
    its agenda is run and the rest of its way added, once for all later occurrences. What is kept changes no draw. Above KEPT
    chunks or NODES nodes it starts anew."""

    def __init__(self, encoder: PieceEncoder, dropout: float = DROPOUT, seed: int = SEED):
        self.encoder, self.dropout, self.seed = encoder, dropout, seed
        self._clear()

    def _clear(self) -> None:
        self.roots: dict[str, int] = {}
        # references: a node from 0 on, a leaf as -2 - leaf, or _MISSING
        self.tested, self.next = Grown(np.int32), Grown(np.int32, 2)
        self.starts, self.lengths, self.ids = Grown(np.int64), Grown(np.int32), Grown(np.int32)

    def encode(self, text: str, name: bytes) -> list[int]:
        return self.encode_many([text], [name])[0]

    def encode_many(self, texts: list[str], names: list[bytes]) -> list[list[int]]:
        """The ids of each text."""
        ids, n = self.encode_flat(texts, names)
        return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] if texts else []

    def encode_flat(self, texts: list[str], names: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the number of each text's. Chunks are encoded AT_ONCE at a time."""
        parts, n, chunks, keys, owner = [], np.zeros(len(texts), np.int64), [], [], []

        def flush() -> None:
            ids, sizes = self._encode(chunks, np.concatenate(keys))
            parts.append(ids)
            n[:] += np.bincount(np.repeat([k for k, _ in owner], [m for _, m in owner]), sizes, len(texts)).astype(np.int64)
            for held in (chunks, keys, owner):
                held.clear()

        for k, (text, name) in enumerate(zip(texts, names, strict=True)):
            split = self.encoder.split(text)
            own = _keys(self.seed, name, len(split))
            for at in range(0, len(split), AT_ONCE):
                chunks += split[at:at + AT_ONCE]
                keys.append(own[at:at + AT_ONCE])
                owner.append((k, len(keys[-1])))
                if len(chunks) >= AT_ONCE:
                    flush()
        if chunks:
            flush()
        return np.concatenate(parts) if parts else np.empty(0, np.int32), n

    def _encode(self, chunks: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks in a row, and the number of each chunk's."""
        leaf, own = np.full(len(chunks), -1, np.int64), {}
        at = np.fromiter(map(self.roots.get, chunks, repeat(_MISSING)), np.int64, len(chunks))
        new: dict[str, int] = {}
        first, again = [], []
        for i in np.flatnonzero(at == _MISSING).tolist():
            chunk = chunks[i]
            if len(chunk) > KEEP_LENGTH:
                own[i] = self.encoder._by_heap(chunk, int(keys[i]), self.dropout)
            elif new.setdefault(chunk, i) == i:
                first.append(i)
            else:
                again.append(i)
        leaf[first] = self._add([chunks[i] for i in first], keys[first], np.full(len(first), _MISSING), np.zeros(len(first), np.int64))
        at[again] = np.fromiter((self.roots[chunks[i]] for i in again), np.int64, len(again))
        which = np.flatnonzero((leaf == -1) & (at != _MISSING))
        self._walk(chunks, keys, which, at[which], leaf)
        n = np.zeros(len(chunks), np.int64)
        known = leaf >= 0
        n[known] = self.lengths.all[leaf[known]]
        for i, ids in own.items():
            n[i] = len(ids)
        places = np.cumsum(n) - n
        flat = np.empty(int(n.sum()), np.int32)
        if own:
            flat[_slices(places[known], n[known])] = self.ids.all[_slices(self.starts.all[leaf[known]], n[known])]
            for i, ids in own.items():
                flat[places[i]:places[i] + len(ids)] = ids
        else:
            flat[:] = self.ids.all[_slices(self.starts.all[leaf], n)]
        if len(self.roots) > KEPT or self.tested.n > NODES:
            self._clear()
        return flat, n

    def _walk(self, chunks: list[str], keys: np.ndarray, which: np.ndarray, at: np.ndarray, leaf: np.ndarray) -> None:
        """Sets the leaves of the occurrences ``which``, which stand at the references ``at``."""
        limit, depth = int(self.dropout * _RANGE), np.zeros(len(which), np.int64)
        while len(which):
            missing = []
            while len(which):
                done = at < 0
                if done.any():
                    leaf[which[done]] = -2 - at[done]
                    which, at, depth = which[~done], at[~done], depth[~done]
                branch = at * 2 + (_mixed(keys[which] + self.tested.all[at]) < limit)
                at, depth = self.next.all.ravel()[branch].astype(np.int64), depth + 1
                gone = at == _MISSING
                if gone.any():
                    missing.append((which[gone], branch[gone], depth[gone]))
                    which, at, depth = which[~gone], at[~gone], depth[~gone]
            if not missing:
                return
            which, branch, depth = (np.concatenate(x) for x in zip(*missing, strict=True))
            _, first = np.unique(branch, return_index=True)
            leaf[which[first]] = self._add([chunks[i] for i in which[first].tolist()], keys[which[first]], branch[first], depth[first])
            rest = np.ones(len(which), bool)
            rest[first] = False
            which, depth = which[rest], depth[rest]
            at = self.next.all.ravel()[branch[rest]].astype(np.int64)

    def _add(self, chunks: list[str], keys: np.ndarray, branch: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Runs chunks and adds their ways to the tree, behind ``branch`` (_MISSING: as a new root), from their test ``depth`` on."""
        runs = self.encoder.encode_short(chunks, keys, self.dropout)
        leaves = self.lengths.n + np.arange(len(chunks))
        self.starts.add(self.ids.n + np.cumsum(runs.n_ids) - runs.n_ids)
        self.lengths.add(runs.n_ids)
        self.ids.add(runs.ids)
        n = runs.n_tested - depth
        tests = _slices(np.cumsum(runs.n_tested) - runs.n_tested + depth, n)
        nodes = self.tested.n + np.arange(len(tests))
        ends = np.cumsum(n)
        onward = nodes + 1
        onward[ends[n > 0] - 1] = -2 - leaves[n > 0]
        after = np.full((len(tests), 2), _MISSING, np.int32)
        after[np.arange(len(tests)), runs.skipped[tests].astype(np.int8)] = onward
        entry = np.where(n > 0, self.tested.n + ends - n, -2 - leaves)
        self.tested.add(runs.tested[tests])
        self.next.add(after)
        inner = branch != _MISSING
        self.next.all.reshape(-1)[branch[inner]] = entry[inner]
        for k in np.flatnonzero(~inner).tolist():
            self.roots[chunks[k]] = int(entry[k])
        return leaves


class Grown:
    """An array that rows are added to; ``all`` is a view of them."""

    def __init__(self, dtype, columns: int | None = None):
        self.n, self.held = 0, np.zeros((1 << 12,) if columns is None else (1 << 12, columns), dtype)

    @property
    def all(self) -> np.ndarray:
        return self.held[:self.n]

    def add(self, rows: np.ndarray) -> None:
        end = self.n + len(rows)
        if end > len(self.held):
            held = np.zeros((max(end, 2 * len(self.held)), *self.held.shape[1:]), self.held.dtype)
            held[:self.n] = self.all
            self.held = held
        self.held[self.n:end] = rows
        self.n = end


def encode_documents(docs: DataFrame, path: str, text: str = "text", name: str = "doc_id", keep: tuple[str, ...] = ("doc_id",),
                     dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """``keep`` columns of every row with ``ids`` (array of int), ``n_pieces`` and ``lossless`` (the ids decode to the text).

    Every occurrence of a chunk draws by itself, by seed, ``name`` (null: empty) and the place in the text, so reruns agree and
    another seed segments anew; equal rows are segmented alike. A null text has null ids, 0 pieces and null ``lossless``; an empty text has no
    ids and is lossless. Any text decodes to itself: characters without a piece, and blank marks of the text's own, are
    encoded as bytes. Texts are encoded whole; a long run without blanks is one chunk. An empty table gives an empty result."""
    kept = docs.select(F.col(text).alias("__text"), F.coalesce(F.col(name).cast("string"), F.lit("")).alias("__name"), *[F.col(c) for c in keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        segmenter = Segmenter(encoder, dropout, seed)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                raws, names = as_bytes(part.column(0)), as_bytes(part.column(1))
                there = [i for i, raw in enumerate(raws) if raw is not None]
                values, counts = segmenter.encode_flat([raws[i].decode() for i in there], [names[i] for i in there])
                n, same = [0] * len(raws), [None] * len(raws)
                for i, k, back in zip(there, counts.tolist(), encoder.decode_flat(values, counts), strict=True):
                    n[i], same[i] = k, back == raws[i]
                offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets, mask=np.array([*[s is None for s in same], False])), pa.array(values))
                yield pa.record_batch([*[part.column(i + 2) for i in range(len(keep))], lists, pa.array(n, pa.int64()), pa.array(same, pa.bool_())],
                                      names=[*keep, "ids", "n_pieces", "lossless"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[2:])
    return kept.mapInArrow(run, f"{fields}, ids array<int>, n_pieces bigint, lossless boolean")


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``encoded`` with the text that its ids stand for in ``text``, in place of the ids. Null ids give a null text."""
    kept = [c for c in encoded.columns if c not in (ids, text)]
    rows = encoded.select(F.col(ids).alias("__ids"), *[F.col(f"`{c}`") for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            texts = [None if x is None else encoder.decode(x) for x in batch.column(0).to_pylist()]
            yield pa.record_batch([*[batch.column(i + 1) for i in range(len(kept))], pa.array(texts, pa.string())], names=[*kept, text])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[1:])
    return rows.mapInArrow(run, f"{fields}`{text}` string")
