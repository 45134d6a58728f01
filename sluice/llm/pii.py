"""Personal data in texts, plain and disguised, with the places where it stands in the source."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_bytes

KINDS = ("email", "ip", "card", "phone")

# Patterns. Written so that no text costs more than a few steps a character: matches are the leftmost ones of the plain
# patterns in `find`'s docstring, but are only tried where one can begin.
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_ISLAND = re.compile(r"[0-9][0-9.\x20-]*+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Top-level labels of disguised addresses are words; a plain address may end in any label.
_TOP = re.compile(r"\.[A-Za-z]{2,24}\Z")

# Characters that look like an ASCII one and aren't its compatibility form, each pair as (look-alikes, ASCII).
_CYRILLIC = ("аеорсухіјѕԁһӏԛԝкАВЕКМНОРСТУХІЈЅ", "aeopcyxijsdhlqwkABEKMHOPCTYXIJS")
_GREEK = ("αορνικυχϲϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aopvikuxcjABEZHIKMNOPTYX")
_OTHERS = ("օոսհցıɑɡ。｡‧‐‑‒–—―−", "onuhgiag...-------")
#: Characters without a width, which normalising removes.
_UNSEEN = "­͏᠎​‌‍⁠﻿"

# Digits as words (English, German, French, Spanish).
_DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "fuenf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9"}
_TIMES = {"double": 2, "triple": 3}
#: Words for @ and the words for a dot that go with them when neither stands in brackets.
_AT_DOT = {"at": ("dot", "punkt"), "ät": ("punkt",), "arroba": ("punto",), "arobase": ("point",)}
_DOTS = ("dot", "punkt", "punto", "point")
#: "at the dot ..." is prose.
_ARTICLES = "the|a|an|this|that|my|your|our|his|her|its|their|each|every|one"
#: Blanks that a disguise may put on one side of a sign.
_GAP = 3

_word = "|".join(sorted(_DIGIT_WORDS, key=len, reverse=True))
_dot = "|".join(_DOTS)
_number = rf"(?:(?:{'|'.join(_TIMES)})[ -])?(?:{_word})(?!\w)"
_SEPARATOR = rf"[ \t]{{0,{_GAP}}}(?:\.|(?<=[ \t])(?:{_dot})(?=[ \t]))[ \t]{{0,{_GAP}}}|[ \t]?[,/-][ \t]?|[ \t]{{1,{_GAP}}}"
_SPELLED = re.compile(rf"(?<![^\W_])(?:(?P<plus>plus)[ \t]{{1,{_GAP}}})?(?:{_number}|(?<![0-9])[0-9]{{1,19}}(?![\w]))(?:(?:{_SEPARATOR})(?:{_number}|[0-9]{{1,19}}(?!\w)))++")
_TOKEN = re.compile(rf"(?P<times>{'|'.join(_TIMES)})?[ -]?(?P<word>{_word})(?!\w)|(?P<digits>[0-9]+)")
_HAS_WORD = re.compile(rf"(?<![^\W_])(?:{_word})(?![^\W_])")
_DOT_SIGN = re.compile(rf"\.|(?<=[ \t])(?:{_dot})(?=[ \t])")
_BRACKETED = re.compile(rf"[\[({{<][ \t]{{0,{_GAP}}}(?:(?P<at>at|@|ät|arroba|arobase)|(?P<dot>{_dot}|\.))[ \t]{{0,{_GAP}}}[\])}}>]"
                        r"|&(?:(?P<at2>#0{0,5}64|#x0{0,5}40|commat)|(?P<dot2>#0{0,5}46|#x0{0,5}2e|period)|#0{0,5}43|#x0{0,5}2b|plus);", re.I)
_BARE_AT = re.compile("|".join(
    rf"(?<=[a-z0-9])[ _]{{1,2}}{at}[ _]{{1,2}}(?=(?!(?:{_ARTICLES})[ _])[a-z0-9-]{{1,63}}[ _]{{1,2}}(?:{'|'.join(dots)})[ _]{{1,2}}[a-z0-9])"
    for at, dots in _AT_DOT.items()))
_SPACED_AT = re.compile(r"(?<=[a-z0-9]) @ (?=[a-z0-9-]{1,63}(?: ?\. ?[a-z0-9-]{1,63}){0,8} ?\. ?[a-z]{2,24}(?![a-z0-9-]))")
_BARE_DOTS = re.compile(rf"@[a-z0-9-]{{1,63}}((?:[ _]{{1,2}}(?:{_dot})[ _]{{1,2}}[a-z0-9-]{{1,63}}){{1,8}}|(?: ?\. ?[a-z0-9-]{{1,63}}){{0,8}} ?\. ?[a-z]{{2,24}}(?![a-z0-9-]))")
_DOT_WORD = re.compile(rf"[ _]{{1,2}}(?:{_dot})[ _]{{1,2}}| \. ?|\. ")
_NAME_DOTS = re.compile(rf"(?:[a-z0-9%+-]{{1,64}}[ _]{{1,2}}(?:{_dot})[ _]{{1,2}}){{1,4}}[a-z0-9%+-]{{1,64}}\Z")


def _emails(t: str) -> Iterator[tuple[int, int]]:
    free, at = 0, t.find("@")
    while at >= 0:
        start = at
        while start > free and t[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(t, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        at = t.find("@", at + 1)


def _luhn(digits: str) -> bool:
    """The check sum of card numbers: every second digit from the right counts double, with its own digits added up."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _numeric(t: str) -> Iterator[tuple[int, int, int]]:
    """(start, kind, end) of addresses and cards: both lie inside runs of digits, dots, blanks and hyphens."""
    for island in _ISLAND.finditer(t):
        a, b = island.span()
        if b - a < 7:
            continue
        if t.find(".", a, b) >= 0:
            for m in _IP.finditer(t, a, b):
                if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m.group().split(".")):
                    yield m.start(), 1, m.end()
        if b - a >= 12:
            for m in _CARD.finditer(t, a, b):
                if m.end() - m.start() >= 12 and 12 <= len(d := m.group().replace(" ", "").replace("-", "")) <= 19 and _luhn(d):
                    yield m.start(), 2, m.end()


def _phones(t: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(t):
        if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            yield m.span()


def find(t: str) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end) of what stands plainly in a text, leftmost and without overlaps per kind:
    email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``; ip ``[0-9]+(\\.[0-9]+){3}`` with parts up to 255; card
    ``[0-9]([ -]?[0-9])+`` with 12 to 19 digits and a right check sum; phone ``\\+[0-9][ ().0-9-]+[0-9]`` with 9 to 15 digits.
    A match that fails its test is dropped, and the search goes on behind it."""
    found = list(_numeric(t))
    if "@" in t:
        found += [(a, 0, b) for a, b in _emails(t)]
    if "+" in t:
        found += [(a, 3, b) for a, b in _phones(t)]
    return sorted(found)


class View:
    """A text in which every character knows the range of source characters that it stands for."""

    def __init__(self, text: str, starts: np.ndarray | None = None, ends: np.ndarray | None = None):
        self.text, self.starts, self.ends = text, starts, ends

    def edited(self, edits: list[tuple[int, int, str]]) -> View:
        """The view with each (start, end, new text) put in place; edits are in order, not empty, and don't overlap."""
        if not edits:
            return self
        n = len(self.text)
        starts = np.arange(n) if self.starts is None else self.starts
        ends = np.arange(1, n + 1) if self.ends is None else self.ends
        text, s, e, at = [], [], [], 0
        for a, b, new in edits:
            text += [self.text[at:a], new]
            s += [starts[at:a], np.full(len(new), starts[a])]
            e += [ends[at:a], np.full(len(new), ends[b - 1])]
            at = b
        return View("".join([*text, self.text[at:]]), np.concatenate([*s, starts[at:]]), np.concatenate([*e, ends[at:]]))

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source range of a range of this text."""
        return (start, end) if self.starts is None else (int(self.starts[start]), int(self.ends[end - 1]))


@lru_cache(maxsize=1)
def _look_alikes() -> tuple[dict[int, str], frozenset[str]]:
    """One ASCII character for every other one that looks like it; all of these, with the unseen ones."""
    table: dict[int, str] = {}
    for code in range(0x100, 0x20000):
        c = chr(code)
        kind = unicodedata.category(c)
        if kind == "Nd":
            table[code] = str(unicodedata.decimal(c))
        elif kind == "Zs":
            table[code] = " "
        elif kind not in ("Cn", "Co", "Cs") and len(same := unicodedata.normalize("NFKC", c)) == 1 and same.isascii():
            table[code] = same
    table[0xA0] = " "
    for odd, plain in (_CYRILLIC, _GREEK, _OTHERS):
        table |= {ord(a): b for a, b in zip(odd, plain, strict=True)}
    return table, frozenset([*map(chr, table), *_UNSEEN])


_IS_UNSEEN = re.compile(f"[{_UNSEEN}]")
_BEYOND_LATIN = re.compile("[^\x00-\x9f\xa1-\xac\xae-\xff]")


def _homoglyphs(view: View) -> View:
    if not _BEYOND_LATIN.search(view.text):
        return view
    table, odd = _look_alikes()
    if odd.isdisjoint(view.text):
        return view
    view = View(view.text.translate(table), view.starts, view.ends)
    return view.edited([(*m.span(), "") for m in _IS_UNSEEN.finditer(view.text)])


def _bracketed(view: View) -> View:
    """Signs in brackets or as character references, with the blanks around them."""
    t, edits, free = view.text, [], 0
    if not any(c in t for c in "[({<&"):
        return view
    for m in _BRACKETED.finditer(t):
        a, b = m.span()
        if t[a] != "&":
            while a > max(free, m.start() - _GAP) and t[a - 1] in " \t":
                a -= 1
            while b < min(len(t), m.end() + _GAP) and t[b] in " \t":
                b += 1
            if not (a > free and b < len(t) and t[a - 1].isalnum() and t[b].isalnum()):
                continue
        edits.append((a, b, "@" if m["at"] or m["at2"] else "." if m["dot"] or m["dot2"] else "+"))
        free = b
    return view.edited(edits)


def _lower(t: str) -> str:
    """Lower case of the same length."""
    low = t.lower()
    return low if len(low) == len(t) else "".join(x if len(x := c.lower()) == 1 else c for c in t)


def _spelled(view: View) -> View:
    """Runs of digits with words among them, as digits side by side; dots between them stay. A single word beside digits
    that are written as such counts only behind or before a dot: "room 12 one floor up"."""
    low = _lower(view.text)
    if not _HAS_WORD.search(low):
        return view
    edits = []
    for run in _SPELLED.finditer(low):
        words = sum(1 for _ in _HAS_WORD.finditer(run.group()))
        if not words or words == 1 and not _DOT_SIGN.search(run.group()):
            continue
        at, before = run.start(), None
        if run["plus"]:
            edits.append((*run.span("plus"), "+"))
            at = run.end("plus")
        for m in _TOKEN.finditer(low, at, run.end()):
            gap, spelled = low[at:m.start()], m["word"] is not None
            if before is not None and ("." in gap or gap.strip() in _DOTS):
                edits.append((at, m.start(), "."))
            elif gap and (spelled or before or before is None):
                edits.append((at, m.start(), ""))
            if spelled:
                edits.append((*m.span(), _DIGIT_WORDS[m["word"]] * _TIMES.get(m["times"], 1)))
            at, before = m.end(), spelled
    return view.edited(edits)


def _bare_signs(view: View) -> View:
    """``name at host dot com`` and ``name @ host . com``: the word for @ counts if a word for a dot follows its host."""
    low, edits = _lower(view.text), []
    worded = any(f"{c}{d}{c}" in low for d in _DOTS for c in " _")
    if worded:
        edits = [(*m.span(), "@") for m in _BARE_AT.finditer(low)]
    if " @ " in low:
        edits = sorted([*edits, *((*m.span(), "@") for m in _SPACED_AT.finditer(low))])
    if not edits and not (worded and "@" in low):
        return view
    names = []
    for a, _, _ in edits:  # name dot name at ...
        left = low[max(0, a - 200):a]
        if m := _NAME_DOTS.search(left):
            names += [(a - len(left) + d.start(), a - len(left) + d.end(), ".") for d in _DOT_WORD.finditer(left, m.start())]
    view = view.edited(sorted({*edits, *names}))
    low, edits = _lower(view.text), []
    for m in _BARE_DOTS.finditer(low):
        edits += [(*d.span(), ".") for d in _DOT_WORD.finditer(low, *m.span(1))]
    return view.edited(edits)


def normalised(t: str) -> View:
    """A text with look-alikes as ASCII, signs in brackets or words as signs, and spelled digits as digits."""
    return _bare_signs(_spelled(_bracketed(_homoglyphs(View(t)))))


def spans(t: str) -> list[tuple[int, int, int, bool]]:
    """(start, kind, end, plain) of all personal data of a text, plain and disguised, in code points. Disguised is what
    `find` sees in the normalised text beside the plain spans of its kind. An e-mail address in disguise ends in a word; it
    may hold a plain one, whose name goes on to the left in look-alikes."""
    plain = find(t)
    out = [(a, k, b, True) for a, k, b in plain]
    view = normalised(t)
    if view.text != t:
        by_kind = [[(a, b) for a, q, b in plain if q == k] for k in range(len(KINDS))]
        for a, k, b in find(view.text):
            if k == 0 and not _TOP.search(view.text[a:b]):
                continue
            a, b = view.source(a, b)
            own = by_kind[k]
            i = bisect_left(own, (b, 0)) - 1  # the last plain one that begins before b; plain ones don't overlap
            inside = i >= 0 and own[i][0] <= a and b <= own[i][1]
            if not (inside if k == 0 else i >= 0 and own[i][1] > a):
                out.append((a, k, b, False))
    return sorted(out)


def detect(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with ``spans``: array of (kind, start, end, plain) by start, then kind as in KINDS.

    Places are code points of the whole source text, the end exclusive. Null and empty texts have an empty array, equal rows equal
    ones; further columns are ignored. An empty table gives an empty result."""
    rows = docs.select(F.col(text).alias("__text"), *[F.col(c) for c in keep])
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("plain", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = [[{"kind": KINDS[k], "start": a, "end": b, "plain": p} for a, k, b, p in spans(raw.decode())] if raw else []
                         for raw in as_bytes(part.column(0))]
                yield pa.record_batch([*part.columns[1:], pa.array(found, pa.list_(span))], names=[*keep, "spans"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[1:])
    return rows.mapInArrow(run, f"{fields}spans array<struct<kind: string, start: int, end: int, plain: boolean>>")


def said(found: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
