"""Lines of delimited text as records: where a quoted or escaped line break joins lines.

What a line does depends on where it begins: at the start of a record, inside a quoted field, or inside a plain field
whose line break was escaped. So each line gets a transition, the state behind it for each of the three states before it
(an expression, no look at other lines). Transitions compose, so a chunk of lines has one too, and a scan over the chunks of a
file gives every chunk the state it begins in. No task sees more than one chunk's transitions, or one file's chunks.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import counted, materialised, observed

#: States at the start of a line.
START, QUOTED, PLAIN = 0, 1, 2
#: Lines of a chunk; the bytes that a record of several lines may have (beyond, each of its lines is a malformed record).
CHUNK, RECORD_BYTES = 65_536, 8 << 20
#: Chunks whose lines meet their records in one task.
TASK_CHUNKS = 8
_THREE = (START, QUOTED, PLAIN)


@dataclass(frozen=True)
class Dialect:
    """How fields are written. A quote counts where a field begins. ``lenient_end``: any quote but a doubled one ends the
    quoted part, and what stands behind it up to the separator belongs to the field (as Python's csv reader has it);
    otherwise only a quote before a separator or the end does (as MySQL's loader has it)."""

    sep: str = ","
    quote: str | None = '"'
    escape: str | None = None
    lenient_end: bool = True

    def __post_init__(self):
        for sign in (self.sep, self.quote, self.escape):
            if sign is not None and len(sign) != 1:
                raise ValueError("separator, quote and escape are single characters")

    @property
    def _signs(self) -> tuple[str, str, str]:
        return re.escape(self.sep), re.escape(self.quote or ""), re.escape(self.escape or "")

    @property
    def plain(self) -> str:
        """Pattern of a field without quotes, up to a separator."""
        s, q, e = self._signs
        start = f"(?!{q})" if q else ""
        return f"{start}(?:[^{s}{e}]++|{e}.)*+" if e else f"{start}[^{s}]*+"

    @property
    def inside(self) -> str:
        """Pattern of what stands between the quotes."""
        s, q, e = self._signs
        parts = [f"[^{q}{e}]++", f"{q}{q}"]
        if e:
            parts.append(f"{e}.")
        if not self.lenient_end:
            parts.append(f"{q}(?!{s}|\\z)")
        return f"(?:{'|'.join(parts)})*+"

    @property
    def quoted(self) -> str:
        s, q, _ = self._signs
        return f"{q}{self.inside}{q}" + (f"[^{s}]*+" if self.lenient_end else f"(?={s}|\\z)")

    @property
    def field(self) -> str:
        return f"(?:{self.quoted}|{self.plain})" if self.quote else f"(?:{self.plain})"

    def _behind(self, line: Column) -> Column:
        """The state behind a line that begins a record."""
        s, q, e = self._signs
        whole = f"(?s)^(?:{self.field}{s})*+"
        state = F.lit(START)
        if self.escape:
            state = F.when(line.rlike(f"{whole}{self.plain}{e}\\z"), F.lit(PLAIN)).otherwise(state)
        if self.quote:
            state = F.when(line.rlike(f"{whole}{q}{self.inside}{e + '?' if e else ''}\\z"), F.lit(QUOTED)).otherwise(state)
        return state

    def transition(self, line: Column) -> Column:
        """The states behind a line for each state before it, as one number in base 3. A line that begins inside a field acts
        like one with that field's first character in front."""
        signs = [F.contains(line, F.lit(x)) for x in (self.quote, self.escape) if x]
        if not signs:
            return F.lit(_code((START, QUOTED, START))).cast("int")
        special = signs[0] | signs[1] if len(signs) > 1 else signs[0]
        states = [self._behind(line), self._behind(F.concat(F.lit(self.quote), line)) if self.quote else F.lit(QUOTED),
                  self._behind(F.concat(F.lit("x"), line)) if self.escape else F.lit(START)]
        return F.when(special, states[0] * 9 + states[1] * 3 + states[2]).otherwise(F.lit(_code((START, QUOTED, START)))).cast("int")

    def raw_fields(self, record: Column) -> Column:
        """The fields of a whole record, with their quotes and escapes."""
        s = self._signs[0]
        return F.regexp_extract_all(F.concat(record, F.lit(self.sep)), F.lit(f"(?s)({self._field_before_separator}){s}"), F.lit(1))

    @property
    def _field_before_separator(self) -> str:
        s, q, e = self._signs
        bare = f"(?:[^{s}{e}]++|{e}.)*+" if e else f"[^{s}]*+"
        if not self.quote:
            return bare
        inside = self.inside.replace("|\\z)", ")")  # the separator that was put behind the record stands for its end
        return f"{q}{inside}{q}" + (f"[^{s}]*+" if self.lenient_end else f"(?={s})") + f"|{bare}"


#: How Python's csv module reads.
CSV = Dialect()


def _code(states: tuple[int, int, int]) -> int:
    return states[0] * 9 + states[1] * 3 + states[2]


def _states(code: int) -> tuple[int, int, int]:
    return code // 9, code // 3 % 3, code % 3


def csv_fields(record: Column, malformed: Column | None = None) -> Column:
    """The values of a record's fields as Python's csv reader has them: quotes count where a field begins, doubled ones inside
    stand for one, and text behind the closing quote is part of the field. A malformed record (a quote never closes) ends
    with its last line. An empty record has no fields."""
    closed = record if malformed is None else F.when(malformed, F.concat(record, F.lit('"'))).otherwise(record)
    raw = CSV.raw_fields(closed)
    value = lambda x: F.when(x.startswith('"'), F.concat(
        F.replace(F.regexp_extract(x, f"(?s)^\"({CSV.inside})\"", 1), F.lit('""'), F.lit('"')),
        F.regexp_extract(x, f"(?s)^\"{CSV.inside}\"(.*)\\z", 1))).otherwise(x)
    fields = F.when(F.contains(record, F.lit('"')), F.transform(raw, value)).otherwise(F.split(record, ","))
    return F.when(record == "", F.array().cast("array<string>")).otherwise(fields)


def classified(lines: DataFrame, dialect: Dialect = CSV) -> DataFrame:
    """``lines(file_path, line, value, ..)`` with ``_chunk`` and ``_does`` (the line's transition), written once: what follows reads
    few columns of it, several times."""
    return materialised(lines.withColumn("_chunk", F.floor((F.col("line") - 1) / CHUNK).cast("long"))
                        .withColumn("_does", dialect.transition(F.col("value"))), "lines")


def _chunks(lines: DataFrame) -> DataFrame:
    """One row per chunk: ``eventful`` if a line of it can leave a field open, ``closes`` if a line ends a quoted field that was
    open before it."""
    start, quoted, plain = (F.floor(F.col("_does") / 9), F.floor(F.col("_does") / 3) % 3, F.col("_does") % 3)
    return lines.groupBy("file_path", "_chunk").agg(
        F.max((start != START) | (quoted == PLAIN) | (plain != START)).alias("eventful"), F.max(quoted == START).alias("closes"))


def _walk(codes: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """The state before each line, and the one behind the last."""
    before, table = np.empty(len(codes), np.int8), [_states(c) for c in range(27)]
    for i, c in enumerate(codes.tolist()):
        before[i] = state
        state = table[c][state]
    return before, state


def _summary(rows: pd.DataFrame) -> pd.DataFrame:
    """A chunk's transition, and the last line that begins a record for each state before the chunk (0: none)."""
    rows = rows.sort_values("line")
    lines, codes = rows["line"].to_numpy(), rows["_does"].to_numpy()
    out = {"file_path": [rows["file_path"].iloc[0]], "_chunk": [rows["_chunk"].iloc[0]]}
    behind = []
    for state in _THREE:
        before, end = _walk(codes, state)
        begins = lines[before == START]
        out[f"first_{state}"] = [int(begins[-1]) if len(begins) else 0]
        behind.append(end)
    out["does"] = [_code(tuple(behind))]
    return pd.DataFrame(out)


def _scan(rows: pd.DataFrame) -> pd.DataFrame:
    """The chunks of a file with the state each begins in and the line on which the open record began; last, as chunk -1, the
    state behind the file."""
    rows = rows.sort_values("_chunk")
    state, owner, states, owners = START, 0, [], []
    for does, *first in rows[["does", "first_0", "first_1", "first_2"]].itertuples(index=False):
        states.append(state)
        owners.append(owner)
        owner, state = first[state] or owner, _states(does)[state]
    name = rows["file_path"].iloc[0]
    return pd.DataFrame({"file_path": [name] * (len(rows) + 1), "_chunk": [*rows["_chunk"], -1], "state": [*states, state], "owner": [*owners, owner]})


def _assigned(rows: pd.DataFrame) -> pd.DataFrame:
    """The lines of a chunk that share a record with others (or whose record never ends), with its first line; ``open`` if the record
    is inside quotes at the chunk's end."""
    rows = rows.sort_values("line")
    lines, codes = rows["line"].to_numpy(), rows["_does"].to_numpy()
    before, end = _walk(codes, int(rows["state"].iloc[0]))
    begins = before == START
    first = np.maximum.accumulate(np.where(begins, lines, 0))
    first = np.where(first == 0, rows["owner"].to_numpy(), first)
    joined = ~begins | np.append(before[1:] != START, end != START)
    return pd.DataFrame({"file_path": rows["file_path"].to_numpy()[joined], "line": lines[joined], "first": first[joined], "bytes": rows["bytes"].to_numpy()[joined],
                         "open": (first == first[-1])[joined] & (end == QUOTED)})


def _at_end() -> Column:
    return (F.col("_chunk") == -1) & (F.col("state") == QUOTED)


def _scanned(narrow: DataFrame, chunks: DataFrame) -> tuple[DataFrame, dict]:
    """:func:`_scan` of the files of ``chunks``, and whether one of them ends inside quotes."""
    eventful = narrow.drop("bytes").join(chunks.where("eventful").select("file_path", "_chunk"), ["file_path", "_chunk"], "left_semi")
    walked = eventful.groupBy("file_path", "_chunk").applyInPandas(
        _summary, "file_path string, _chunk long, first_0 long, first_1 long, first_2 long, does int")
    quiet = chunks.where("not eventful").select(  # its records begin and end inside it, unless it stands inside a quoted field
        "file_path", "_chunk", *[F.lit(0).cast("long").alias(f"first_{s}") for s in _THREE],
        F.when(F.col("closes"), F.lit(_code((START, START, START)))).otherwise(F.lit(_code((START, QUOTED, START)))).alias("does"))
    return observed(walked.unionByName(quiet).groupBy("file_path").applyInPandas(
        _scan, "file_path string, _chunk long, state int, owner long"), "scanned", open=F.max(_at_end()))


def shared_lines(lines: DataFrame) -> DataFrame | None:
    """``(_file, _line, _first, _bad)``: the lines of :func:`classified` that don't make a record by themselves, with their record's
    first line; ``_bad`` if its quote never closes, or if it has more than RECORD_BYTES (then each line is its own first). None
    if there are no such lines, as in most inputs: one pass over the transitions tells."""
    chunks, seen = observed(_chunks(lines), "chunks", eventful=F.max("eventful"), last=F.max("_chunk"))
    if not seen.get("eventful"):
        return None
    files = chunks.where("eventful").select("file_path").distinct()
    chunks = chunks.join(files, "file_path", "left_semi")  # one row a chunk
    narrow = lines.select("file_path", "_chunk", "line", "_does", F.octet_length("value").cast("long").alias("bytes"))
    one_each = seen.get("last") == 0  # no file has more than one chunk: each begins with a record
    if one_each:
        needed = chunks.where("eventful").select("file_path", "_chunk", F.lit(START).alias("state"), F.lit(0).cast("long").alias("owner"))
    else:
        scanned, ends = _scanned(narrow, chunks)
        needed = scanned.join(chunks.select("file_path", "_chunk", "eventful"), ["file_path", "_chunk"]).where(F.col("eventful") | (F.col("state") != START)).drop("eventful")
    shared = narrow.join(needed, ["file_path", "_chunk"]).groupBy("file_path", "_chunk").applyInPandas(
        _assigned, "file_path string, line long, first long, bytes long, open boolean")
    shared, size = observed(shared, "shared", bytes=F.sum("bytes"), open=F.max("open"))
    named = (F.col("file_path").alias("_file"), F.col("line").alias("_line"))
    if not (size if one_each else ends).get("open") and (size.get("bytes") or 0) <= RECORD_BYTES:  # no record is bad or too long
        return shared.select(*named, F.col("first").alias("_first"), F.lit(False).alias("_bad"))
    open_at_end = (shared.where("open").select("file_path", "first").distinct() if one_each else scanned.where(_at_end()).select(
        "file_path", F.col("owner").alias("first"))).withColumn("_open", F.lit(True))
    sizes = shared.groupBy("file_path", "first").agg((F.sum("bytes") > RECORD_BYTES).alias("_long"))
    marked = shared.join(materialised(sizes.join(open_at_end, ["file_path", "first"], "left"), "record-sizes"), ["file_path", "first"])
    return materialised(marked.select(
        *named, F.when(F.col("_long"), F.col("line")).otherwise(F.col("first")).alias("_first"),
        (F.col("_long") | F.coalesce("_open", F.lit(False))).alias("_bad")), "record-lines")


def records(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(file_path, line, value, malformed)`` and ``keep`` columns (equal on all lines of a file) of every record of :func:`classified`
    lines: ``line`` is its first line, ``value`` its text with the line breaks inside. Chunks of lines that are records by
    themselves, most in most files, are not shuffled; what is gathered for a record is bounded by RECORD_BYTES."""
    shared, cols = shared_lines(lines), ["file_path", "line", "value", *keep]
    if shared is None:
        return lines.select(*cols, F.lit(False).alias("malformed"))
    touched, n = counted(shared.select("_file", F.floor((F.col("_line") - 1) / CHUNK).cast("long").alias("_in")).distinct(), "record-chunks")
    within = (F.col("file_path") == F.col("_file")) & (F.col("_chunk") == F.col("_in"))
    quiet = lines.join(touched, within, "left_anti").select(*cols, F.lit(False).alias("malformed"))
    on = (F.col("file_path") == F.col("_file")) & (F.col("line") == F.col("_line"))
    # written once: what follows reads records several times
    busy = lines.join(touched, within, "left_semi").select(*cols)
    if n // TASK_CHUNKS > int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")):  # a task's share doesn't grow with the input
        busy = busy.repartition(n // TASK_CHUNKS, "file_path", "line")
    marked = materialised(busy.join(shared, on, "left").drop("_file", "_line"), "record-marked")
    alone = marked.where("_first is null").select(*cols, F.lit(False).alias("malformed"))
    joined = marked.where("_first is not null").groupBy("file_path", "_first", *keep).agg(
        F.sort_array(F.collect_list(F.struct("line", "value"))).alias("_lines"), F.max("_bad").alias("malformed"))
    joined = materialised(joined.select("file_path", F.col("_first").alias("line"), F.array_join(
        F.transform("_lines", lambda x: x["value"]), "\n").alias("value"), *keep, "malformed"), "records-joined")
    return quiet.unionByName(alone).unionByName(joined)
