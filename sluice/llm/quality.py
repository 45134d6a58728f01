"""Quality rules: a table of thresholds compiled into one projection of built-in expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD

#: Frequent function words of seven languages, lower-case.
STOP_WORDS = (
    # English
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "on", "was", "with", "be", "as", "by", "are", "this",
    # French
    "le", "la", "les", "de", "des", "et", "un", "une", "en", "est", "que", "qui", "pour", "dans", "sur", "du", "par",
    # German
    "der", "die", "das", "und", "zu", "den", "von", "mit", "ist", "ein", "eine", "nicht", "auf", "im", "dem", "sich",
    # Spanish
    "el", "los", "las", "y", "del", "se", "no", "con", "una", "su", "al", "lo", "como", "o", "es", "por", "para",
    # Italian, Portuguese, Dutch
    "il", "di", "che", "per", "non", "sono", "e", "os", "um", "uma", "do", "da", "het", "een", "van", "dat", "niet",
)


@dataclass(frozen=True)
class Rule:
    """A ratio of two counts and the range in which a document is kept; ``None`` leaves a side open."""

    name: str
    part: str
    whole: str
    least: float | None = None
    most: float | None = None


#: The production table. Counts are the columns of :func:`counts`.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2.0, 12.0),
    Rule("symbol_ratio", "n_symbols", "n_words", None, 0.10),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 0.06, None),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", None, 0.50),
)
LEAST_WORDS = 50
#: Percent of words that may lie in repeated three-word windows.
MOST_REPEATED = 50


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column, width: int = 3) -> Column:
    """Number of words that lie in a ``width``-word window found twice or more among ``words``, the first included.

    Windows are told apart by a 64-bit hash of their words. Where all hashes differ (most texts) the answer is 0;
    else windows are sorted by hash, those with an equal neighbour are put back in text order, and each covers the
    words up to the next one's start."""
    n = F.size(words)

    def covered(starts: Column) -> Column:
        # the gap to the next repeated window, at most the width; the last covers its whole width
        gaps = F.zip_with(starts, F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))),
                          lambda a, b: F.least(F.coalesce(b - a, F.lit(width)), F.lit(width)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, x: acc + x)

    def in_order(pairs: Column) -> Column:
        last = F.size(pairs) - 1
        same = F.filter(pairs, lambda p, k: (
            ((k > 0) & (F.get(pairs, k - 1)["h"] == p["h"])) | ((k < last) & (F.get(pairs, k + 1)["h"] == p["h"]))))
        return _let(F.sort_array(F.transform(same, lambda p: p["k"])), covered)

    def by_hash(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, k: F.struct(h.alias("h"), k.alias("k"))))
        return (F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long"))
                .otherwise(_let(pairs, in_order)))

    hashes = F.transform(F.slice(words, 1, F.greatest(n - (width - 1), F.lit(0))), lambda x, i: F.xxhash64(
        x, *[F.get(words, i + j) for j in range(1, width)]))
    return F.when(n <= width, F.lit(0).cast("long")).otherwise(_let(hashes, by_hash))


def counts(text: Column) -> Column:
    """The counts that rules divide, as one struct; words and lines are split once."""
    t = F.coalesce(text, F.lit(""))
    stop = [*STOP_WORDS, *[x.capitalize() for x in STOP_WORDS], *[x.upper() for x in STOP_WORDS if len(x) > 1]]
    words = F.regexp_extract_all(t, F.lit(f"({WORD})"), F.lit(0))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    of_words = _let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.concat_ws("", w)).cast("long").alias("word_chars"),
        repeated_words(w).alias("n_repeat_words"),
        F.size(F.filter(w, lambda x: x.isin(stop))).cast("long").alias("n_stop_words")))
    of_lines = _let(lines, lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    n_symbols = F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long")
    return _let(F.struct(of_words.alias("w"), of_lines.alias("l"), n_symbols.alias("n_symbols")), lambda c: F.struct(
        *[c["w"][x].alias(x) for x in ("n_words", "word_chars", "n_repeat_words", "n_stop_words")],
        *[c["l"][x].alias(x) for x in ("n_lines", "n_dup_lines")], c["n_symbols"].alias("n_symbols")))


def compiled(rules: tuple[Rule, ...], c: Column) -> Column:
    """The names of the rules that a document breaks, as one array expression over its counts. A ratio with a
    whole of 0 is 0."""
    broken = []
    for r in rules:
        part, whole = c[r.part].cast("double"), c[r.whole]
        ratio = F.when(whole > 0, part / F.greatest(whole, F.lit(1))).otherwise(F.lit(0.0))
        outside = F.lit(False)
        if r.least is not None:
            outside = outside | (ratio < r.least)
        if r.most is not None:
            outside = outside | (ratio > r.most)
        broken.append(F.when(outside, F.lit(r.name)))
    return F.array_compact(F.array(*broken))


def base_failed(c: Column) -> Column:
    return (c["n_words"] < LEAST_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEATED * c["n_words"])


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, out: str = "__quality") -> DataFrame:
    """``docs`` with a struct ``out``: the counts, ``base_failed``, ``broken`` (names of broken rules) and ``kept``.

    Null and empty texts have no words, so they fail the base and are not kept. Texts are read whole. Every row gets
    its verdict alone: repeated rows, ties and empty tables need no care; other columns pass through."""
    def verdict(c: Column) -> Column:
        broken = compiled(rules, c)
        return F.struct(c.alias("counts"), base_failed(c).alias("base_failed"), broken.alias("broken"),
                        (~base_failed(c) & (F.size(broken) == 0)).alias("kept"))

    return docs.withColumn(out, _let(counts(F.col(text)), verdict))
