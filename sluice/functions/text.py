"""Text helpers: identifiers, URL stems, delimited lists, ISO timestamps."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's behaviour):
# - safe file-name characters are word characters (letters, numbers, underscore, as in
#   Python's Unicode \w), period and hyphen
# - the key namespaces that are dropped, and how many parts a key of each has (org, course, run; org, library),
#   made of word characters, "-", "~", ".", ":"
KEY_NAMESPACES = (("course-v1:", 3), ("library-v1:", 2))
WORD = r"\p{L}\p{N}_"
COURSE_KEY_PART = r"[" + WORD + r"\-~.:]+"
UNSAFE_FILENAME_CHARS = r"[^" + WORD + r".\-]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_course_id(c, repl: str = "_") -> Column:
    """Course id usable in a file path: drop the key namespace, replace unsafe characters.

    ``library-v1:OrgX+Lib`` gives ``OrgX_Lib``; ``course-v1:OrgX+DemoX+2015`` and ``OrgX/DemoX/2015`` both give ``OrgX_DemoX_2015``;
    an unparsable id keeps its text (only unsafe characters are replaced).
    """
    c = _col(c)
    part = COURSE_KEY_PART
    # a namespace is dropped only when the rest is a valid key of it
    keys = "|".join(re.escape(name) + "(?=" + "\\+".join([part] * n) + "$)" for name, n in KEY_NAMESPACES)
    body = F.regexp_replace(c, f"^(?:{keys})", "")
    return F.regexp_replace(body, UNSAFE_FILENAME_CHARS, repl.replace("\\", "\\\\").replace("$", "\\$"))


def url_path(c) -> Column:
    """Path component of a URL (scheme, host, query and fragment removed)."""
    return F.regexp_extract(_col(c), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def url_file_stem(c) -> Column:
    """Last path segment without its last extension (``.../sitemap-0.xml`` -> ``sitemap-0``).

    Like a path split on the last dot, except that leading dots of a name do
    not start an extension (``.hid`` stays ``.hid``). ``;params`` of the last
    segment are not part of the name.
    """
    base = F.regexp_replace(F.regexp_extract(url_path(c), r"([^/]*)$", 1), r";.*$", "")
    has_ext = base.rlike(r"^.*[^.].*\.[^.]*$")
    return F.when(has_ext, F.regexp_extract(base, r"^(.*)\.[^.]*$", 1)).otherwise(base)


def delimited_list(c, sep: str = ";") -> Column:
    """``'a;b'`` -> ``[a, b]``; null or empty -> ``[]``; inner and trailing empties are kept."""
    c = _col(c)
    return F.when(F.coalesce(c, F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.split(c, re.escape(sep), -1))


def delimited_list_cap(c, sep: str = ";", cap: int = 25, label: str = "items",
                       row_id=None, on_error: str = "column") -> Column:
    """``delimited_list`` with an upper bound on the number of items.

    ``on_error="raise"`` fails the job on the first over-long list (like the
    reference); ``"column"`` returns null for it (pair with ``list_cap_error``).
    """
    items = delimited_list(c, sep)
    too_long = F.size(items) > cap
    if on_error == "raise":
        return F.when(too_long, F.raise_error(list_cap_error(c, sep, cap, label, row_id))).otherwise(items)
    return F.when(too_long, F.lit(None).cast("array<string>")).otherwise(items)


def list_cap_error(c, sep: str = ";", cap: int = 25, label: str = "items", row_id=None) -> Column:
    """Error text for an over-long list, null when the list is within the cap."""
    n = F.size(delimited_list(c, sep))
    who = F.coalesce(_col(row_id).cast("string"), F.lit("?")) if row_id is not None else F.lit("?")
    msg = F.concat(F.lit("row "), who, F.lit(": "), n.cast("string"), F.lit(f" {label}, the cap is {cap}"))
    return F.when(n > cap, msg)


def iso_format(c) -> Column:
    """ISO-8601 text of a timestamp, fraction only when non-zero (``2020-01-01T10:00:00[.000123]``)."""
    c = _col(c)
    base = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(c, ".SSSSSS")
    return F.when(c.isNull(), F.lit(None)).when(frac == ".000000", base).otherwise(F.concat(base, frac))
