"""Sitemaps: index documents -> sitemap URLs, urlsets -> page URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import url_file_stem

_XML = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "ignoreNamespace": "true"}


def _locs(df: DataFrame, doc_col: str, tag: str, keep: list[str]) -> DataFrame:
    """One row per entry with the text of its first ``<loc>``; each document is parsed once, in any namespace. An entry
    without a ``<loc>`` text keeps its row, with an error, and so does a document that is no XML (without a ``pos``). A
    document without entries, whatever its root, has no rows."""
    parsed = df.select(*keep, F.col(doc_col).alias("_doc"), F.from_xml(
        F.col(doc_col), f"{tag} array<struct<loc array<string>>>, _corrupt_record string", _XML).alias("_x"))
    ok = F.col("_doc").isNotNull() & F.col("_x").isNotNull() & F.col("_x._corrupt_record").isNull()
    entry = lambda at, url: F.struct(at.cast("int").alias("pos"), url.alias("url"))
    url = lambda x: F.regexp_replace(F.get(x["loc"], F.lit(0)), r"^\s+|\s+$", "")
    entries = F.transform(F.col(f"_x.{tag}"), lambda x, i: entry(i + 1, F.when(url(x) != "", url(x))))
    none = F.array(entry(F.lit(None), F.lit(None).cast("string")))
    rows = parsed.select(*keep, F.explode(F.when(ok, entries).otherwise(none)).alias("_entry"))
    return rows.select(*keep, "_entry.pos", "_entry.url", F.when(F.col("_entry.pos").isNull(), F.lit("malformed XML document")).when(
        F.col("_entry.url").isNull(), F.lit(f"<{tag}> entry without text in <loc>")).alias("error"))


def sitemap_index_urls(df: DataFrame, doc_col: str = "doc", keep: list[str] | None = None) -> DataFrame:
    """``<sitemapindex>`` documents -> one row per ``<sitemap><loc>`` (trimmed), any namespace."""
    return _locs(df, doc_col, "sitemap", keep or [])


def sitemap_urls(df: DataFrame, doc_col: str = "doc", scraped_at=None, source_url_col: str | None = None,
                 keep: list[str] | None = None) -> DataFrame:
    """``<urlset>`` documents -> ``(scraped_at, url[, sitemap])``; other child tags are dropped."""
    keep = list(keep or [])
    if source_url_col and source_url_col not in keep:
        keep.append(source_url_col)
    out = _locs(df, doc_col, "url", keep)
    sa = scraped_at if isinstance(scraped_at, Column) else F.lit(scraped_at).cast("string")
    out = out.withColumn("scraped_at", sa)
    if source_url_col:
        out = out.withColumn("sitemap", url_file_stem(F.col(source_url_col)))
    return out
