"""Landed API pages ``{"results": [...], "next": ...}`` -> one row per result item."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import materialised

#: Joins in one round.
JUMPS = 3


def api_page_links(df: DataFrame, body_col: str = "body", url_col: str = "url", next_path: str = "$.next") -> DataFrame:
    """``(url, next_url)``, one row per landed page."""
    return df.select(F.col(url_col).alias("url"), F.try_variant_get(F.try_parse_json(F.col(body_col)), next_path, "string").alias("next_url"))


def api_pages_flatten(df: DataFrame, body_col: str = "body", url_col: str = "url",
                      results_path: str = "$.results", next_path: str = "$.next") -> DataFrame:
    """Pages -> ``(url, next_url, is_last, pos, item variant)``.

    ``next_path`` locates the next-page pointer at the root (``$.next``) or
    deeper (``$.pagination.next``); a page without a pointer is the last.
    """
    v = F.try_parse_json(F.col(body_col))
    nxt = F.try_variant_get(v, next_path, "string")
    items = F.try_variant_get(v, results_path, "array<variant>")
    return df.select(F.col(url_col).alias("url"), nxt.alias("next_url"), nxt.isNull().alias("is_last"),
                     F.posexplode_outer(items).alias("pos", "item"))


def dangling_pages(pages: DataFrame, url_col: str = "url", next_col: str = "next_url") -> DataFrame:
    """Pointers to pages that were never landed (a broken or unfinished crawl)."""
    ptr = pages.select(F.col(next_col).alias(url_col)).where(F.col(url_col).isNotNull()).distinct()
    return ptr.join(pages.select(url_col).distinct(), url_col, "left_anti")


def page_positions(pages: DataFrame, url_col: str = "url", next_col: str = "next_url",
                   max_rounds: int = 64) -> DataFrame:
    """Position of every landed page in its ``next`` chain: ``(url, chain, page_pos)``.

    List ranking by pointer jumping: every page knows its successor and the
    distance to it; each round joins the pages that have not reached their
    chain's end with all pages on the successor, so that jumps grow by a
    factor and a chain of n pages needs about log(n) rounds. A round is written to the
    shared folder; pages that are done are only looked up. The chain is named
    by its last page, and a page's position is the head's distance to the end
    minus its own. A pointer to a page that was never landed ends the chain there.
    """
    nodes = pages.select(F.col(url_col).alias("url"), F.col(next_col).alias("nxt")).distinct()
    landed = nodes.select(F.col("url").alias("_landed"))
    cur = materialised(nodes.join(landed, F.col("nxt") == F.col("_landed"), "left").select(
        "url", F.col("_landed").alias("succ"), F.col("_landed").isNotNull().cast("long").alias("dist"),
        F.when(F.col("_landed").isNull(), F.col("url")).alias("tail")), "pages")
    # JUMPS joins on one written table make a round's reach 1 + JUMPS times the last one's
    rounds = min(max_rounds, math.ceil(math.log(max(cur.count(), 2), 1 + JUMPS)) + 1)
    for _ in range(rounds):
        going = cur.where("succ is not null")
        if going.isEmpty():
            break
        for _ in range(JUMPS):
            ahead = cur.select(F.col("url").alias("_at"), F.col("succ").alias("_succ"), F.col("dist").alias("_dist"), F.col("tail").alias("_tail"))
            # a page that has arrived joins nothing: a key of its own keeps them out of one task
            going = going.join(ahead, F.coalesce("succ", F.concat(F.lit("\0"), "url")) == F.col("_at"), "left").select(
                "url", F.col("_succ").alias("succ"), (F.col("dist") + F.coalesce("_dist", F.lit(0))).alias("dist"),
                F.coalesce("tail", "_tail").alias("tail"))
        cur = materialised(going.unionByName(cur.where("succ is null")), "pages")
    if not cur.where("succ is not null").isEmpty():
        raise RuntimeError("page chains did not resolve (a cycle in next pointers?)")
    heads = materialised(cur.groupBy("tail").agg(F.max("dist").alias("_len")), "chains")
    return cur.join(heads, "tail").select("url", F.col("tail").alias("chain"), (F.col("_len") - F.col("dist")).alias("page_pos"))
