"""Connected components of a link table by alternating stars, with joins and partial minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _to_minimum(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with the least neighbour of u. A join rather than a window, so that a hot u can be split."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_to_minimum(both).where("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    near = _to_minimum(links)
    return (near.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(near.select("u", F.col("m").alias("v"))).distinct())


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(u, v)`` but the roots themselves; root is the least node
    of the node's component.

    Alternating large-star and small-star steps keep one row per link, whatever the size of a component; a
    round is written to the shared folder, and rounds end when one leaves the table as it was. Links of a
    node to itself and nulls take no part; no links give no rows."""
    links = written(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .distinct(), "links")

    def mark(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    before = mark(links)
    while before[0]:
        links = written(_small_star(_large_star(links)), "stars")
        after = mark(links)
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
