"""Sharding by fixed virtual slots and a versioned slot-to-shard map."""

from __future__ import annotations

import heapq
import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import numbered_copies, row_places, written

#: Fixed for the life of a data set: a record's slot never changes, only the slot's shard does.
SLOTS = 8192
#: Bytes that a record costs beside its text.
RECORD_BYTES = 16


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + RECORD_BYTES).cast("long")


def virtual_slot(*columns: Column, slots: int = SLOTS) -> Column:
    """The slot of a record: a hash of its columns. Id and text together spread the rows of a repeated or null id."""
    return F.pmod(F.xxhash64(*columns), F.lit(slots)).cast("int")


def slotted(docs: DataFrame, keep: list[Column], doc_id: str = "doc_id", text: str = "text", slots: int = SLOTS) -> DataFrame:
    """``keep`` columns of every row, with ``size`` and ``virtual_slot``, written as a table. Rows equal in id and text have
    slots of their own: the number of the copy enters the hash from the second one on."""
    t = F.col(text)
    rows = written(docs.select(*keep, record_size(t).alias("size"), F.xxhash64(F.col(doc_id), t).alias("__hash"), row_places().alias("__at")), "records")
    rows = numbered_copies(rows, "__hash", "__at", "__copy")
    hashed = F.when(F.col("__copy") == 0, F.col("__hash")).otherwise(F.xxhash64("__hash", "__copy"))
    return rows.withColumn("virtual_slot", F.pmod(hashed, F.lit(slots)).cast("int")).drop("__hash", "__copy")


def slot_sizes(records: DataFrame) -> DataFrame:
    """(virtual_slot, bytes, rows): what the map is made from, at most one row a slot."""
    return records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def first_map(shards: int, slots: int = SLOTS) -> list[int]:
    """Version 0: slots dealt in equal runs, before any size is known."""
    return [slot * shards // slots for slot in range(slots)]


def rebalance(mapping: list[int], sizes: dict[int, int], shards: int) -> list[int]:
    """The next version of a map: as few slots move as bring every shard near the mean.

    Shards over the mean give up slots (the largest that fit into the excess first); the slots given up, with those of
    shards that are no more, go largest first to the shard with least bytes; then a swap of two slots between the
    fullest and the emptiest shard is taken while one narrows their gap. Sizes are per slot, so this works on the
    slot table alone, whatever the number of records."""
    total = sum(sizes.values())
    mean = total / shards
    held: list[dict[int, int]] = [{} for _ in range(shards)]
    free = []
    for slot, shard in enumerate(mapping):
        if shard < shards:
            held[shard][slot] = sizes.get(slot, 0)
        else:
            free.append(slot)
    load = [sum(h.values()) for h in held]
    for k, h in enumerate(held):
        for slot in sorted(h, key=lambda s: (-h[s], s)):
            if load[k] <= mean:
                break
            if 0 < h[slot] <= load[k] - mean:
                load[k] -= h.pop(slot)
                free.append(slot)
    heap = [(b, k) for k, b in enumerate(load)]
    heapq.heapify(heap)
    for slot in sorted(free, key=lambda s: (-sizes.get(s, 0), s)):
        b, k = heapq.heappop(heap)
        held[k][slot] = sizes.get(slot, 0)
        load[k] = b + sizes.get(slot, 0)
        heapq.heappush(heap, (load[k], k))
    for _ in range(20 * shards):
        hi, lo = max(range(shards), key=lambda k: (load[k], -k)), min(range(shards), key=lambda k: (load[k], k))
        gap = load[hi] - load[lo]
        down = sorted((n, s) for s, n in held[lo].items())
        best = None
        for slot, n in sorted(held[hi].items()):
            # the swap partner that brings n - other nearest to half the gap
            at = _bisect(down, n - gap / 2)
            for other in [*down[max(0, at - 1):at + 1], (0, None)]:
                d = n - other[0]
                if 0 < d < gap and (best is None or abs(gap - 2 * d) < best[0]):
                    best = (abs(gap - 2 * d), slot, other[1], d)
        if best is None or gap - best[0] < max(1, total // 10_000_000):
            break
        _, slot, other, d = best
        held[lo][slot] = held[hi].pop(slot)
        if other is not None:
            held[hi][other] = held[lo].pop(other)
        load[hi] -= d
        load[lo] += d
    out = [0] * len(mapping)
    for k, h in enumerate(held):
        for slot in h:
            out[slot] = k
    return out


def _bisect(pairs: list[tuple[int, int]], x: float) -> int:
    lo, hi = 0, len(pairs)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (mid + 1, hi) if pairs[mid][0] < x else (lo, mid)
    return lo


def map_table(spark: SparkSession, versions: list[list[int]]) -> DataFrame:
    """(version, virtual_slot, shard): every version of the map, to be stored beside the data."""
    tables = [spark.range(1).select(F.lit(v).alias("version"),
                                    F.posexplode(F.from_json(F.lit(json.dumps(m)), "array<int>")).alias("virtual_slot", "shard"))
              for v, m in enumerate(versions)]
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def map_path(spark: SparkSession) -> str:
    """A new place for a map in the shared folder."""
    return scratch_path(spark, "llm", "slot-map")


def store_map(spark: SparkSession, path: str, versions: list[list[int]]) -> DataFrame:
    """Writes the versions as Parquet, one folder a version, and reads them again."""
    map_table(spark, versions).coalesce(1).write.mode("overwrite").partitionBy("version").parquet(path)
    return spark.read.schema("virtual_slot int, shard int, version int").parquet(path)


def balanced_map(records: DataFrame, shards: int, slots: int = SLOTS, start: list[int] | None = None) -> list[list[int]]:
    """[start, rebalanced]: the map before and after the bytes of each slot are known. The driver sees the slot
    table alone, at most ``slots`` rows."""
    start = first_map(shards, slots) if start is None else start
    sizes = {r["virtual_slot"]: r["bytes"] for r in slot_sizes(records).collect()}
    return [start, rebalance(start, sizes, shards)]


def place(records: DataFrame, mapping: DataFrame, order_by: list[str]) -> DataFrame:
    """``records`` (with virtual_slot) with ``shard`` and ``slot``, the record's place in its shard, from 0 without gaps.

    A place is the number of records in the shard's earlier virtual slots (one row a slot) plus the record's rank in
    its own slot, so that the largest window holds one virtual slot, not one shard. Equal rows may trade places."""
    counts = records.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    # at most one row a virtual slot: a proven bound
    starts = F.broadcast(counts.join(F.broadcast(mapping), "virtual_slot").withColumn(
        "first", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).select("virtual_slot", "shard", "first"))
    inside = Window.partitionBy("virtual_slot").orderBy(*order_by)
    return (records.withColumn("__rank", F.row_number().over(inside)).join(starts, "virtual_slot")
            .withColumn("slot", (F.col("first") + F.col("__rank") - 1).cast("long")).drop("first", "__rank"))
