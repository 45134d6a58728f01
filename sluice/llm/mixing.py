"""Mixing sources to target weights: word targets, permuted blocks, and a splitting tree over output shards.

A pass over a source reads its documents in a permuted order, a keyed hash. The order is cut into blocks of about
``block_words`` words, and a pass draws a prefix of it: whole blocks and part of one. The drawn blocks of all
sources are then dealt to the output shards so that at every node of a binary tree the blocks that go left are a
uniform choice without replacement, i.e. multivariate hypergeometric by source."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, null_first_key, numbered_copies, row_places, written

WEIGHTS = (5, 2, 1)
#: Words of the mix over words of the input, and how often a document may be taken at most.
SHARE, MOST_PASSES = 1.5, 2
BLOCK_WORDS = 65_536
SHARDS = 40
SEED = 7
#: A very large source has fewer, larger blocks: its blocks are run through in one window.
MOST_BLOCKS = 1 << 18
#: Blocks of a pass that are ranked in one window when they are dealt.
DEAL_BLOCKS = 4096


@dataclass(frozen=True)
class Mix:
    """``sources``: one row a source (key, size, target, full passes, cut of the part pass). ``deal``: one row a drawn
    block (key, pass, block, shard)."""

    sources: DataFrame
    deal: DataFrame
    quotas: DataFrame


def position(seed: int, which: int, *columns: Column) -> Column:
    """The place of a row in the permuted order of its source: a keyed 64-bit hash, made non-negative."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(which), *columns), 1)


def records(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", seed: int = SEED) -> DataFrame:
    """(doc_id, key, source, size, place), written as a table: what mixing needs of a row, without its text. ``place`` hashes id and
    text, so rows of a repeated or null id have places of their own, and from the second copy on the copy's number, so rows
    equal in both have too."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), null_first_key(F.col(source)).alias("key"),
                       F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
                       position(seed, 0, F.col(doc_id), F.col(text)).alias("place"), row_places().alias("__at"))
    rows = written(rows.withColumn("__same", F.xxhash64("place", "key")), "mix-records")
    return _own_places(numbered_copies(rows, "__same", "__at", "__copy"), "place", seed).drop("__same")


def _own_places(rows: DataFrame, place: str, seed: int) -> DataFrame:
    """Places of their own for copies: rows that are equal in id, text and source are numbered."""
    moved = F.when(F.col("__copy") == 0, F.col(place)).otherwise(position(seed, 3, F.col(place), F.col("__copy")))
    return rows.withColumn(place, moved).drop("__copy")


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_PASSES) -> DataFrame:
    """(key, source, source_size, target) for every source of ``rows``.

    Sources stand in code-point order, null last, and weigh ``weights`` in turn. A source's target is its share of
    ``share`` times all sizes by weight; targets stop at ``most`` times the source's size, and what is cut off goes to
    the others by weight until none is above. That is target = min(most * size, level * weight) for one level; the
    level rises round by round as sources fill up, each round one small aggregate."""
    sizes = rows.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    # one row a source: the only order needed over all sources is their number's remainder
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (number % len(weights) + 1).cast("int"))
    table = written(sizes.withColumn("weight", weight.cast("double")), "sources")
    cap = F.col("source_size").cast("double") * most
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        is_full = cap <= level * F.col("weight")
        n, capped, weight_left = table.agg(F.count(F.when(is_full, 1)), F.coalesce(F.sum(F.when(is_full, cap)), F.lit(0.0)),
                                           F.coalesce(F.sum(F.when(~is_full, F.col("weight"))), F.lit(0.0))).first()
        if n == full or not weight_left:
            break
        full, level = n, (share * total - capped) / weight_left
    return table.withColumn("target", F.least(cap, F.lit(float(level)) * F.col("weight")))


def _cut(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` with ``cut`` (places up to it are in the part pass), ``edge`` (the place after it, whose document is
    taken in part), ``missing`` (so many words of it) and ``edge_size`` (its words).

    Words are summed by block, blocks are run through in order to the one where the part pass ends, and only that
    block's documents are ordered."""
    by_block = rows.join(sources.select("key", "blocks"), "key").withColumn("block", _block(F.col("place"), F.col("blocks")))
    sums = by_block.groupBy("key", "block").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("key").orderBy("block")
    last = (sums.withColumn("upto", F.sum("words").over(running)).join(sources.select("key", "part"), "key")
            .where((F.col("upto") > F.col("part")) & (F.col("upto") - F.col("words") <= F.col("part")) & (F.col("words") > 0))
            .select("key", "block", (F.col("part") - (F.col("upto") - F.col("words"))).alias("need")))
    ends = by_block.join(last, ["key", "block"]).groupBy("key", "need", "place").agg(F.sum("size").alias("size"))
    ends = ends.withColumn("upto", F.sum("size").over(Window.partitionBy("key").orderBy("place")))
    over = F.when(F.col("upto") > F.col("need"), F.struct(
        F.col("place").alias("edge"), F.col("size").alias("edge_size"), (F.col("need") - F.col("upto") + F.col("size")).alias("missing")))
    found = ends.groupBy("key").agg(F.min(over).alias("e")).select("key", "e.*")
    # no block ends the pass: nothing (part 0 or no words) or, for rounding's sake, all of it
    return sources.join(found, "key", "left").withColumn("cut", F.when(F.col("edge").isNotNull(), F.col("edge") - 1).when(
        F.col("part") <= 0, F.lit(-1).cast("long")).otherwise(F.lit(2 ** 63 - 1)))


def _block(place: Column, blocks: Column) -> Column:
    return F.least(F.floor(place.cast("double") / F.lit(2.0 ** 63) * blocks).cast("long"), blocks - 1)


def _leaf(rank: Column, total: Column, shards: int) -> Column:
    """The leaf of the splitting tree for the block of ``rank`` among ``total``: at a node of n shards, the first half
    of the shards (rounded down) takes its share of the node's blocks, rounded down."""
    def node(at: Column, n: Column, first: int, count: int) -> Column:
        if count == 1:
            return F.lit(first)
        left = count // 2
        to_left = F.floor(n * left / count).cast("long")
        return F.when(at < to_left, node(at, to_left, first, left)).otherwise(
            node(at - to_left, n - to_left, first + left, count - left))
    return node(rank, total, 0, shards)


def split_tree(drawn: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(key, pass, shard, start, quota): how many blocks of each source's pass go to each shard, and where in the pass's
    permuted blocks they begin.

    ``drawn(key, pass, quota)`` are the exact block quotas at the root. Each quota stands as that many tokens; tokens
    are put in one keyed random order and a node hands the first of its tokens to its left child. Given a node, the
    tokens in its left part are a uniform choice without replacement, so their counts by source are multivariate
    hypergeometric, at every node down to the shards. The order is ranked by hash range (counts of ranges, then
    ranks within a range), never in one window over all."""
    tokens = drawn.where("quota > 0").select("key", "pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("quota") - 1)).alias("token"))
    tokens = tokens.withColumn("u", F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(1), "key", "pass", "token"), 1))
    total = drawn.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    ranges = max(1, -(-total // DEAL_BLOCKS))
    tokens = tokens.withColumn("range", F.floor(F.col("u").cast("double") / F.lit(2.0 ** 63) * ranges).cast("long"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    first = tokens.groupBy("range").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "first", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    inside = Window.partitionBy("range").orderBy("u", "key", "pass", "token")
    ranked = tokens.join(first, "range").withColumn("rank", F.col("first") + F.row_number().over(inside) - 1)
    leaves = ranked.withColumn("shard", _leaf(F.col("rank"), F.lit(total).cast("long"), shards))
    quotas = leaves.groupBy("key", "pass", "shard").agg(F.count(F.lit(1)).alias("quota"))
    before = Window.partitionBy("key", "pass").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return quotas.withColumn("start", F.coalesce(F.sum("quota").over(before), F.lit(0)).cast("long"))


def plan(rows: DataFrame, shards: int = SHARDS, block_words: int = BLOCK_WORDS, seed: int = SEED,
         weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_PASSES) -> Mix:
    """What to draw from ``rows`` (of :func:`records`) and where it goes."""
    sources = targets(rows, weights, share, most)
    size = F.col("source_size")
    full = F.when(size > 0, F.floor(F.round(F.col("target")) / F.greatest(size, F.lit(1)))).otherwise(F.lit(0)).cast("long")
    sources = (sources.withColumn("full", full)
               .withColumn("part", F.round(F.col("target")).cast("long") - F.col("full") * size)
               .withColumn("blocks", F.least(F.greatest(F.ceil(size / block_words), F.lit(1)), F.lit(MOST_BLOCKS)).cast("long")))
    sources = written(_cut(rows, sources), "mix")
    draws = sources.select("key", "blocks", "cut", "edge", "missing", "full", F.posexplode(
        F.array(*[F.lit(p) for p in range(most)])).alias("pass", "p")).drop("p")
    last = F.when(F.col("missing") > 0, F.col("edge")).otherwise(F.col("cut"))
    draws = draws.withColumn("quota", F.when(F.col("pass") < F.col("full"), F.col("blocks")).when(
        (F.col("pass") == F.col("full")) & (last >= 0), _block(last, F.col("blocks")) + 1).otherwise(F.lit(0)).cast("long"))
    quotas = written(split_tree(draws.select("key", "pass", "quota"), shards, seed), "quotas")
    deal = quotas.select("key", "pass", "shard", F.explode(F.sequence(
        F.col("start"), F.col("start") + F.col("quota") - 1)).alias("block"))
    return Mix(sources, deal, quotas)


def _in_part() -> Column:
    return F.col("place") <= F.col("cut")


def _on_edge() -> Column:
    return F.coalesce((F.col("place") == F.col("edge")) & (F.col("missing") > 0), F.lit(False))


def _shuffle_key(seed: int, shard: Column, which: Column, place: Column) -> Column:
    """The place of a copy in the permuted order of its shard."""
    return F.xxhash64(F.lit(seed), F.lit(2), shard, which.cast("int"), place)


def assigned(rows: DataFrame, mix: Mix, seed: int = SEED) -> DataFrame:
    """``rows`` with source_size, target, ``taken`` (words, repeats counted), ``edge_words`` (those of the part pass that
    are only a part of the document, else null), ``shards``: the shard of each of the row's copies, in the order of
    passes, empty where the mix leaves the row out; and ``shuffle_keys``: the copies' places in the order of their shards."""
    r = rows.join(mix.sources.select("key", "source_size", "target", "full", "cut", "edge", "missing", "edge_size", "blocks"), "key")
    r = r.withColumn("copies", (F.col("full") + (_in_part() | _on_edge()).cast("long")).cast("int")).withColumn(
        "block", _block(F.col("place"), F.col("blocks")))
    r = r.withColumn("edge_words", F.when(_on_edge(), F.floor(F.col("missing") * F.col("size") / F.col("edge_size")).cast("long")))
    # a block is drawn once a pass: at most as many entries as passes
    by_block = mix.deal.groupBy("key", "block").agg(F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("dealt"))
    r = r.join(by_block, ["key", "block"], "left")
    shards = F.transform(F.slice(F.coalesce("dealt", F.array()), 1, F.greatest(F.col("copies"), F.lit(0))), lambda x: x["shard"])
    r = r.withColumn("shards", F.when(F.col("copies") > 0, shards).otherwise(F.array().cast("array<int>")))
    r = r.withColumn("shuffle_keys", F.transform("shards", lambda s, i: _shuffle_key(seed, s, i, F.col("place"))))
    taken = F.col("size") * F.size("shards").cast("long")
    return (r.withColumn("taken", F.when(F.col("edge_words").isNotNull(), taken - F.col("size") + F.col("edge_words")).otherwise(taken))
            .drop("full", "cut", "edge", "missing", "edge_size", "blocks", "copies", "dealt", "block"))


def drawn(rows: DataFrame, mix: Mix, seed: int = SEED) -> DataFrame:
    """One row for every copy in the mix, with ``pass``, ``shard``, ``words`` (how many of the document's first words the
    copy has: all, but for a source's last document) and ``shuffle_key`` (the order within the shard)."""
    r = assigned(rows, mix, seed).withColumn("copies", F.size("shards"))
    r = r.select("*", F.posexplode("shards").alias("pass", "shard"))
    r = r.withColumn("words", F.when(F.col("pass") == F.col("copies") - 1, F.coalesce("edge_words", "size")).otherwise(F.col("size")))
    return (r.withColumn("shuffle_key", F.element_at("shuffle_keys", F.col("pass") + 1))
            .drop("shards", "shuffle_keys", "taken", "edge_words", "copies"))


def mix_documents(docs: DataFrame, mix: Mix, text: str = "text", source: str = "source", doc_id: str = "doc_id",
                  seed: int = SEED) -> DataFrame:
    """``docs`` with each row repeated as often as the mix takes it, in the order of the mix: shard by shard, and in each
    shard by the copies' shuffle keys. Documents stay whole: a source's last one is taken if the mix takes half of it or
    more. Which copies a row has and where they go is an expression over the row and its source's row of the plan; then
    texts are shuffled once, by range of shard and key, so that no range depends on the size of a shard."""
    quotas = mix.quotas.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("pass", "start", "shard"))).alias("dealt"))  # shards times passes
    s = mix.sources.select("full", "cut", "edge", "missing", "edge_size", "blocks", "key").join(quotas, "key", "left")
    s = s.toDF(*[f"__{c}" for c in s.columns])
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    place = position(seed, 0, F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("__place")
    r = docs.select(whole, place, null_first_key(F.col(f"`{source}`")).alias("__source")).withColumn("__same", F.xxhash64("__place", "__source"))
    repeated = written(r.groupBy("__same").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__same"), "repeated-rows")
    if not repeated.isEmpty():  # only rows that stand more than once are written and numbered
        several = written(r.join(repeated, "__same", "left_semi").withColumn("__at", row_places()), "repeated-documents")
        several = _own_places(numbered_copies(several, "__same", "__at", "__copy"), "__place", seed)
        r = r.join(repeated, "__same", "left_anti").select(*several.columns).unionByName(several)
    r = r.join(s, F.col("__source") == F.col("__key"))
    edge = F.coalesce((F.col("__place") == F.col("__edge")) & (2 * F.col("__missing") >= F.col("__edge_size")), F.lit(False))
    r = r.withColumn("__copies", (F.col("__full") + ((F.col("__place") <= F.col("__cut")) | edge).cast("long")).cast("int")).where("__copies > 0")
    r = r.withColumn("__block", _block(F.col("__place"), F.col("__blocks"))).withColumn("__pass", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)))
    runs = F.filter("__dealt", lambda x: (x["pass"] == F.col("__pass")) & (x["start"] <= F.col("__block")))
    r = r.withColumn("__shard", F.element_at(runs, -1)["shard"])
    r = r.withColumn("__shuffle", _shuffle_key(seed, F.col("__shard"), F.col("__pass"), F.col("__place")))
    return r.orderBy("__shard", "__shuffle").select("__row.*")
