"""From documents to pieces: language ID, quality rules, near-duplicates, mixing, encoding.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` on the whole of ``docs``; its result is written as Parquet and read
again as the next stage's ``docs``. All stages but the last return the columns of ``docs``, whatever they are."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import langid, mixing, pieces, quality, simhash
from sluice.llm.common import written
from sluice.llm.queries import SHARDS, _tokenizer


def _whole(docs: DataFrame):
    """All columns of a row as one struct, so that no name of theirs can clash."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told: those without text or letters go, and all others stay."""
    model = langid.fit(docs, learn=~langid.held_out(F.col("doc_id")))
    told = langid.identify(docs.select("text", _whole(docs)), model, keep=("__row",))
    return told.where(F.col("lang_pred") != langid.UNDETERMINED).select("__row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality.judge(docs.select("text", _whole(docs)))
    return judged.where("__quality.kept").select("__row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: the one of least doc_id (null last), then of least row hash; of
    rows that are equal in every column, one."""
    keyed = docs.select(_whole(docs)).withColumn("__id", F.col("__row.doc_id")).withColumn("__hash", F.xxhash64("__row"))
    rows = written(simhash.fingerprints(keyed.select("__id", "__hash", F.col("__row.text").alias("text")), keep=("__id", "__hash")), "dedup-rows")
    named = simhash.label(rows, "__id")
    first = (named.groupBy("root", "__id", "__hash").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("root").agg(F.min(F.struct(F.col("__id").isNull(), "__id", "__hash", "n")).alias("first")))
    first = written(first.select(F.col("first.__id").alias("__first_id"), F.col("first.__hash").alias("__first_hash"), F.col("first.n").alias("__n")), "dedup-first")
    one = keyed.join(first, (F.col("__hash") == F.col("__first_hash")) & F.col("__id").eqNullSafe(F.col("__first_id")))
    alone = one.where("__n = 1").select("__row")
    repeated = one.where("__n > 1").dropDuplicates(["__hash", "__id"]).select("__row")
    return alone.unionByName(repeated).select("__row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix to the target weights takes it (not at all, once or twice), dealt to shards and
    shuffled within them: rows stand shard by shard, in each by shuffle key."""
    return mixing.mix_documents(docs, mixing.plan(mixing.records(docs), SHARDS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of each document in place of its text: ids, n_pieces and lossless beside the other columns."""
    rest = [c for c in docs.columns if c not in ("text", "ids", "n_pieces", "lossless")]
    out = pieces.encode_documents(docs.select("text", "doc_id", F.struct(*[F.col(f"`{c}`") for c in rest]).alias("__row")),
                                  _tokenizer("piece_bpe_32k.model"), keep=("__row",))
    return out.select("__row.*", "ids", "n_pieces", "lossless")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id), ("quality_rules", quality_rules), ("near_dedup", near_dedup), ("mix", mix), ("encode", encode)]

#: SQL can express neither the language model's mixtures nor XXH64 fingerprints; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
