"""Incremental loads with Structured Streaming: new files only, exactly once per file.

The file source remembers the files it has processed in its checkpoint, so
a rerun with ``trigger(availableNow=True)`` reads only files that arrived
since; ``foreachBatch`` writes each micro-batch under its batch id with an
overwrite, so a replayed batch after a failure replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.batching import batch_pack
from ..session import path_exists
from ..sinks import snapshots
from ..sinks.guard import stage_and_swap

#: Above the number of any micro-batch.
LAST = 1 << 62


def _run(spark: SparkSession, path: str, checkpoint: str, fmt: str, schema: str | None, max_files_per_trigger: int | None,
         batch: Callable[[DataFrame, int], None], shape: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Hand the files that no earlier run processed to ``batch``, micro-batch by micro-batch; returns their number."""
    reader = spark.readStream.format(fmt)
    if schema:
        reader = reader.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(path).withColumn("origin_file_name", F.col("_metadata.file_path"))
    if shape:
        stream = shape(stream)
    batches = []

    def each(rows: DataFrame, batch_id: int) -> None:
        batch(rows, batch_id)
        batches.append(batch_id)

    q = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(each).start()
    q.awaitTermination()
    return len(batches)


def load_new_files(spark: SparkSession, path: str, sink: str, checkpoint: str, fmt: str = "text",
                   schema: str | None = None, shape: Callable[[DataFrame], DataFrame] | None = None,
                   max_files_per_trigger: int | None = None) -> int:
    """Process the files under ``path`` that no earlier run processed; returns the batch count."""
    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(_output(sink, batch_id))

    return _run(spark, path, checkpoint, fmt, schema, max_files_per_trigger, write, shape)


def _output(sink: str, batch_id: int) -> str:
    return f"{sink.rstrip('/')}/batch_id={batch_id}"


class State:
    """A table that a stream carries from one micro-batch to the next, under snapshots: a version per batch, with the batch
    and a number of the operator's own in its history. A batch that is run again, because its first run was lost before the
    stream's checkpoint had it, starts from the version before its first run."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def before(self, batch_id: int) -> tuple[DataFrame | None, int]:
        """The state that batch ``batch_id`` starts from, and its number (0 at first)."""
        snapshot = snapshots.current(self.spark, self.path)
        while snapshot and int(snapshot.history[0]) >= batch_id:
            snapshot = snapshots.at(self.spark, self.path, snapshot.version - 1) if snapshot.version > 1 else None
        return (snapshots.read(self.spark, self.path, snapshot), int(snapshot.history[1])) if snapshot else (None, 0)

    def after(self, batch_id: int, rows: DataFrame, number: int = 0) -> None:
        stage_and_swap(self.spark, rows, self.path, history=(str(batch_id), str(number)))


def high_water_stream(spark: SparkSession, path: str, sink: str, checkpoint: str, col: str, schema: str,
                      fmt: str = "parquet", mark=None, key: list[str] | None = None, max_files_per_trigger: int | None = None) -> int:
    """Rows of newly arrived files that lie above the mark of their ``key`` (no key: of all rows), each delivered once.

    The marks are state of the stream: the largest ``col`` that earlier batches delivered per key, so old rows that come
    again in a new file are dropped. ``mark`` is where keys without one begin (none: all rows count). They are compared by
    a join with the table of marks, one row a key, so no key goes through one task; a batch's marks are partial maxima."""
    state, keys = State(spark, f"{checkpoint.rstrip('/')}/marks"), list(key or [])

    def deliver(rows: DataFrame, batch_id: int) -> None:
        marks, _ = state.before(batch_id)
        kind = rows.schema[col].dataType
        first = F.lit(mark).cast(kind)
        if marks is None:
            above = rows.where(F.col(col) > first) if mark is not None else rows
        else:
            held = marks.select(*[F.col(c).alias(f"_key_{c}") for c in keys], F.col("mark").alias("_mark"))
            same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in keys]) if keys else F.lit(True)
            joined = rows.join(held, same, "left") if keys else rows.withColumn("_mark", F.lit(held.first()["_mark"]).cast(kind))
            bound = F.coalesce("_mark", first)
            above = joined.where(bound.isNull() | (F.col(col) > bound)).select(*rows.columns)
        above.write.mode("overwrite").parquet(_output(sink, batch_id))
        new = spark.read.schema(above.schema).parquet(_output(sink, batch_id)).groupBy(*keys).agg(F.max(col).alias("mark"))
        both = new if marks is None else marks.unionByName(new).groupBy(*keys).agg(F.max("mark").alias("mark"))
        state.after(batch_id, both)

    return _run(spark, path, checkpoint, fmt, schema, max_files_per_trigger, deliver)


def batch_pack_stream(spark: SparkSession, path: str, sink: str, checkpoint: str, size: int, order_by: list[str], schema: str,
                      fmt: str = "parquet", finish: bool = True, max_files_per_trigger: int | None = None) -> int:
    """Newly arrived rows packed into ``(batch, n, rows)`` of exactly ``size`` rows; returns the number of micro-batches.

    Fewer than ``size`` rows are left over by a micro-batch; they are state of the stream and come first in the next one. With
    ``finish`` what is left at the end of the run is written as one short batch. Batches are numbered on from run to run; rows
    are ordered by ``order_by`` inside a micro-batch."""
    state = State(spark, f"{checkpoint.rstrip('/')}/rest")

    def pack(rows: DataFrame, batch_id: int) -> None:
        rest, emitted = state.before(batch_id)
        rows = rows.drop("origin_file_name").withColumn("_new", F.lit(1))
        if rest is not None:
            rows = rows.unionByName(rest.withColumn("_new", F.lit(0)))
        packed = batch_pack(rows, size, ["_new", *order_by], "batch")
        packed.where(F.col("n") == size).select((F.col("batch") + emitted).alias("batch"), "n", F.transform(
            "rows", lambda r: r.dropFields("_new")).alias("rows")).write.mode("overwrite").parquet(_output(sink, batch_id))
        full = spark.read.parquet(_output(sink, batch_id)).count()
        left = packed.where(F.col("n") < size).select(F.explode("rows").alias("r")).select("r.*").drop("_new")
        state.after(batch_id, left, emitted + full)

    def last() -> tuple[DataFrame | None, int, int, str]:
        """What is left over, if anything, with its numbers and the folder of its short batch."""
        rest, emitted = state.before(LAST)
        if rest is None or rest.isEmpty():
            return None, 0, 0, ""
        batch_id = int(snapshots.current(spark, state.path).history[0])
        return rest, emitted, batch_id, f"{_output(sink, batch_id)}-last"

    rest, emitted, batch_id, folder = last()
    if rest is not None and path_exists(spark, folder + "/_SUCCESS"):  # a run was lost right after it wrote its short batch
        state.after(batch_id, rest.limit(0), emitted + 1)
    n = _run(spark, path, checkpoint, fmt, schema, max_files_per_trigger, pack)
    rest, emitted, batch_id, folder = last()
    if finish and rest is not None:
        short = batch_pack(rest, size, order_by, "batch").select((F.col("batch") + emitted).alias("batch"), "n", "rows")
        short.write.mode("overwrite").parquet(folder)
        state.after(batch_id, rest.limit(0), emitted + 1)
    return n
