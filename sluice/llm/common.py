"""Helpers shared by the corpus operators: written tables, clash-free column names, batch access."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: ASCII white space; what the contracts call a word is a run of anything else.
WORD = "[^\\x20\\x09-\\x0D]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends here, so a lost executor costs no recomputation
    of what stands above, and the reader knows the table's true size."""
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column of an Arrow batch."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def n_words(text: Column) -> Column:
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def null_first_key(col: Column) -> Column:
    """A never-null text key of a nullable text, distinct for null and for every value."""
    return F.when(col.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), col))


def only(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The named columns alone, so that further columns of the input can't clash with an operator's own."""
    return df.select(*[F.col(c) for c in columns])


#: Rows of a stretch of a written table; copies are ranked inside stretches.
STRETCH = 10_000


def row_places() -> Column:
    """A number for each row of a table that is about to be written; rows of a stretch lie side by side."""
    return F.monotonically_increasing_id()


def numbered_copies(rows: DataFrame, key: str, at: str, copy: str) -> DataFrame:
    """``rows`` (a written table; ``at`` holds :func:`row_places`) without ``at``, with ``copy``: 0, 1, .. among the rows of equal
    ``key``, 0 for a row that is alone.

    Copies are counted by stretch, the counts of a key's stretches are run through in order, and rows are ranked inside a
    stretch, so no window holds more than STRETCH rows or one key's stretches, whatever the number of copies. Where nothing
    repeats, no row is moved."""
    repeated = written(rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(F.col(key).alias("__key")), "repeated")
    if repeated.isEmpty():
        return rows.drop(at).withColumn(copy, F.lit(0).cast("long"))
    marked = rows.join(repeated, F.col(key) == F.col("__key"), "left").withColumn("__stretch", F.floor(F.col(at) / STRETCH).cast("long"))
    counts = marked.where("__key is not null").groupBy("__key", "__stretch").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy("__key").orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(counts.select(F.col("__key").alias("__of"), F.col("__stretch").alias("__in"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before")), "copies")
    inside = Window.partitionBy("__key", "__stretch").orderBy(at)
    several = (marked.where("__key is not null").withColumn("__rank", F.row_number().over(inside) - 1)
               .join(counts, (F.col("__key") == F.col("__of")) & (F.col("__stretch") == F.col("__in")))
               .withColumn(copy, (F.col("__before") + F.col("__rank")).cast("long")))
    columns = [*[c for c in rows.columns if c != at], copy]
    alone = marked.where("__key is null").withColumn(copy, F.lit(0).cast("long"))
    return written(alone.select(*columns).unionByName(several.select(*columns)), "numbered")
