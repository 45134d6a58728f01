"""Tables of immutable folders with one pointer to the current version.

A load writes its rows to a fresh folder that nobody reads yet. Then a small pointer file for the next version, which names the
folders that make up the table, is published in one atomic step that fails if that version exists. Readers take the newest
pointer and only read; they see the table before or after a load, never in between. Of two loads that build on the same version one
publishes, the other finds its version taken and starts again from the new one. What a lost driver leaves behind is named by no
pointer. ``vacuum`` removes old versions and such leftovers; loads never delete.

``<table>/_snapshots/v000000000001.json``           pointer files
``<table>/_snapshots/data/__load=<id>/...``         rows of one load
``<table>/_snapshots/index/__load=<id>/...``        per file of a load: least and greatest slice key, and a Bloom filter
Data files that lie in ``<table>`` itself, from before its first load, belong to the table until a load replaces them.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path, path_exists

FOLDER, DATA, INDEX, LOAD = "_snapshots", "_snapshots/data", "_snapshots/index", "__load"
#: Bits of a file's Bloom filter (what Spark's bitmap aggregate holds), and bits that a key sets.
BLOOM_BITS, BLOOM_HASHES = 32_768, 4
#: The load that stands for files in the table's own folder.
PLAIN = ""


@dataclass(frozen=True)
class Snapshot:
    """A version of a table. ``loads``: load id -> names of its partition folders that no longer count. ``history``: ids that
    the version has taken in, whether or not rows of them are left."""

    version: int = 0
    fmt: str = "parquet"
    schema: T.StructType | None = None
    partition_col: str | None = None
    loads: dict[str, frozenset[str]] = field(default_factory=dict)
    history: tuple[str, ...] = ()
    #: Loads whose files are indexed, by key column.
    indexed: dict[str, str] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"version": self.version, "fmt": self.fmt, "schema": self.schema and json.loads(self.schema.json()),
                           "partition_col": self.partition_col, "loads": [[k, sorted(v)] for k, v in self.loads.items()], "history": list(self.history),
                           "indexed": self.indexed})

    @staticmethod
    def from_json(text: str) -> Snapshot:
        d = json.loads(text)
        return Snapshot(d["version"], d["fmt"], d["schema"] and T.StructType.fromJson(d["schema"]), d["partition_col"],
                        {k: frozenset(v) for k, v in d["loads"]}, tuple(d["history"]), d.get("indexed", {}))


class Conflict(RuntimeError):
    """Another load published first, again and again."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modification time in ms) of what lies directly in a folder (metadata: versions, loads or partitions)."""
    fs, p, _ = _fs(spark, path)
    return sorted((st.getPath().getName(), int(st.getModificationTime())) for st in fs.listStatus(p)) if fs.exists(p) else []


def _read_text(spark: SparkSession, path: str) -> str:
    fs, p, jvm = _fs(spark, path)
    stream = fs.open(p)
    try:
        return str(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _pointer(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{FOLDER}/v{version:012d}.json"


def _versions(spark: SparkSession, path: str) -> list[int]:
    names = [n for n, _ in children(spark, f"{path.rstrip('/')}/{FOLDER}")]
    return sorted(int(n[1:13]) for n in names if n.startswith("v") and n.endswith(".json"))


def current(spark: SparkSession, path: str, fmt: str = "parquet") -> Snapshot | None:
    """The newest version; files without a pointer are version 0 of a table; None if there is neither."""
    versions = _versions(spark, path)
    if versions:
        return Snapshot.from_json(_read_text(spark, _pointer(path, versions[-1])))
    if not path_exists(spark, path) or not any(not n.startswith(("_", ".")) for n, _ in children(spark, path)):
        return None
    return Snapshot(0, fmt, spark.read.format(fmt).load(path).schema, None, {PLAIN: frozenset()})


def at(spark: SparkSession, path: str, version: int) -> Snapshot:
    """An earlier version that ``vacuum`` has not removed."""
    return Snapshot.from_json(_read_text(spark, _pointer(path, version)))


def _published(spark: SparkSession, path: str, version: int, text: str) -> bool:
    """Create the pointer of ``version``; False if it exists. The text is written aside and put in place whole, by a link
    on local disks and else by the file system's rename without overwrite, which HDFS does in one step."""
    target = _pointer(path, version)
    aside = f"{path.rstrip('/')}/{FOLDER}/.{uuid.uuid4().hex}.tmp"
    fs, p, jvm = _fs(spark, aside)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    to = jvm.org.apache.hadoop.fs.Path(target)
    try:
        if fs.getScheme() == "file":
            local = lambda x: jvm.java.nio.file.Paths.get(fs.makeQualified(x).toUri())
            jvm.java.nio.file.Files.createLink(local(to), local(p))
            fs.delete(p, False)
        else:
            none = jvm.org.apache.hadoop.fs.Options.Rename.NONE
            rename = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            rename[0] = none
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(p, to, rename)
        return True
    except Exception:
        fs.delete(p, False)
        if path_exists(spark, target):
            return False
        raise


def commit(spark: SparkSession, path: str, base: Snapshot | None, new: Snapshot) -> bool:
    """Publish ``new`` as the version after ``base``; False if another load took that version."""
    version = (base.version if base else 0) + 1
    return _published(spark, path, version, replace(new, version=version).to_json())


def stage(spark: SparkSession, path: str, rows: DataFrame, partition_col: str | None, fmt: str, load: str | None = None) -> tuple[str, int]:
    """Write rows to a folder that no pointer names yet (or add them to ``load``): ``(load id, rows)``."""
    mode = "errorifexists" if load is None else "append"
    load = load or uuid.uuid4().hex
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    w = rows.observe(obs, F.count(F.lit(1)).alias("n")).write.format(fmt).mode(mode)
    (w.partitionBy(partition_col) if partition_col else w).save(f"{path.rstrip('/')}/{DATA}/{LOAD}={load}")
    return load, int(obs.get.get("n", 0))


def _bits(key: Column) -> list[Column]:
    """The places of a key in a Bloom filter."""
    return [F.pmod(F.xxhash64(F.lit(i), key), F.lit(BLOOM_BITS)) for i in range(BLOOM_HASHES)]


def index_load(spark: SparkSession, path: str, load: str, rows_schema: T.StructType, key: str, fmt: str) -> None:
    """Write the index of a load's files: ``(file, least, greatest, bloom)`` over the text of ``key``. Keys that repeat in a file are
    counted once before they set bits; a file with very many keys has a full filter, which excludes nothing."""
    folder = f"{path.rstrip('/')}/{DATA}/{LOAD}={load}"
    keys = (spark.read.format(fmt).schema(rows_schema).load(folder).select(F.col("_metadata.file_path").alias("file"), F.col(key).cast("string").alias("key"))
            .where("key is not null").distinct())
    bits = keys.select("file", F.explode(F.array(*_bits(F.col("key")))).alias("bit")).groupBy("file").agg(F.bitmap_construct_agg("bit").alias("bloom"))
    ends = keys.groupBy("file").agg(F.min("key").alias("least"), F.max("key").alias("greatest"))
    ends.join(bits, "file").write.parquet(f"{path.rstrip('/')}/{INDEX}/{LOAD}={load}")


def candidate_files(spark: SparkSession, path: str, snapshot: Snapshot, key: str, value) -> list[str] | None:
    """The files that may hold rows whose ``key`` equals ``value``, by the index alone: none means that the slice is absent. None if a
    load of the version is not indexed by that key. The names of files that a scan of one slice needs."""
    if not all(snapshot.indexed.get(load) == key for load in snapshot.loads) or any(snapshot.loads.values()):
        return None
    if not snapshot.loads:
        return []
    root = f"{path.rstrip('/')}/{INDEX}"
    rows = spark.read.schema("file string, least string, greatest string, bloom binary").parquet(*[f"{root}/{LOAD}={load}" for load in snapshot.loads])
    text = F.lit(value).cast("string")
    hit = (F.col("least") <= text) & (F.col("greatest") >= text)
    for bit in _bits(text):
        byte = F.conv(F.hex(F.substring("bloom", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        hit = hit & (F.floor(byte / F.pow(F.lit(2), bit % 8)) % 2 == 1)
    return [r[0] for r in rows.where(hit).select("file").collect()]


def read_files(spark: SparkSession, snapshot: Snapshot, files: list[str]) -> DataFrame:
    """The rows of some files of an unpartitioned version."""
    return spark.read.format(snapshot.fmt).schema(snapshot.schema).load(files) if files else spark.createDataFrame([], snapshot.schema)


def _folder(partition_col: str | None):
    return F.regexp_extract(F.col("_metadata.file_path"), f"/({partition_col}=[^/]*)/", 1) if partition_col else F.lit("")


def read(spark: SparkSession, path: str, snapshot: Snapshot, only: set[str] | None = None, folder: str | None = None) -> DataFrame:
    """The rows of a version; ``only`` those in the named partition folders. ``folder`` names a column with each row's own."""
    root, col = path.rstrip("/"), snapshot.partition_col
    columns = [F.col(f"`{c}`") for c in snapshot.schema.names]
    named = [_folder(col or "[^/=]+").alias(folder)] if folder else []
    out, paths = None, []
    for load, gone in snapshot.loads.items():
        top = root if load == PLAIN else f"{root}/{DATA}/{LOAD}={load}"
        if gone or only is not None:
            wanted = [n for n, _ in children(spark, top) if "=" in n and n not in gone and (only is None or n in only)]
            here = [f"{top}/{n}" for n in wanted]
        else:
            here = [top]
        if load == PLAIN and here:
            out = spark.read.format(snapshot.fmt).schema(snapshot.schema).option("basePath", root).load(here).select(*columns, *named)
        elif load != PLAIN:
            paths += here
    if paths:
        own = (spark.read.format(snapshot.fmt).schema(T.StructType([*snapshot.schema.fields, T.StructField(LOAD, T.StringType())]))
               .option("basePath", f"{root}/{DATA}").load(paths).select(*columns, *named))
        out = own if out is None else out.unionByName(own)
    if out is None:
        out = spark.createDataFrame([], snapshot.schema)
        out = out.withColumn(folder, F.lit("")) if folder else out
    return out


def without(spark: SparkSession, path: str, snapshot: Snapshot, partitions: set[str]) -> dict[str, frozenset[str]]:
    """The loads of a version without the named partition folders; loads of which nothing is left are dropped."""
    out = {}
    for load, gone in snapshot.loads.items():
        gone |= partitions
        top = path.rstrip("/") if load == PLAIN else f"{path.rstrip('/')}/{DATA}/{LOAD}={load}"
        if any(n not in gone and not n.startswith(("_", ".")) for n, _ in children(spark, top)):
            out[load] = gone
    return out


def partition_names(found: list[str]) -> set[str]:
    """Folder names as the file system has them, from file paths, which are URLs."""
    return {unquote(n) for n in found if n}


def merged(old: T.StructType | None, new: T.StructType) -> T.StructType:
    """The columns of ``old``, then those that only ``new`` has; all may be null."""
    fields = list(old.fields) if old else []
    fields += [f for f in new.fields if f.name not in {g.name for g in fields}]
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in fields])


def conformed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` in the columns and types of ``schema``; columns that it lacks are null."""
    return rows.select(*[(F.col(f"`{f.name}`") if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def vacuum(spark: SparkSession, path: str, keep: int = 1, older_than_s: float = 86_400.0) -> list[str]:
    """Delete all but the newest ``keep`` versions, and the folders that no kept version names. Folders younger than
    ``older_than_s`` stay, as a running load may be about to publish them. Returns the names of what was deleted."""
    root, versions = path.rstrip("/"), _versions(spark, path)
    kept, limit = versions[-max(1, keep):], (time.time() - older_than_s) * 1000
    named = {f"{LOAD}={x}" for v in kept for x in Snapshot.from_json(_read_text(spark, _pointer(path, v))).loads}
    gone = [_pointer(path, v) for v in versions if v not in kept]
    gone += [f"{root}/{part}/{n}" for part in (DATA, INDEX) for n, at in children(spark, f"{root}/{part}") if n not in named and at <= limit]
    for x in gone:
        delete_path(spark, x)
    return [x.rsplit("/", 1)[1] for x in gone]
