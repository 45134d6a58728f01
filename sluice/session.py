"""Session helpers: building a local session and locating shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
LISTING_CONF = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sluice") -> SparkSession:
    """A local session for tests and benchmarks (a cluster brings its own)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``, or else the context's checkpoint folder.

    A local session that names neither (tests) gets a private folder, registered as the context's, so every later call
    sees the same root. On a cluster that would be the driver's own disk, so there it is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="sluice-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh path below the shared checkpoint root (never machine-local on a cluster)."""
    pieces = [checkpoint_root(spark), "sluice", *parts]
    if unique:
        pieces.append(uuid.uuid4().hex[:12])
    return "/".join(p.strip("/") if i else p for i, p in enumerate(pieces))


@contextmanager
def listing(spark: SparkSession):
    """Reads that begin inside list their folders in a few tasks a core. By default every folder is a task of its own, and starting
    it takes far longer than listing one folder."""
    before = spark.conf.get(LISTING_CONF, None)
    most = max(32, 4 * spark.sparkContext.defaultParallelism)
    spark.conf.set(LISTING_CONF, str(min(most, int(before)) if before else most))
    try:
        yield
    finally:
        if before:
            spark.conf.set(LISTING_CONF, before)
        else:
            spark.conf.unset(LISTING_CONF)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def delete_path(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hpath, True))


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the data files directly produced by one write (a bounded listing of one folder)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    out = []
    it = fs.listFiles(hpath, True)
    while it.hasNext():
        st = it.next()
        name = st.getPath().getName()
        if not name.startswith(("_", ".")):
            out.append(st.getPath().toString())
    return sorted(out)


__all__ = ["local_session", "checkpoint_root", "scratch_path", "listing", "path_exists", "delete_path", "list_files"]
