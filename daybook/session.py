"""Session helpers: a local session for tests and the bench, the shared
scratch folder that jobs use to cut lineage or stage intermediate files, and
joins with sides of a checked size."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


LISTERS = 200  # tasks that list files, where the cluster hasn't more cores


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "daybook") -> SparkSession:
    """A local session configured the way tests and the bench expect.

    On a cluster the caller brings its own session; nothing in the library
    depends on these settings except a UTC zone for comparisons with oracles.
    """
    # One BLAS thread a Python worker, as a cluster manager sets it: the workers share the cores.
    os.environ.setdefault("OMP_NUM_THREADS", "1")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    It is read from the session and must be a filesystem that every executor
    reaches (HDFS, an object store). Where it is unset a local session gets
    a temporary folder, removed when Python ends; on a cluster, whose
    executors could not see such a folder, that is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        own = tempfile.mkdtemp(prefix="daybook-ckpt-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc.setCheckpointDir(own)
        d = sc.getCheckpointDir()
    return d.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared scratch folder."""
    return "/".join([scratch_dir(spark), *parts])


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed now and read back from reliable checkpoint files in the
    shared folder: later plans start there, and lost executors cost nothing."""
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def few_listers(spark: SparkSession) -> Iterator[None]:
    """Readers made inside list their folders in ``listers`` tasks at most, and keep the listing only as long as they live.

    Spark alone makes up to 10,000 tasks, each of which costs more than listing a few
    folders, and holds up to 250 MB of listings on the driver that no other reader uses.
    """
    tasks = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    old = {k: spark.conf.get(k) for k in (tasks, "spark.sql.hive.filesourcePartitionFileCacheSize")}
    try:
        for k, v in old.items():
            spark.conf.set(k, str(min(listers(spark), int(v))) if k == tasks else "0")
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def listers(spark: SparkSession) -> int:
    return max(LISTERS, spark.sparkContext.defaultParallelism * 4)


def checked_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` computed once, and hinted for broadcast if it has at most
    ``max_rows`` rows. Beyond that a join with it shuffles both sides (split
    where skewed by adaptive execution); the rows are the same."""
    df = cut(df)
    return F.broadcast(df) if df.count() <= max_rows else df


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file or folder on whatever file system it is, through the JVM of a classic (not Connect) session."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    if not old.getFileSystem(spark._jsc.hadoopConfiguration()).rename(old, new):
        raise OSError(f"can't rename {path} to {to}")


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as listings name it, with its file system, through the JVM of a classic session."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()
