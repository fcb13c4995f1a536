"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.session import scratch_dir, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver did.

    Workers start in a folder of their own; without an installed package, or
    a cluster's ``--py-files``, they would not find it.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *paths]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the input folder, by any path that Spark reads."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` read back from reliable checkpoint files in the shared folder."""
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared one; it isn't made yet."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet into a new folder of the shared one and read back, and that folder."""
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``written`` made, on whatever file system it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def bounded(df: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """``df`` computed once, hinted for broadcast if it holds at most ``rows`` rows.

    Beyond the bound the hint is left off and the join shuffles: the same
    rows come out, by another plan.
    """
    df = cut(df)
    n = df.count()
    return (F.broadcast(df) if n <= rows else df), n


def free(df: DataFrame, *names: str) -> list[str]:
    """The names for columns of our own, each with as many underscores before it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    lead = "__"
    while any(lead + n in taken for n in names):
        lead += "_"
    return [lead + n for n in names]


def id_bucket(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id written as text, modulo ``buckets``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(buckets)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased; every other character, Kelvin sign included, stays."""
    return F.translate(text, UPPER, UPPER.lower())


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where a public tokenizer's file is; workers need the same folder."""
    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return os.path.join("/opt/tokenizers", name)


def byte_batches(texts: Sequence[str | None], limit: int = 4 << 20):
    """Slices (start, end) of ``texts`` of about ``limit`` characters each; one long text stands alone."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


_TYPES = {"long": T.LongType, "int": T.IntegerType, "double": T.DoubleType, "string": T.StringType,
          "binary": T.BinaryType, "boolean": T.BooleanType}


def fields(**columns: str) -> T.StructType:
    """A schema from simple type names; ``x[]`` is an array. Needs no session, unlike a DDL string."""
    def kind(x: str) -> T.DataType:
        return T.ArrayType(kind(x[:-2])) if x.endswith("[]") else _TYPES[x]()

    return T.StructType([T.StructField(n, kind(x)) for n, x in columns.items()])
