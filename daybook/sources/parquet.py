"""Parquet sources: multi-file scans, partitioned layouts, month path lists.

All readers return lazy DataFrames; Catalyst prunes columns and pushes
filters into the scan, and the ``basePath`` option keeps partition columns
(``yyyy=2021``) so filters on them prune whole directories.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, *paths: str, base_path: str | None = None,
                 merge_schema: bool = False) -> DataFrame:
    """Scan one or many parquet files or globs as one table (implicit union).

    ``base_path`` keeps partition columns when leaf files or globs are listed;
    ``merge_schema`` reconciles files whose footers differ (new columns).
    """
    if not paths:
        raise ValueError("read_parquet needs at least one path")
    reader = spark.read
    if base_path:
        reader = reader.option("basePath", base_path)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.parquet(*paths)


def month_paths(root: str, year: int, months: Iterable[int],
                prefix: str = "yellow_tripdata", partition: str = "yyyy") -> list[str]:
    """Month-file layout ``<root>/<partition>=<year>/<prefix>_<year>-<MM>.parquet``."""
    root = root.rstrip("/")
    return [f"{root}/{partition}={year}/{prefix}_{year}-{m:02d}.parquet" for m in months]


def read_months(spark: SparkSession, root: str, year: int, months: Iterable[int],
                prefix: str = "yellow_tripdata", partition: str = "yyyy") -> DataFrame:
    """Read the listed months of one year, keeping the partition column."""
    return read_parquet(spark, *month_paths(root, year, months, prefix, partition),
                        base_path=root)
