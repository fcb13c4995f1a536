"""Parquet files whose schemas drift from month to month, read as one table.

Spark's scan has one schema: a column that is an integer in one file and a
floating-point number in another fails it, with merged schemas too. Here the
files are grouped by their own schema, each group is scanned with it, and the
scans are united by name, every column cast to the narrowest type that holds
all of its forms. Filters and column selections pass through the union and
the casts of unchanged columns into each scan, and partition columns prune.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.sources.parquet import month_paths

INTEGRAL = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
FRACTION = [T.FloatType(), T.DoubleType()]
FOOTERS = 16  # footers read at once


def widened(name: str, kinds: Iterable[T.DataType]) -> T.DataType:
    """The narrowest type that holds all of ``kinds`` without changing values.

    Integers widen to the widest, integers with floating-point numbers and
    floats with doubles to double, decimals with decimals or integers to one with digits for
    both, a date with a timestamp without zone to the latter, and a column
    without values takes the others' type. Anything else is an error, which
    names the column.
    """
    kinds = [k for k in dict.fromkeys(kinds) if not isinstance(k, T.NullType)]
    if len(kinds) < 2:
        return kinds[0] if kinds else T.NullType()
    if all(k in INTEGRAL for k in kinds):
        return max(kinds, key=INTEGRAL.index)
    if all(k in INTEGRAL + FRACTION for k in kinds):
        return T.DoubleType()
    if all(isinstance(k, T.DecimalType) or k in INTEGRAL for k in kinds):
        digits = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}
        scale = max(k.scale if isinstance(k, T.DecimalType) else 0 for k in kinds)
        whole = max(k.precision - k.scale if isinstance(k, T.DecimalType) else digits[k] for k in kinds)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    if all(k in (T.DateType(), T.TimestampNTZType()) for k in kinds):
        return T.TimestampNTZType()
    raise ValueError(f"column {name!r} can't be read as one type from {', '.join(sorted(k.simpleString() for k in kinds))}")


def schemas(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """Paths by their files' schema (as JSON), both in the order given: one footer is read per path."""
    def own(path: str) -> str:
        return spark.read.parquet(path).schema.json()

    with ThreadPoolExecutor(FOOTERS) as pool:
        found = list(pool.map(own, paths))
    out: dict[str, list[str]] = {}
    for path, schema in zip(paths, found):
        out.setdefault(schema, []).append(path)
    return out


def read_drifting(spark: SparkSession, *paths: str, base_path: str | None = None) -> DataFrame:
    """The files as one table that has every column of any of them.

    Columns are matched by name without regard to case and spelled as where
    they first occur; a file that lacks one has nulls there. Each path is a
    file or folder of one schema. ``base_path`` keeps partition columns.
    """
    if not paths:
        raise ValueError("read_drifting needs at least one path")
    groups = [(T.StructType.fromJson(json.loads(s)), p) for s, p in schemas(spark, list(paths)).items()]
    kinds: dict[str, list[T.DataType]] = {}
    spelled: dict[str, str] = {}
    for schema, _ in groups:
        for f in schema.fields:
            kinds.setdefault(f.name.lower(), []).append(f.dataType)
            spelled.setdefault(f.name.lower(), f.name)
    target = {low: widened(spelled[low], some) for low, some in kinds.items()}
    out = None
    for schema, some in groups:
        reader = spark.read.schema(schema)
        if base_path:
            reader = reader.option("basePath", base_path)
        part = reader.parquet(*some)
        own = {f.name.lower(): f for f in schema.fields}
        partition = [c for c in part.columns if c.lower() not in target]

        def column(low: str):
            if low not in own:
                return F.lit(None).cast(target[low]).alias(spelled[low])
            c = F.col(f"`{own[low].name}`")
            return (c if own[low].dataType == target[low] else c.cast(target[low])).alias(spelled[low])

        part = part.select(*[column(low) for low in target], *partition)
        out = part if out is None else out.unionByName(part)
    return out


def read_drifting_months(spark: SparkSession, root: str, year: int, months: Iterable[int],
                         prefix: str = "yellow_tripdata", partition: str = "yyyy") -> DataFrame:
    """``read_months`` where the months' schemas differ."""
    return read_drifting(spark, *month_paths(root, year, months, prefix, partition), base_path=root)
