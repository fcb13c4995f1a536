"""Running values over an order, without one task per key.

A window over a key sorts all its rows in one task. Here the rows of all keys
are range-partitioned by key and order, so a key with most of the rows spans
many partitions; each partition runs by itself, and what earlier partitions
of the same key add up to is carried in from a table with one row per
partition and key. Only a partition's first key can have anything carried in,
so the part of that table that rows are joined with has at most one row per
partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.session import cut


@dataclass(frozen=True)
class Carry:
    """What ``carried`` adds as column ``out``: over the key's rows up to this
    one (or only those before it, unless ``inclusive``) the ``sum`` or ``max``
    of ``value``, or its ``last`` value that isn't null."""

    how: str
    value: Column
    out: str
    inclusive: bool = True

    def over(self, column: str, window) -> Column:
        if self.how == "sum":
            return F.sum(column).over(window)
        if self.how == "max":
            return F.max(column).over(window)
        return F.last(column, ignorenulls=True).over(window)

    def whole(self, column: str, order: Sequence[str]) -> Column:
        if self.how == "sum":
            return F.sum(column)
        if self.how == "max":
            return F.max(column)
        return F.max_by(F.col(column), F.when(F.col(column).isNotNull(), F.struct(*order)))

    def joined(self, inside: Column, before: Column) -> Column:
        if self.how == "sum":
            return F.coalesce(inside, F.lit(0)) + F.coalesce(before, F.lit(0))
        return F.greatest(inside, before) if self.how == "max" else F.coalesce(inside, before)


def carried(df: DataFrame, keys: Sequence[str], order: Sequence[str], *carries: Carry) -> DataFrame:
    """``df`` with one column per ``Carry``, by ``keys`` in ascending ``order``.

    Rows should differ in key and order: those that don't stay in one
    partition, in no fixed sequence. A null key is a key, nulls come first in
    the order. The ordered rows are written to the shared folder once.
    """
    rows = df.withColumns({f"_v{i}": c.value for i, c in enumerate(carries)})
    placed = cut(rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order))
    placed = placed.withColumn("_part", F.shiftright(F.monotonically_increasing_id(), 33).cast("int"))
    parts = placed.groupBy("_part", *keys).agg(*[c.whole(f"_v{i}", order).alias(f"_w{i}") for i, c in enumerate(carries)])
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    names = {k: f"_of{j}" for j, k in enumerate(keys)}
    befores = [f"_b{i}" for i in range(len(carries))]
    offsets = parts.select(F.col("_part").alias("_in"), *[F.col(k).alias(n) for k, n in names.items()],
                           *[c.over(f"_w{i}", earlier).alias(b) for i, (c, b) in enumerate(zip(carries, befores))])
    some = F.coalesce(*[F.when(F.col(b).isNotNull(), F.lit(True)) for b in befores])
    same = F.col("_part") == F.col("_in")
    for k, n in names.items():
        same = same & F.col(k).eqNullSafe(F.col(n))
    own = Window.partitionBy("_part", *keys).orderBy(*order)
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = own.rowsBetween(Window.unboundedPreceding, -1)
    run = placed.select("*", *[c.over(f"_v{i}", upto if c.inclusive else until).alias(f"_r{i}") for i, c in enumerate(carries)])
    # One row per partition at most: only its first key goes on from the one before.
    out = run.join(F.broadcast(offsets.where(some)), same, "left")
    return out.select(*[F.col(f"`{c}`") for c in df.columns],
                      *[c.joined(F.col(f"_r{i}"), F.col(b)).alias(c.out) for i, (c, b) in enumerate(zip(carries, befores))])
