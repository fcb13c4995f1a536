"""Percentiles per group.

``approx`` is Spark's ``percentile_approx``: a bounded-memory quantile sketch
merged map-side, so a hot group costs no more memory than a cold one.

``exact`` gives the discrete percentile (``percentile_disc``: the smallest
value whose cumulative share reaches ``q``). Groups are counted first. Small
ones are counted by value and ranked. For a large one a sketch of what is
left names a few values around the wanted rank; counting what lies below and
at each of them either shows that one of them is the answer, however many
rows have it, or leaves the rows strictly between two of them. So every round
sheds values that hold many rows by themselves, what is left shrinks by about
a hundred otherwise (a few values spread over all of it part it even if the
sketch missed the rank), and it always ends. Sketches and counts are merged
map-side: no large group's rows or distinct values meet in one task, and
every decision follows from counted rows, so neither partitioning nor the
optimizer has a say in the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.session import checked_broadcast, cut

STEPS = 500  # quantiles that a sketch is asked for
ACCURACY = 10_000
AROUND = 3  # sketch steps on each side of the wanted rank whose values are counted
INSIDE = 1_000_000  # rows of one group that may be left for ranking
GROUPS = 100_000  # groups whose brackets are broadcast


def approx(value: str, q: float, accuracy: int = ACCURACY) -> Column:
    """Approximate percentile as an aggregate Column (A10)."""
    return F.percentile_approx(F.col(value), q, accuracy)


def _join(rows: DataFrame, table: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Every row with its group's columns; a null key equals itself."""
    side = checked_broadcast(table.withColumnsRenamed({n: f"_of{n}" for n in names}), GROUPS)
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"_of{n}"))
    joined = rows.join(side, same, how)
    return joined if how == "left_anti" else joined.drop(*[f"_of{n}" for n in names])


def _left(rows: DataFrame, state: DataFrame, names: Sequence[str]) -> DataFrame:
    """The rows strictly inside their group's bracket; a null bound is none."""
    above = F.col("_lo").isNull() | (F.col("_v") > F.col("_lo"))
    below = F.col("_hi").isNull() | (F.col("_v") < F.col("_hi"))
    return _join(rows, state, names).where(above & below)


def _narrowed(rows: DataFrame, state: DataFrame, names: Sequence[str]) -> DataFrame:
    """One round for the groups of ``state`` (keys, _target, _lo, _hi, _below, _in):
    the same with a smaller bracket, or with the answer as _found."""
    grid = F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)])
    sketch = _left(rows, state, names).groupBy(*names, "_target", "_lo", "_hi", "_below", "_in") \
        .agg(F.percentile_approx("_v", grid, ACCURACY).alias("_sketch"))
    at = F.floor((F.col("_target") - F.col("_below") - 1) / F.col("_in") * STEPS)
    some = [F.get("_sketch", F.greatest(F.lit(0), F.least(F.lit(STEPS), at + i)).cast("int")) for i in range(-AROUND, AROUND + 2)]
    # Where the sketch is too coarse for its steps, these part what is left all the same.
    some += [F.get("_sketch", F.lit(STEPS * i // 4)) for i in range(5)]
    tried = cut(sketch.withColumn("_some", F.array_sort(F.array_distinct(F.array(*some)))).drop("_sketch"))
    n = len(some)
    counts = [F.count_if(F.col("_v") < F.get("_some", F.lit(i))).alias(f"_lt{i}") for i in range(n)] \
        + [F.count_if(F.col("_v") <= F.get("_some", F.lit(i))).alias(f"_le{i}") for i in range(n)]
    # Numbers alone are aggregated: with the array of values among the buffers Spark would sort all rows first.
    per_group = _left(rows, tried, names).groupBy(*names).agg(*counts)
    counted = _join(tried, per_group, names)
    values = F.array(*[F.struct(F.get("_some", F.lit(i)).alias("v"), (F.col("_below") + F.col(f"_lt{i}")).alias("lt"),
                                (F.col("_below") + F.col(f"_le{i}")).alias("le")) for i in range(n)])
    with_values = counted.withColumn("_c", F.filter(values, lambda c: c["v"].isNotNull()))
    hit = F.get(F.filter("_c", lambda c: (c["lt"] < F.col("_target")) & (F.col("_target") <= c["le"])), F.lit(0))
    below = F.filter("_c", lambda c: c["le"] < F.col("_target"))
    lower = F.get(below, F.size(below) - 1)
    upper = F.get(F.filter("_c", lambda c: c["lt"] >= F.col("_target")), F.lit(0))
    return with_values.select(*names, "_target", hit.alias("_hit"), lower.alias("_lower"), upper.alias("_upper"), "_lo", "_hi", "_below", "_in").select(
        *names, "_target", F.col("_hit.v").alias("_found"), F.coalesce("_lower.v", "_lo").alias("_lo"), F.coalesce("_upper.v", "_hi").alias("_hi"),
        F.coalesce("_lower.le", "_below").alias("_below"),
        (F.coalesce(F.col("_upper.lt"), F.col("_below") + F.col("_in")) - F.coalesce("_lower.le", "_below")).alias("_in"))


def _ranked(counts: DataFrame, names: Sequence[str], target: Column, below: Column, alias: str) -> DataFrame:
    """From rows by group and value (_v, _c) the first value at which the running count reaches the target."""
    running = Window.partitionBy(*names).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = counts.withColumns({"_upto": below + F.sum("_c").over(running), "_goal": target}).where(F.col("_upto") >= F.col("_goal"))
    return reached.groupBy(*names).agg(F.min("_v").alias(alias))


def exact(df: DataFrame, keys: Sequence[str], value: str, q: float,
          alias: str = "percentile", inside: int = INSIDE) -> DataFrame:
    """Exact discrete percentile of ``value`` per ``keys`` (NULLs ignored).

    Returns one row per group that has at least one non-NULL value; a null
    key is a group. Groups of at most ``inside`` rows cost one pass for the
    sizes and one for the ranks. Larger ones are narrowed while the query is
    built: two passes a round, one round as a rule.
    """
    if not 0.0 <= q <= 1.0:
        raise ValueError("q must be within [0, 1]")
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.where(F.col(value).isNotNull()).select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(value).alias("_v"))

    def target(n: Column) -> Column:
        return F.greatest(F.ceil(F.lit(q) * n), F.lit(1))

    def named(out: DataFrame) -> DataFrame:
        return out.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], alias)

    large = cut(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_in")).where(F.col("_in") > inside))
    many = large.limit(1).count() > 0
    small = _join(rows, large.select(*names), names, "left_anti") if many else rows
    by_value = small.groupBy(*names, "_v").agg(F.count(F.lit(1)).alias("_c"))
    out = _ranked(by_value, names, target(F.sum("_c").over(Window.partitionBy(*names))), F.lit(0), alias)
    if not many:
        return named(out)
    kind = rows.schema["_v"].dataType
    state = large.select(*names, target(F.col("_in")).alias("_target"), F.lit(None).cast(kind).alias("_found"), F.lit(None).cast(kind).alias("_lo"),
                         F.lit(None).cast(kind).alias("_hi"), F.lit(0).cast("bigint").alias("_below"), "_in")
    while True:
        open_ = F.col("_found").isNull() & (F.col("_in") > inside)
        todo = state.where(open_)
        if not todo.limit(1).count():
            break
        state = cut(state.where(~open_).unionByName(_narrowed(rows, todo.drop("_found"), names)))
    rest = state.where(F.col("_found").isNull()).drop("_found")
    left = _left(rows, rest, names).groupBy(*names, "_target", "_below", "_v").agg(F.count(F.lit(1)).alias("_c"))
    ranked = _ranked(left, names, F.col("_target"), F.col("_below"), alias)
    found = state.where(F.col("_found").isNotNull()).select(*names, F.col("_found").alias(alias))
    return named(out.unionByName(ranked).unionByName(found))
