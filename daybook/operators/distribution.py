"""Data behind the duration charts: log-scale histogram and density (H2-H4).

Global values (min, max, count, spread) come from one aggregate used as
scalar subqueries: Spark merges them into a single subquery, runs it once and
inlines the result, so no row is joined with them and nothing is collected.
They are attached to rows in a single projection, so later expressions refer
to columns and never repeat the subquery. Counting is a partial aggregate by
bin (at most ``bins`` rows per task); the density pre-aggregates equal values
and evaluates the grid per distinct value, summing map-side, so its shuffle
is ``grid`` rows per task.

The input is read once per subquery and once for the rows: pass a
materialised (checkpointed) frame when it is expensive to recompute.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _log_values(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col) > 0).select(F.log10(F.col(col)).alias("_x"))


def _scalars(xs: DataFrame) -> dict[str, Column]:
    st = xs.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"),
                F.count(F.lit(1)).alias("n"), F.stddev_samp("_x").alias("sd"))
    return {k: st.select(k).scalar() for k in ("lo", "hi", "n", "sd")}


def _edge_columns(s: dict[str, Column], bins: int) -> dict[str, Column]:
    """numpy's convention: equal bounds widen to [lo - 0.5, hi + 0.5]."""
    lo, hi = s["lo"], s["hi"]
    first = F.when(hi > lo, lo).otherwise(lo - F.lit(0.5))
    last = F.when(hi > lo, hi).otherwise(hi + F.lit(0.5))
    return {"_first": first, "_last": last, "_width": (last - first) / F.lit(bins)}


def log_histogram(df: DataFrame, col: str = "duration_sec", bins: int = 30) -> DataFrame:
    """H2 + H4: ``bins`` equal-width bins of log10(col) over positive values,
    last bin closed; every bin is returned, empty ones with count 0.

    Columns: bin, log_lo, log_hi, lo, hi (back on the value scale), count, n.
    """
    s = _scalars(_log_values(df, col))
    xs = _log_values(df, col).withColumns(_edge_columns(s, bins))
    b = F.least(F.lit(bins - 1),
                F.floor((F.col("_x") - F.col("_first")) / (F.col("_last") - F.col("_first"))
                        * F.lit(bins)))
    counts = xs.groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    axis = (df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
            .withColumns({**_edge_columns(s, bins), "n": s["n"]}))
    out = axis.join(F.broadcast(counts), "bin", "left")  # counts: at most `bins` rows
    log_lo = F.col("_first") + F.col("bin") * F.col("_width")
    log_hi = F.col("_first") + (F.col("bin") + F.lit(1)) * F.col("_width")
    return out.select(
        "bin", log_lo.alias("log_lo"), log_hi.alias("log_hi"),
        F.pow(F.lit(10.0), log_lo).alias("lo"), F.pow(F.lit(10.0), log_hi).alias("hi"),
        F.coalesce(F.col("count"), F.lit(0)).alias("count"), "n")


def log_density(df: DataFrame, col: str = "duration_sec", grid: int = 200,
                bins: int = 30) -> DataFrame:
    """H3: Gaussian kernel density of log10(col) on ``grid`` points spanning
    [min, max], Scott bandwidth ``std * n^(-1/5)``, also scaled to histogram
    counts (``density * n * bin_width``) as drawn over the histogram. Fewer
    than two different values have no bandwidth: density and scaled_count are NULL.
    """
    s = _scalars(_log_values(df, col))
    edges = _edge_columns(s, bins)
    consts = {"_lo": s["lo"], "_step": (s["hi"] - s["lo"]) / F.lit(grid - 1),
              "_h": s["sd"] * F.pow(s["n"].cast("double"), F.lit(-0.2)),
              "_n": s["n"], "_bw": edges["_width"]}
    weighted = (_log_values(df, col).groupBy("_x").agg(F.count(F.lit(1)).alias("_w"))
                .withColumns(consts))
    pts = weighted.select("*", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("i"))
    g = F.col("_lo") + F.col("i") * F.col("_step")
    z = F.try_divide(g - F.col("_x"), F.col("_h"))
    sums = pts.groupBy("i", "_lo", "_step", "_h", "_n", "_bw").agg(
        F.sum(F.col("_w") * F.exp(F.lit(-0.5) * z * z)).alias("_s"))
    density = F.try_divide(F.col("_s"), F.col("_n") * F.col("_h") * F.lit(math.sqrt(2 * math.pi)))
    return sums.select(F.col("i").cast("int").alias("grid_index"), g.alias("log_x"),
                       F.pow(F.lit(10.0), g).alias("x"), density.alias("density"),
                       (density * F.col("_n") * F.col("_bw")).alias("scaled_count"))
