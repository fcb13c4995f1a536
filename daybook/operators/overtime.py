"""What runs when: use over time from intervals.

Tasks, containers and applications are intervals of whole seconds that hold
their start and not their end. An interval without an end is still open; one
that ends before it starts counts as empty. All running values go over ordered
partitions (``ordered.carried``), so a cluster or application that owns most
intervals is no large task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions import parse
from daybook.functions.time import seconds_between, wall_seconds, wall_time
from daybook.operators.ordered import Carry, carried
from daybook.operators.yarn import store_lines

BUCKETS = 64  # of a key's span, in which overlapping intervals meet


def concurrency(intervals: DataFrame, keys: Sequence[str], start: str = "start_time", end: str = "finish_time") -> DataFrame:
    """Per key: intervals, open_intervals, peak (most at once), peak_time (when
    first reached) and busy_sec (seconds with at least one).

    A sweep line: +1 at every start and -1 at every end, added up by second
    before the shuffle, then running sums. What is open runs to the key's
    last start or end. Rows without a start are left out; a key whose
    intervals are all empty has peak 0 at its first start.
    """
    s, e = wall_seconds(F.col(start)), F.greatest(wall_seconds(F.col(end)), wall_seconds(F.col(start)))
    rows = intervals.where(F.col(start).isNotNull())

    def point(t: Column, step: int, opens: Column) -> Column:
        return F.struct(t.alias("t"), F.lit(step).cast("bigint").alias("step"), opens.cast("bigint").alias("opens"))

    is_open = F.col(end).isNull().cast("bigint")
    points = rows.select(*keys, F.explode(F.array(point(s, 1, is_open), point(F.when(F.col(end).isNotNull(), e), -1, F.lit(0)))).alias("p")) \
        .where(F.col("p.t").isNotNull())
    deltas = points.groupBy(*keys, F.col("p.t").alias("_t")).agg(
        F.sum("p.step").alias("_step"), F.count_if(F.col("p.step") > 0).alias("_starts"), F.sum("p.opens").alias("_open"))
    now = carried(deltas, keys, ["_t"], Carry("sum", F.col("_step"), "_now"))
    # Busy time is the sum of end less start over busy spells: a point ends one, begins one, or neither.
    was, is_ = F.col("_now") - F.col("_step") > 0, F.col("_now") > 0
    edge = F.when(was & ~is_, F.col("_t")).when(~was & is_, -F.col("_t")).otherwise(F.lit(0))
    out = now.groupBy(*keys).agg(
        F.sum("_starts").alias("intervals"), F.sum("_open").alias("open_intervals"), F.max("_now").alias("peak"),
        F.min(F.struct((-F.col("_now")).alias("n"), "_t")).alias("_top"), F.sum(edge).alias("_edges"), F.sum("_step").alias("_left"), F.max("_t").alias("_end"))
    return out.select(*keys, "intervals", "open_intervals", "peak", wall_time(F.col("_top._t")).alias("peak_time"),
                      (F.col("_edges") + F.when(F.col("_left") > 0, F.col("_end")).otherwise(F.lit(0))).alias("busy_sec"))


def busy_spells(intervals: DataFrame, keys: Sequence[str], start: str = "start_time", end: str = "end_time") -> DataFrame:
    """Per key the union of its intervals: busy_sec, gaps between them, gap_sec, longest_gap_sec.

    Intervals are first reduced to the latest end of each start; a gap is
    where a start lies behind the greatest end before it, which is carried
    over ordered partitions. An open or empty interval covers no time but parts a gap.
    """
    rows = intervals.where(F.col(start).isNotNull()).select(
        *keys, wall_seconds(F.col(start)).alias("_s"), F.greatest(wall_seconds(F.col(end)), wall_seconds(F.col(start))).alias("_e"))
    spans = rows.groupBy(*keys, "_s").agg(F.max("_e").alias("_e"))
    seen = carried(spans, keys, ["_s"], Carry("max", F.col("_e"), "_before", inclusive=False))
    gap = F.when(F.col("_s") > F.col("_before"), F.col("_s") - F.col("_before"))
    out = seen.groupBy(*keys).agg(F.min("_s").alias("_first"), F.max("_e").alias("_last"), F.count(gap).alias("gaps"),
                                  F.coalesce(F.sum(gap), F.lit(0)).alias("gap_sec"), F.coalesce(F.max(gap), F.lit(0)).alias("longest_gap_sec"))
    return out.select(*keys, (F.col("_last") - F.col("_first") - F.col("gap_sec")).alias("busy_sec"), "gaps", "gap_sec", "longest_gap_sec")


def cluster_use(timeline: DataFrame) -> DataFrame:
    """Per cluster applications, peak at once and its time, busy seconds, gaps and the longest."""
    at_once = concurrency(timeline, ["cluster_id"], "start_time", "end_time").select(
        "cluster_id", F.col("intervals").alias("applications"), F.col("peak").alias("peak_applications"), "peak_time")
    return at_once.join(busy_spells(timeline, ["cluster_id"]), "cluster_id")


def overlaps(intervals: DataFrame, keys: Sequence[str], name: str, start: str, end: str) -> DataFrame:
    """Per key the pairs of intervals that share time: ``<name>_a`` < ``<name>_b`` and overlap_sec.

    ``name`` identifies an interval within its key. Intervals meet in time
    buckets, a key's span cut into BUCKETS: of a pair the one that starts
    later (on a tie, the one of greater name) stands only in the bucket of its start, the other in
    every bucket that it touches, so each pair meets exactly once and a key's work is dealt out by bucket.
    """
    rows = intervals.where(F.col(start).isNotNull()).select(*keys, F.col(name).alias("_n"), wall_seconds(F.col(start)).alias("_s"),
                                                           F.greatest(wall_seconds(F.col(end)), wall_seconds(F.col(start))).alias("_e"))
    rows = rows.where(F.col("_e") > F.col("_s"))
    span = rows.groupBy(*keys).agg(F.min("_s").alias("_from"), (F.floor((F.max("_e") - F.min("_s")) / BUCKETS) + F.lit(1)).cast("bigint").alias("_width"))
    names = {k: f"_of{i}" for i, k in enumerate(keys)}
    same = F.lit(True)
    for k, n in names.items():
        same = same & F.col(k).eqNullSafe(F.col(n))
    placed = rows.join(span.withColumnsRenamed(names), same).drop(*names.values())

    def bucket(t: str) -> Column:
        return F.floor((F.col(t) - F.col("_from")) / F.col("_width")).cast("bigint")

    later = placed.withColumn("_at", bucket("_s"))
    earlier = placed.withColumn("_touch", F.explode(F.sequence(bucket("_s"), bucket("_e")))).select(
        *[F.col(k).alias(n) for k, n in names.items()], F.col("_touch"), F.col("_n").alias("_n0"), F.col("_s").alias("_s0"), F.col("_e").alias("_e0"))
    before = (F.col("_s0") < F.col("_s")) | ((F.col("_s0") == F.col("_s")) & (F.col("_n0") < F.col("_n")))
    met = later.join(earlier, same & (F.col("_at") == F.col("_touch")) & before & (F.col("_e0") > F.col("_s")))
    return met.select(*keys, F.least("_n", "_n0").alias(f"{name}_a"), F.greatest("_n", "_n0").alias(f"{name}_b"),
                      (F.least("_e", "_e0") - F.col("_s")).alias("overlap_sec"))


def stage_overlaps(attempts: DataFrame) -> DataFrame:
    """Per application the pairs of stages that ran side by side and for how long.

    A stage lasts from its first attempt's start to the last start or finish among its attempts.
    """
    spans = attempts.groupBy("application_id", "stage").agg(
        F.min("start_time").alias("_from"), F.max(F.greatest("start_time", "finish_time")).alias("_to"))
    return overlaps(spans, ["application_id"], "stage", "_from", "_to")


def retries(attempts: DataFrame) -> DataFrame:
    """Per (application, stage) the chains of attempts at one task, across container files.

    A chain holds the attempts with the same stage attempt and task, by start
    and task id. One that has a successor was superseded: its time is lost,
    to its finish if it finished, else to the successor's start. Columns:
    chains, retried_chains, longest_chain, superseded_attempts, lost_sec,
    finished_chains, unfinished_chains (by the last attempt). Attempts without
    a start stand where they finished, those without either come first.
    """
    chain = ["application_id", "stage", "stage_attempt", "task"]
    began = F.coalesce("start_time", "finish_time")
    # The next attempt is the last one seen when going backwards.
    rows = attempts.select(*chain, (-wall_seconds(began)).alias("_back"), (-F.col("tid")).alias("_back_id"), began.alias("_began"),
                           "finish_time", F.coalesce("duration_sec", F.lit(0.0)).alias("_ran")) \
        .withColumn("_tie", F.coalesce(-wall_seconds(F.col("finish_time")), F.lit(0).cast("bigint")))
    seen = carried(rows, chain, ["_back", "_back_id", "_tie"], Carry("sum", F.lit(1).cast("bigint"), "_after", inclusive=False),
                   Carry("last", F.col("_began"), "_next", inclusive=False))
    superseded = F.col("_after") > 0
    done = F.col("finish_time").isNotNull()
    lost = F.when(superseded, F.when(done, F.col("_ran")).otherwise(F.coalesce(seconds_between("_began", "_next"), F.lit(0.0))))
    per_chain = seen.groupBy(*chain).agg(F.count(F.lit(1)).alias("_n"), F.coalesce(F.sum(lost), F.lit(0.0)).alias("_lost"),
                                         F.bool_or(~superseded & done).alias("_done"))
    return per_chain.groupBy("application_id", "stage").agg(
        F.count(F.lit(1)).alias("chains"), F.count_if(F.col("_n") > 1).alias("retried_chains"), F.max("_n").alias("longest_chain"),
        F.sum(F.col("_n") - 1).alias("superseded_attempts"), F.sum("_lost").alias("lost_sec"),
        F.count_if("_done").alias("finished_chains"), F.count_if(~F.col("_done")).alias("unfinished_chains"))


def memory_over_time(lines: DataFrame, value: str = "value", file_col: str = "file_path",
                     block_col: str = "file_block_start", pos_col: str = "row_pos") -> DataFrame:
    """Per container how full its memory store got: container_id, blocks,
    unmatched_blocks (stored before any store was started), peak_share,
    peak_time, capacity_mb and free_mb then.

    ``lines`` come straight from a reader with ``positions=True``. Each stored
    block is matched with the latest store start above it in its file: both
    kinds of lines are one sequence along which the capacity is carried,
    so nothing is joined by range. The share used is 1 - free / capacity, no
    less than 0; the earliest time of the highest share is kept.
    """
    rows = store_lines(lines, value, file_col, block_col, pos_col)
    seen = carried(rows, ["_f"], [block_col, pos_col], Carry("last", F.col("capacity_mb"), "_capacity"))
    blocks = seen.where(F.col("stored_as").isNotNull())
    share = F.when(F.col("_capacity") > 0, F.greatest(F.lit(0.0), F.lit(1.0) - F.col("free_mb") / F.col("_capacity")))
    top = F.min(F.when(share.isNotNull(), F.struct((-share).alias("s"), F.col("ts").alias("t"), F.col("_capacity").alias("c"), F.col("free_mb").alias("f"))))
    out = blocks.groupBy("_f").agg(F.count(F.lit(1)).alias("blocks"), F.count_if(F.col("_capacity").isNull()).alias("unmatched_blocks"), top.alias("_top"))
    return out.select(parse.application_id("_f").alias("application_id"), parse.container_id("_f").alias("container_id"), "blocks", "unmatched_blocks",
                      (-F.col("_top.s")).alias("peak_share"), F.col("_top.t").alias("peak_time"), F.col("_top.c").alias("capacity_mb"),
                      F.col("_top.f").alias("free_mb"))
