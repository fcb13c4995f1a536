"""Cluster-usage workload: application timeline, cluster summary, stats,
ranking, the largest cluster's durations, file and container inventories
(P4-P9, P12, P14, F2, F3, F6, F7, J1, A6-A8, A14, A15, D9, T3, T4).

Lines are reduced to one row per application (or per file) by a partial
aggregate before any shuffle; ids derived from the application id (cluster,
number) are computed after the aggregate, once per application instead of
once per line. A cluster that owns most applications is not a hot key here:
the shuffle key is the application, and each task ships at most one row
per application it saw.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions import parse
from daybook.functions.fmt import report_line as _line
from daybook.functions.fmt import safe_ratio
from daybook.functions.time import seconds_between
from daybook.session import cut


def app_timeline(lines: DataFrame, value: str = "value", file_col: str = "file_path") -> DataFrame:
    """First and last timestamp per application.

    Lines are reduced per *file* first (the path is only hashed, not
    parsed); the application id is then extracted once per file, and the
    per-file bounds are folded into per-application bounds.
    """
    # Lines without a time add nothing to min and max; filtering them out first
    # would parse every line twice.
    per_file = (lines.select(F.col(file_col).alias("_f"), parse.log_time(value).alias("timestamp"))
                .groupBy("_f")
                .agg(F.min("timestamp").alias("_start"), F.max("timestamp").alias("_end"))
                .where(F.col("_start").isNotNull()))
    per_app = (per_file.select(parse.application_id("_f").alias("application_id"), "_start", "_end")
               .where(F.col("application_id") != "")
               .groupBy("application_id")
               .agg(F.min("_start").alias("start_time"), F.max("_end").alias("end_time")))
    return per_app.select(parse.cluster_id("application_id").alias("cluster_id"),
                          "application_id",
                          parse.app_number("application_id").alias("app_number"),
                          "start_time", "end_time")


def cluster_summary(timeline: DataFrame) -> DataFrame:
    """Applications, first start and last end per cluster."""
    return (timeline.groupBy("cluster_id")
            .agg(F.count(F.lit(1)).alias("num_applications"),
                 F.min("start_time").alias("cluster_first_app"),
                 F.max("end_time").alias("cluster_last_app")))


def cluster_stats(summary: DataFrame) -> DataFrame:
    """A8 + P14: clusters, applications and mean applications per cluster."""
    return summary.agg(
        F.count(F.lit(1)).alias("total_clusters"),
        F.coalesce(F.sum("num_applications"), F.lit(0)).cast("bigint").alias("total_applications"),
    ).withColumn("avg_apps_per_cluster",
                 safe_ratio("total_applications", "total_clusters"))


def cluster_ranking(summary: DataFrame) -> DataFrame:
    """T3 + H1: clusters by application count, largest first, ties by id."""
    return summary.orderBy(F.col("num_applications").desc(), F.col("cluster_id"))


def largest_cluster(summary: DataFrame) -> DataFrame:
    """T4: the one cluster with the most applications (ties: smallest id)."""
    return cluster_ranking(summary).limit(1).select("cluster_id")


def largest_cluster_durations(timeline: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """J1 + F6 + P12 + F7: applications of the largest cluster with their
    positive durations in seconds.

    The lookup side is ``largest_cluster`` -- one row by construction -- so
    it is broadcast and the timeline is filtered by a map-side semi join.
    """
    summary = cluster_summary(timeline) if summary is None else summary
    top = F.broadcast(largest_cluster(summary))
    return (timeline.join(top, "cluster_id", "left_semi")
            .withColumn("duration_sec", seconds_between("start_time", "end_time"))
            .where(F.col("duration_sec") > 0))


def number_in_order(df: DataFrame, *order: Column, out: str = "position") -> DataFrame:
    """``df`` with its 1-based position in a total order, without one task
    holding all rows: the rows are range-sorted into checkpoint files, whose
    order is then fixed; only one row per file is summed up in one place."""
    ids = cut(df.orderBy(*order)).withColumn("_id", F.monotonically_increasing_id())
    ids = ids.withColumns({"_part": F.shiftright("_id", 33), "_nth": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = ids.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per sort partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return ids.join(F.broadcast(offsets), "_part") \
        .withColumn(out, F.col("_before") + F.col("_nth") + F.lit(1)).drop("_id", "_part", "_nth", "_before")


def cluster_stats_report(summary: DataFrame) -> DataFrame:
    """The cluster statistics as report lines ``(line_no, text)``."""
    stats = cluster_stats(summary)
    # The report's texts.
    header = stats.select(F.inline(F.array(
        _line(1, F.format_string("Total unique clusters: %d", "total_clusters")),
        _line(2, F.format_string("Total applications: %d", "total_applications")),
        _line(3, F.format_string("Average applications per cluster: %.2f",
                                           "avg_apps_per_cluster")),
        _line(4, F.lit("")),
        _line(5, F.lit("Most heavily used clusters:")),
    )))
    ranked = number_in_order(summary, F.col("num_applications").desc(), F.col("cluster_id"))
    body = ranked.select(
        (F.col("position") + F.lit(5)).cast("int").alias("line_no"),
        F.format_string("  Cluster %s: %d applications", "cluster_id", "num_applications")
        .alias("text"))
    return header.unionByName(body)


def files(lines: DataFrame, value: str = "value", file_col: str = "file_path") -> DataFrame:
    """One row per file: ids from its path, line count and time span."""
    ts = parse.log_time(value)
    per_file = (lines.groupBy(F.col(file_col).alias("file_path"))
                .agg(F.count(F.lit(1)).alias("lines"),
                     F.min(ts).alias("first_time"), F.max(ts).alias("last_time")))
    cid = parse.container_id("file_path")
    return per_file.select(
        "file_path",
        parse.application_id("file_path").alias("application_id"),
        cid.alias("container_id"),
        parse.container_attempt(cid).alias("attempt"),
        parse.container_number(cid).alias("container_number"),
        parse.container_role(cid).alias("role"),
        "lines", "first_time", "last_time",
        seconds_between("first_time", "last_time").alias("span_sec"))


def file_inventory(lines: DataFrame, value: str = "value", file_col: str = "file_path") -> DataFrame:
    """Distinct applications and files (files with at least one line)."""
    per_file = lines.groupBy(F.col(file_col).alias("file_path")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(
        F.count_distinct(F.when(parse.application_id("file_path") != "",
                                parse.application_id("file_path"))).alias("applications"),
        F.count(F.lit(1)).alias("files"),
        F.sum("n").cast("bigint").alias("lines"))


def files_per_app(lines: DataFrame, value: str = "value", file_col: str = "file_path") -> DataFrame:
    """Files and lines per application."""
    per_file = lines.groupBy(F.col(file_col).alias("file_path")).agg(F.count(F.lit(1)).alias("n"))
    return (per_file.groupBy(parse.application_id("file_path").alias("application_id"))
            .agg(F.count(F.lit(1)).alias("files"), F.sum("n").cast("bigint").alias("lines")))


def largest_apps_by_files(files_by_app: DataFrame, n: int = 20) -> DataFrame:
    """T5: the ``n`` applications with the most files, ties by id."""
    return files_by_app.orderBy(F.col("files").desc(), F.col("application_id")).limit(n)


def containers_by_role(file_table: DataFrame) -> DataFrame:
    """Per application, containers by role and their lines."""
    am = F.col("role") == "application_master"
    ex = F.col("role") == "executor"
    return (file_table.groupBy("application_id")
            .agg(F.count_if(am).alias("am_containers"),
                 F.count_if(ex).alias("executor_containers"),
                 F.sum(F.when(am, F.col("lines")).otherwise(F.lit(0))).cast("bigint").alias("am_lines"),
                 F.sum(F.when(ex, F.col("lines")).otherwise(F.lit(0))).cast("bigint")
                 .alias("executor_lines")))
