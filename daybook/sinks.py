"""Sinks: CSV results and text reports (S12-S17) and re-reading saved
results with explicit schemas (S18).

Writers are Spark writers (one part file per task, committed atomically);
``single_file`` coalesces to one task and is meant for results that are
small by construction (level counts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.sources.text import number_lines, split_table, with_lineage

# --- Fixed values: schemas of the saved results. ---
LEVEL_COUNTS_SCHEMA = "level string, count bigint"
SAMPLE_SCHEMA = "timestamp string, level string, message string"
TIMELINE_SCHEMA = ("cluster_id string, application_id string, app_number string, "
                   "start_time timestamp_ntz, end_time timestamp_ntz")
CLUSTER_SUMMARY_SCHEMA = ("cluster_id string, num_applications bigint, "
                          "cluster_first_app timestamp_ntz, cluster_last_app timestamp_ntz")
DAILY_SUMMARY_SCHEMA = ("dt_year int, dt_month int, dt_day int, num_trips bigint, "
                        "mean_trip_distance double, max_mta_tax double, q95_fare_amount double, "
                        "min_tip_amount double, mean_passenger_count bigint")
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# --- end of fixed values ---

_CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"',
                "timestampFormat": TIME_FORMAT, "timestampNTZFormat": TIME_FORMAT}


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """CSV with a header; fields with commas or quotes are quoted and
    inner quotes doubled (as Python's csv module does); times as
    ``yyyy-MM-dd HH:mm:ss``."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).options(**_CSV_OPTIONS).csv(path)


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Report lines ``(line_no, text)`` as text files in line order.

    The lines are range-sorted, so file by file (their names are numbered)
    the report goes on where the one before ends; a short report is one file,
    a long one is written by many tasks.
    """
    report.orderBy("line_no").select("text").write.mode(mode).text(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Re-read a saved result without recomputing; the explicit schema
    keeps ids such as ``0132`` as strings (inference would make them ints)."""
    return spark.read.options(**_CSV_OPTIONS).schema(schema).csv(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """Re-read a report as ``(line_no, text)``: its files in the order of
    their names, each line numbered from its split's place, not by sorting the text."""
    lines = with_lineage(spark.read.text(path), positions=True)
    splits = split_table(lines)
    sizes = lines.groupBy("file_path").agg(F.count(F.lit(1)).alias("_n"))
    # One row per file of the report, numbers only.
    before = Window.orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1)
    files = sizes.select("file_path", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = number_lines(lines, splits=splits.join(files, "file_path").withColumn("lines_before", F.col("lines_before") + F.col("_before")).drop("_before"))
    return numbered.select("line_no", F.col("value").alias("text"))
