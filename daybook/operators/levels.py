"""Log-level workload: parsing, level counts and shares, components,
occurrences, grep-style filters (P1-P3, F1, F8, F9, A1-A5, A13, A16, S16).

All counts come from one aggregate keyed by level *including* the "" bucket,
so totals, lines with a level, distinct levels and shares need one scan
instead of the reference's six.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.functions import parse
from daybook.functions.fmt import percent
from daybook.functions.fmt import report_line as _line
from daybook.sources.text import read_logs, split_table

FIRST_FILES = 16  # searched before any others for the first lines


def with_level(lines: DataFrame, value: str = "value", strict: bool = False) -> DataFrame:
    """the reference's parsed frame -- ``timestamp, level, message`` of
    lines that carry a level."""
    return (lines.select(parse.timestamp_prefix(value).alias("timestamp"),
                         parse.level(value, strict).alias("level"),
                         F.col(value).alias("message"), *[c for c in lines.columns if c != value])
            .where(F.col("level") != ""))


def _by_level(lines: DataFrame, value: str, strict: bool) -> DataFrame:
    return (lines.groupBy(parse.level(value, strict).alias("level"))
            .agg(F.count(F.lit(1)).alias("count")))


def level_counts(lines: DataFrame, value: str = "value", strict: bool = False) -> DataFrame:
    """A1: ``level, count`` over lines with a level."""
    return _by_level(lines, value, strict).where(F.col("level") != "")


def level_summary(lines: DataFrame, value: str = "value", strict: bool = False) -> DataFrame:
    """A2-A5 in one pass: per level its count and share of lines *with* a
    level, plus ``total_lines``, ``lines_with_level`` and ``unique_levels``.

    The window below has no partition key on purpose: it runs over the
    aggregated table, which holds at most five rows (four levels and "").
    """
    per = _by_level(lines, value, strict)
    everything = Window.partitionBy()
    has = F.col("level") != ""
    out = per.withColumns({
        "total_lines": F.sum("count").over(everything),
        "lines_with_level": F.sum(F.when(has, F.col("count")).otherwise(F.lit(0))).over(everything),
        "unique_levels": F.count_if(has).over(everything),
    })
    return (out.where(has)
            .withColumn("pct", percent("count", "lines_with_level"))
            .select("level", "count", "pct", "total_lines", "lines_with_level", "unique_levels"))


def level_report(summary: DataFrame) -> DataFrame:
    """The level summary as report lines ``(line_no, text)``.

    Header lines come from the totals, then one aligned line per level,
    largest count first. One aggregate over the summary (at most four rows,
    one per level word) builds every line, so the input is read once.
    """
    # The report's texts.
    rows = F.sort_array(F.collect_list(F.struct(
        (-F.col("count")).alias("k"), F.col("level").alias("l"),
        F.format_string("  %-5s : %10d (%6.2f%%)", "level", "count", "pct").alias("t"))))
    agg = summary.agg(F.max("total_lines").alias("total_lines"),
                      F.max("lines_with_level").alias("lines_with_level"),
                      F.max("unique_levels").alias("unique_levels"), rows.alias("rows"))
    header = F.array(
        _line(1, F.format_string("Total log lines processed: %d", "total_lines")),
        _line(2, F.format_string("Total lines with log levels: %d", "lines_with_level")),
        _line(3, F.format_string("Unique log levels found: %d", "unique_levels")),
        _line(4, F.lit("")),
        _line(5, F.lit("Log level distribution:")))
    body = F.transform("rows", lambda r, i: _line(0, r["t"]).withField("line_no", i + F.lit(6)))
    return agg.select(F.inline(F.concat(header, body)))


def component_counts(lines: DataFrame, value: str = "value", top: int | None = None) -> DataFrame:
    """A13 + T3: lines per component, most frequent first (ties by name)."""
    out = (lines.groupBy(parse.component(value).alias("component"))
           .agg(F.count(F.lit(1)).alias("count"))
           .orderBy(F.col("count").desc(), F.col("component")))
    return out.limit(top) if top else out


def severity_occurrences(lines: DataFrame, value: str = "value") -> DataFrame:
    """Every level word occurrence (several per line possible), by level."""
    words = lines.select(F.explode(parse.all_levels(value)).alias("level"))
    return words.groupBy("level").agg(F.count(F.lit(1)).alias("occurrences"))


def lines_containing(lines: DataFrame, literal: str, value: str = "value") -> DataFrame:
    """F8: lines containing a literal (case-sensitive), with their file."""
    return lines.where(F.col(value).contains(literal))


def first_lines_containing(lines: DataFrame, literal: str, n: int = 20, value: str = "value",
                           file_col: str = "file_path", block_col: str = "file_block_start",
                           pos_col: str = "row_pos") -> DataFrame:
    """the first ``n`` lines containing a literal, in file then line order
    (``grep -r ... | head -n``), with their line numbers.

    ``lines`` come straight from a reader with ``positions=True``. File, split
    and scan order already give that order, so the lines are cut to ``n``
    first, each task sending ``n`` at most, and only those are numbered.
    """
    hits = lines.where(F.col(value).contains(literal)).orderBy(file_col, block_col, pos_col).limit(n)
    splits = split_table(lines, file_col, block_col, pos_col)
    first = splits.join(F.broadcast(hits), [file_col, block_col])  # n rows
    numbered = first.withColumn("line_no", F.col("lines_before") + F.col(pos_col) - F.col("first_pos") + F.lit(1))
    return numbered.drop("first_pos", "lines_before").orderBy(file_col, "line_no").limit(n)


def first_lines_in(spark: SparkSession, pattern: str, literal: str, n: int = 20, files: int = FIRST_FILES) -> DataFrame:
    """F9 with an early stop: ``first_lines_containing`` over the files of a folder or glob.

    Files are searched in order, in steps that begin with ``files`` and double, until
    ``n`` hits are found; of a step at most ``n`` names of files with hits
    come back. Only those files are read again, to number their lines.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(pattern).select("path", F.col("_metadata.file_path").alias("uri"))
    named = listed.orderBy("uri").collect()  # Spark holds the listing on the driver for a scan anyway
    hit, held, at = [], 0, 0
    while at < len(named) and held < n:
        step = named[at:at + files]
        lines = read_logs(spark, [r["path"] for r in step]).where(F.col("value").contains(literal))
        found = {r["file_path"]: r["n"] for r in
                 lines.groupBy("file_path").agg(F.count(F.lit(1)).alias("n")).orderBy("file_path").limit(n).collect()}
        hit += [r["path"] for r in step if r["uri"] in found]
        held += sum(found.values())
        at, files = at + files, files * 2
    if not hit:
        return spark.createDataFrame([], "file_path string, file_block_start bigint, value string, row_pos bigint, line_no bigint")
    return first_lines_containing(read_logs(spark, hit, positions=True), literal, n)
