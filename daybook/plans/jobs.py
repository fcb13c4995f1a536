"""The reference's three jobs as end-to-end plans over operators and sinks.

Each job reads its inputs once per output family, writes CSV/text results
under ``out_dir`` and returns the paths. Small intermediate results that
several outputs share are cut from their lineage with ``checkpoint()`` into
the session's shared checkpoint folder, so a lost executor does not force
a re-scan of the logs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from daybook import sinks
from daybook.functions import parse
from daybook.operators import distribution, levels, sampling, trips, usage
from daybook.session import cut
from daybook.sources import read_logs, read_parquet


def log_levels_job(spark: SparkSession, paths: str | Iterable[str], out_dir: str,
                   sample_size: int = 10, seed: int | None = None) -> dict[str, str]:
    """Level counts CSV, a sample CSV and the text summary of log files.

    With a ``seed`` the sample is reproducible (hash of file and line
    number); without one it is the reference's ``orderBy(rand())``.
    """
    out = {k: f"{out_dir.rstrip('/')}/{k}" for k in ("counts", "sample", "summary")}
    lines = read_logs(spark, paths, positions=seed is not None)
    summary = cut(levels.level_summary(lines))
    sinks.write_csv(summary.select("level", "count"), out["counts"], single_file=True)
    if seed is None:
        picked = sampling.random_sample(levels.with_level(lines), sample_size)
    else:
        picked = levels.with_level(sampling.sample_lines(lines, sample_size, seed, parse.level() != F.lit("")))
    sinks.write_csv(picked.select("timestamp", "level", "message"), out["sample"], single_file=True)
    sinks.write_report(levels.level_report(summary), out["summary"])
    return out


def cluster_usage_job(spark: SparkSession, paths: str | Iterable[str],
                      out_dir: str) -> dict[str, str]:
    """Timeline and cluster summary CSVs, the stats report, and the data
    behind the bar chart, histogram and density of the largest cluster."""
    names = ("timeline", "cluster_summary", "stats", "bar", "durations", "histogram", "density")
    out = {k: f"{out_dir.rstrip('/')}/{k}" for k in names}
    timeline = cut(usage.app_timeline(read_logs(spark, paths)))
    summary = cut(usage.cluster_summary(timeline))
    sinks.write_csv(timeline, out["timeline"])
    sinks.write_csv(summary, out["cluster_summary"], single_file=True)
    sinks.write_report(usage.cluster_stats_report(summary), out["stats"])
    sinks.write_csv(usage.cluster_ranking(summary), out["bar"], single_file=True)
    durations = cut(usage.largest_cluster_durations(timeline, summary))
    sinks.write_csv(durations, out["durations"])
    sinks.write_csv(distribution.log_histogram(durations), out["histogram"], single_file=True)
    sinks.write_csv(distribution.log_density(durations), out["density"], single_file=True)
    return out


def daily_summary_job(spark: SparkSession, paths: str | Iterable[str], out_dir: str,
                      year: int, base_path: str | None = None, **columns) -> str:
    """Daily trip summaries of one year from parquet files, newest day first."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = read_parquet(spark, *paths, base_path=base_path)
    path = f"{out_dir.rstrip('/')}/daily_summary"
    sinks.write_csv(trips.daily_summary(df, year, **columns), path, single_file=True)
    return path
