"""Golden checks against recorded result files of the original jobs.

Each file is named by a variable of its own, DAYBOOK_GOLDEN_<KIND>, and read
as data only. Without them the tests are skipped: they are no part of the
driver's run.
"""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook import sinks
from daybook.functions import parse
from daybook.operators import distribution, levels, usage, yarn

KINDS = ["timeline", "cluster_summary", "level_counts", "sample", "cluster_stats", "level_summary"]
FILES = {k: os.environ[v] for k in KINDS if (v := f"DAYBOOK_GOLDEN_{k.upper()}") in os.environ}
pytestmark = pytest.mark.skipif(len(FILES) < len(KINDS), reason="set DAYBOOK_GOLDEN_<KIND> for " + ", ".join(KINDS))


def _lines(kind):
    with open(FILES[kind]) as f:
        return f.read().split("\n")[:-1]


@pytest.fixture(scope="module")
def timeline(spark):
    return sinks.read_csv(spark, FILES["timeline"], sinks.TIMELINE_SCHEMA)


def test_cluster_summary_from_recorded_timeline(spark, timeline):
    mine = usage.cluster_summary(timeline)
    recorded = sinks.read_csv(spark, FILES["cluster_summary"], sinks.CLUSTER_SUMMARY_SCHEMA)
    assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, recorded.collect()))
    assert timeline.where(F.length("app_number") != 4).count() == 0  # zeros kept


def test_cluster_stats_report_text(spark, timeline):
    rep = usage.cluster_stats_report(usage.cluster_summary(timeline))
    assert [r.text for r in rep.orderBy("line_no").collect()] == _lines("cluster_stats")


def test_level_report_text_from_recorded_counts(spark):
    counts = _lines("level_counts")[1:]
    total = int(_lines("level_summary")[0].split(": ")[1])
    rows = [(lv, int(n)) for lv, n in (c.split(",") for c in counts)]
    with_level = sum(n for _, n in rows)
    summary = spark.createDataFrame(
        [(lv, n, n * 100.0 / with_level, total, with_level, len(rows)) for lv, n in rows],
        "level string, count bigint, pct double, total_lines bigint, lines_with_level bigint, "
        "unique_levels bigint")
    rep = levels.level_report(summary)
    assert [r.text for r in rep.orderBy("line_no").collect()] == _lines("level_summary")


def test_recorded_sample_lines_parse_to_recorded_fields(spark):
    sample = sinks.read_csv(spark, FILES["sample"], sinks.SAMPLE_SCHEMA)
    got = sample.select("timestamp", "level",
                        parse.timestamp_prefix("message").alias("ts2"),
                        parse.level("message").alias("lv2")).collect()
    assert len(got) == 10
    assert all(r.timestamp == r.ts2 and r.level == r.lv2 for r in got)


def test_recorded_sample_lines_feed_the_log_analyses(spark):
    sample = sinks.read_csv(spark, FILES["sample"], sinks.SAMPLE_SCHEMA)
    lines = sample.select(F.col("message").alias("value"),
                          F.lit("s3a://b/application_1485248649253_0052/"
                                "container_1485248649253_0052_01_000002.log").alias("file_path"))
    py = yarn.python_times(lines).first()
    assert (py.runs, py.min_boot_ms, py.negative_boot_runs) == (3, -43, 2)
    mem = yarn.memory_usage(lines).first()
    assert mem.blocks == 2 and mem.blocks_as_bytes == 1
    assert mem.max_block_kb == 4.0 * 1024 and mem.min_free_mb == 2010.3 / 1024
    att = {r.tid: r for r in yarn.task_attempts(lines).collect()}
    assert att[21830].finish_time is None and att[188517].start_time is None
    assert att[188517].result_bytes == 2087 and att[21830].stage == 113


def test_histogram_of_recorded_durations_matches_numpy(spark, timeline):
    d = usage.largest_cluster_durations(timeline)
    secs = [r.duration_sec for r in d.collect()]
    assert len(secs) == 181
    counts, edges = np.histogram(np.log10(secs), bins=30)
    h = distribution.log_histogram(d).orderBy("bin").collect()
    assert [r["count"] for r in h] == counts.tolist()
    assert np.allclose([r.log_lo for r in h], edges[:-1])
