"""Plan shape: pushdown, pruning, no Python on the hot path, no cartesian joins."""

import re

import pytest

from conftest import SF_TINY
from daybook.operators import levels, sampling, usage, yarn
from daybook.functions import parse
from daybook.plans import catalog, rendered

PYTHON_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas",
                "FlatMapGroupsInPandas", "AggregateInPandas")


def _plan(df):
    df.write.format("noop").mode("overwrite").save()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: _plan(fn(spark, SF_TINY)) for name, fn in catalog.QUERIES.items()}


def test_no_python_and_no_cartesian(plans):
    for name, plan in plans.items():
        for node in PYTHON_NODES + ("CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in plan, (name, node)


def test_year_range_reaches_parquet_scan(spark):
    df = catalog.QUERIES["daily_summary"](spark, SF_TINY)
    plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01" in pushed
    assert "LessThan(l_shipdate,1999-01-01" in pushed
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert sorted(f.split(":")[0] for f in schema.split(",")) == sorted(
        ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"])


def test_level_summary_reads_logs_once(plans):
    assert len(re.findall(r"FileScan text", plans["log_level_summary"])) == 1
    assert len(re.findall(r"FileScan text", plans["log_level_report"])) == 1
    assert len(re.findall(r"FileScan text", plans["failure_rates"])) == 1


def test_top_cluster_is_broadcast_semi_join(plans):
    assert re.search(r"BroadcastHashJoin \[cluster_id#\d+\], \[cluster_id#\d+\], LeftSemi",
                     plans["largest_cluster_durations"])


def test_logs_read_only_the_text(plans):
    for name in ("log_level_counts", "component_counts", "severity_occurrences"):
        assert "ReadSchema: struct<value:string>" in plans[name], name


def test_hot_keys_are_pre_aggregated_before_the_shuffle(plans):
    """A cluster or application holding a third of all lines must not be a
    hot shuffle key: every aggregate on lines is partial before its Exchange."""
    for name in ("app_timeline", "log_level_counts", "files_per_app", "executor_requests",
                 "task_attempts", "failure_rates"):
        plan = plans[name]
        exchanges = plan.count("Exchange hashpartitioning")
        partial = len(re.findall(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_", plan))
        assert exchanges >= 1 and partial >= 1, name


def test_skewed_application_gives_exact_timeline(spark, tmp_path):
    """One application with most lines, spread over many splits."""
    import os
    from daybook.operators import usage
    from daybook.sources import read_logs
    hot = tmp_path / "application_1_0001"
    cold = tmp_path / "application_1_0002"
    os.makedirs(hot), os.makedirs(cold)
    (hot / "container_1_0001_01_000001.log").write_text(
        "".join(f"17/06/09 1{i // 3600 % 10}:{i // 60 % 60:02d}:{i % 60:02d} INFO a.B: x\n"
                for i in range(20000)))
    (cold / "container_1_0002_01_000001.log").write_text("17/06/09 00:00:01 INFO a.B: y\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        lines = read_logs(spark, [str(hot), str(cold)], recursive=True)
        assert lines.rdd.getNumPartitions() > 5
        got = {r.application_id: (r.start_time.isoformat(), r.end_time.isoformat())
               for r in usage.app_timeline(lines).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {"application_1_0001": ("2017-06-09T10:00:00", "2017-06-09T15:33:19"),
                   "application_1_0002": ("2017-06-09T00:00:01", "2017-06-09T00:00:01")}


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _shuffled_columns(df):
    """The input columns of every hash or range exchange of the plan that ran."""
    df.write.format("noop").mode("overwrite").save()
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    blocks = re.findall(r"\n\(\d+\) Exchange[^\n]*\nInput \[\d+\]: \[([^\]]*)\]\nArguments: (\w+)", text)
    return [cols for cols, kind in blocks if kind in ("hashpartitioning", "rangepartitioning")]


@pytest.mark.parametrize("splits", [100_000, 0])
def test_sample_and_first_lines_shuffle_no_text(spark, no_broadcast, monkeypatch, splits):
    from daybook.sources import text
    monkeypatch.setattr(text, "SPLITS", splits)
    lines = rendered.rendered_logs(spark, SF_TINY, positions=True)
    sample = sampling.sample_lines(lines, 10, 7, parse.level() != "", parse.container_id("file_path"))
    first = levels.first_lines_containing(lines, "ev.click", 20)
    for df in (sample, first):
        for cols in _shuffled_columns(df):
            assert not re.search(r"\bvalue#", cols), cols
    assert sample.count() == 10 and first.count() == 20


def test_time_parse_runs_one_regex_per_line(spark):
    lines = rendered.rendered_logs(spark, SF_TINY)
    plan = usage.app_timeline(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"RLIKE|regexp_extract\(value", plan)) == 1


def test_stage_skew_never_joins(plans):
    assert "Join" not in plans["stage_skew"]


def test_stage_skew_with_one_hot_stage(spark):
    rows = [("a", 1, float(i % 40)) for i in range(9000)] + [("a", 2, float(i % 7)) for i in range(500)] + [("b", 1, 3.0)] * 500 + [("b", 1, None)]
    df = spark.createDataFrame(rows, "application_id string, stage long, duration_sec double").repartition(13)
    got = {(r.application_id, r.stage): tuple(r)[2:] for r in yarn.stage_skew(df).collect()}
    for key in {(a, s) for a, s, _ in rows}:
        xs = sorted(d for a, s, d in rows if (a, s) == key and d is not None)
        median = xs[(len(xs) + 1) // 2 - 1]
        assert got[key] == (len(xs), median, xs[-1], xs[-1] / median, sum(x > 1.5 * median for x in xs))


def test_report_is_numbered_without_a_one_task_window(spark):
    rows = [(f"c{i:05d}", i % 3, None, None) for i in range(5000)]
    df = spark.createDataFrame(rows, "cluster_id string, num_applications bigint, cluster_first_app timestamp_ntz, cluster_last_app timestamp_ntz")
    got = [r.text for r in usage.cluster_stats_report(df).orderBy("line_no").collect()][5:]
    assert got == [f"  Cluster {c}: {n} applications" for c, n, *_ in sorted(rows, key=lambda r: (-r[1], r[0]))]
