"""Operator semantics on tiny frames: relations, guards, layout independence."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.operators import distribution, levels, percentile, sampling, trips, usage


def test_level_summary_relations_and_zero_guard(spark):
    rows = [("17/01/01 00:00:00 INFO a: b",)] * 3 + [("x WARN",), ("none",)]
    s = levels.level_summary(spark.createDataFrame(rows, "value string")).collect()
    assert {r.level: r["count"] for r in s} == {"INFO": 3, "WARN": 1}
    assert all(r.total_lines == 5 and r.lines_with_level == 4 and r.unique_levels == 2 for r in s)
    assert math.isclose(sum(r.pct for r in s), 100.0)
    empty = levels.level_summary(spark.createDataFrame([("none",)], "value string"))
    assert empty.count() == 0


def test_level_report_format(spark):
    rows = [("17/01/01 00:00:00 INFO a: b",)] * 3 + [("x ERROR y",)]
    rep = levels.level_report(levels.level_summary(spark.createDataFrame(rows, "value string")))
    lines = [r.text for r in rep.orderBy("line_no").collect()]
    assert lines == ["Total log lines processed: 4", "Total lines with log levels: 4",
                     "Unique log levels found: 2", "", "Log level distribution:",
                     "  INFO  :          3 ( 75.00%)", "  ERROR :          1 ( 25.00%)"]


def test_histogram_matches_numpy(spark):
    rnd = random.Random(5)
    xs = [float(rnd.randint(1, 50000)) for _ in range(400)] + [0.0, -3.0]
    df = spark.createDataFrame([(x,) for x in xs], "duration_sec double")
    h = distribution.log_histogram(df).orderBy("bin").collect()
    pos = np.log10([x for x in xs if x > 0])
    counts, edges = np.histogram(pos, bins=30)
    assert [r["count"] for r in h] == counts.tolist()
    assert all(r.n == len(pos) for r in h)
    assert np.allclose([r.log_lo for r in h], edges[:-1])


def test_histogram_single_value_guard(spark):
    df = spark.createDataFrame([(100.0,), (100.0,)], "duration_sec double")
    h = distribution.log_histogram(df).orderBy("bin").collect()
    counts, _ = np.histogram(np.log10([100.0, 100.0]), bins=30)
    assert [r["count"] for r in h] == counts.tolist()


def test_density_matches_direct_formula(spark):
    rnd = random.Random(9)
    xs = [float(rnd.randint(1, 5000)) for _ in range(200)]
    df = spark.createDataFrame([(x,) for x in xs], "duration_sec double")
    d = distribution.log_density(df).orderBy("grid_index").collect()
    lx = np.log10(xs)
    h = lx.std(ddof=1) * len(lx) ** (-0.2)
    grid = np.linspace(lx.min(), lx.max(), 200)
    dens = np.exp(-0.5 * ((grid[:, None] - lx[None, :]) / h) ** 2).sum(1) / (len(lx) * h * math.sqrt(2 * math.pi))
    assert np.allclose([r.density for r in d], dens, rtol=1e-9)


def test_exact_percentile_matches_percentile_disc(spark):
    rnd = random.Random(1)
    rows = [(g, float(rnd.randint(0, 60))) for g in range(30) for _ in range(rnd.randint(1, 80))]
    rows += [(99, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    for q in (0.0, 0.05, 0.5, 0.95, 1.0):
        mine = {r.g: r.percentile for r in percentile.exact(df, ["g"], "v", q).collect()}
        df.createOrReplaceTempView("pt")
        ref = {r.g: r.p for r in spark.sql(
            f"select g, percentile_disc({q}) within group (order by v) p from pt "
            f"where v is not null group by g").collect()}
        assert mine == ref, q


def test_daily_overall_empty_year(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    r = trips.daily_overall(li, 1900, ts="l_shipdate").first()
    assert r.rows_in_year == 0 and r.days_with_data == 0 and r.mean_daily_trips is None


def test_sample_is_layout_independent(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    a = [r.k for r in sampling.sample_rows(df, 10, 42, ["k"]).collect()]
    b = [r.k for r in sampling.sample_rows(df.repartition(7), 10, 42, ["k"]).collect()]
    c = [r.k for r in sampling.sample_rows(df.repartition(1), 10, 42, ["k"]).collect()]
    assert a == b == c and len(set(a)) == 10


def test_cluster_stats_zero_guard(spark):
    empty = spark.createDataFrame([], "cluster_id string, num_applications bigint, "
                                      "cluster_first_app timestamp_ntz, cluster_last_app timestamp_ntz")
    r = usage.cluster_stats(empty).first()
    assert (r.total_clusters, r.total_applications, r.avg_apps_per_cluster) == (0, 0, 0.0)


def test_largest_cluster_ties_break_by_id(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    tl = spark.createDataFrame(
        [("2", "application_2_0001", "0001", t, t + dt.timedelta(seconds=5)),
         ("1", "application_1_0001", "0001", t, t + dt.timedelta(seconds=9)),
         ("1", "application_1_0002", "0002", t, t)],
        "cluster_id string, application_id string, app_number string, start_time timestamp_ntz, "
        "end_time timestamp_ntz")
    d = usage.largest_cluster_durations(tl).collect()
    assert [(r.application_id, r.duration_sec) for r in d] == [("application_1_0001", 9.0)]


@pytest.mark.parametrize("parts", [1, 7])
def test_level_counts_layout_independent(spark, parts):
    rows = [(f"17/01/01 00:00:00 {lv} a: b",) for lv in ["INFO", "WARN", "ERROR", "DEBUG"] * 25]
    df = spark.createDataFrame(rows, "value string")
    a = sorted(map(tuple, levels.level_counts(df).collect()))
    b = sorted(map(tuple, levels.level_counts(df.repartition(parts)).collect()))
    assert a == b


def test_seconds_between_is_wall_clock_in_any_zone(spark):
    import datetime as dt
    from daybook.functions.time import seconds_between
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 1, 0), dt.datetime(2024, 3, 10, 3, 0))],
                                   "s timestamp_ntz, e timestamp_ntz")
        assert df.select(seconds_between("s", "e")).first()[0] == 7200.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("inside", [40, 1_000_000])
def test_exact_percentile_with_a_hot_group(spark, reuse, inside):
    """Right whatever the optimizer reuses, with one group holding most rows,
    a group of equal values, a null key, and several narrowing rounds."""
    rnd = random.Random(11)
    rows = [(0, float(rnd.randint(0, 5000))) for _ in range(9000)]       # hot group
    rows += [(g, float(rnd.randint(0, 50))) for g in range(1, 40) for _ in range(25)]
    rows += [(77, 5.0)] * 3000 + [(None, float(i)) for i in range(100)] + [(5, None)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(16)
    df.createOrReplaceTempView("hot")
    old = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        for q in (0.5, 0.95, 1.0):
            mine = {r.g: r.percentile for r in percentile.exact(df, ["g"], "v", q, inside=inside).collect()}
            ref = {r.g: r.p for r in spark.sql(
                f"select g, percentile_disc({q}) within group (order by v) p from hot where v is not null group by g").collect()}
            assert mine == ref, q
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)


def test_exact_percentile_widens_a_bracket_that_misses(spark, monkeypatch):
    """A sketch so coarse that its steps miss the rank only costs more rounds."""
    rnd = random.Random(3)
    rows = [(0, rnd.expovariate(1.0)) for _ in range(4000)]
    df = spark.createDataFrame(rows, "g int, v double")
    monkeypatch.setattr(percentile, "ACCURACY", 5)
    xs = sorted(v for _, v in rows)
    for q in (0.03, 0.5, 0.97):
        got = percentile.exact(df, ["g"], "v", q, inside=200).first().percentile
        assert got == xs[math.ceil(q * len(xs)) - 1], q


def test_exact_percentile_needs_no_range_partitions(spark):
    df = spark.range(200_000).select((F.col("id") % 3).alias("g"), F.xxhash64("id").cast("double").alias("v"))
    out = percentile.exact(df, ["g"], "v", 0.95)
    out.write.format("noop").mode("overwrite").save()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    assert out.count() == 3


@pytest.mark.parametrize("q", [0.0, 0.9, 0.901, 0.95, 1.0])
def test_exact_percentile_ends_at_the_edge_between_two_heavy_values(spark, monkeypatch, q):
    """More rows than may be left, and the wanted rank at the last of one value: no bracket between them helps."""
    rounds = []
    narrowed = percentile._narrowed
    monkeypatch.setattr(percentile, "_narrowed", lambda *a: rounds.append(1) or narrowed(*a))
    rows = [(0, 1.0)] * 900 + [(0, 2.0)] * 100 + [(1, None)] * 5 + [(None, 7.0)] * 300 + [(2, float(i // 300)) for i in range(900)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(5)
    mine = {r.g: r.percentile for r in percentile.exact(df, ["g"], "v", q, inside=10).collect()}
    df.createOrReplaceTempView("edge")
    assert mine == {r.g: r.p for r in spark.sql(f"select g, percentile_disc({q}) within group (order by v) p from edge where v is not null group by g").collect()}
    assert 1 <= len(rounds) <= 3


def test_exact_percentile_of_nothing_and_of_odd_numbers(spark):
    df = spark.createDataFrame([], "g int, v double")
    assert percentile.exact(df, ["g"], "v", 0.5).count() == 0
    odd = [float("nan"), float("-inf"), -0.0, 0.0, float("inf")]
    df = spark.createDataFrame([(i % 3, odd[i % 5]) for i in range(600)], "g int, v double")
    df.createOrReplaceTempView("odd")
    want = {r.g: str(r.p) for r in spark.sql("select g, percentile_disc(0.7) within group (order by v) p from odd group by g").collect()}
    for inside in (3, 1000):
        assert {r.g: str(r.percentile) for r in percentile.exact(df, ["g"], "v", 0.7, inside=inside).collect()} == want


def test_density_of_equal_durations_is_null(spark):
    from daybook.operators import distribution

    for n in (1, 2, 5):
        got = distribution.log_density(spark.createDataFrame([(60.0,)] * n, "duration_sec double"), grid=4).orderBy("grid_index").collect()
        assert [r.grid_index for r in got] == [0, 1, 2, 3] and all(r.density is None and r.scaled_count is None for r in got)
    some = distribution.log_density(spark.createDataFrame([(10.0,), (100.0,)], "duration_sec double"), grid=3).collect()
    assert len(some) == 3 and all(r.density > 0 for r in some)
    assert distribution.log_density(spark.createDataFrame([], "duration_sec double")).count() == 0
