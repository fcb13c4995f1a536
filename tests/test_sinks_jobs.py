"""Sinks round trip, the three end-to-end jobs, and the streaming level count."""

import glob
import os

from pyspark.sql import functions as F

from daybook import sinks
from daybook.operators import levels
from daybook.plans import jobs
from daybook.plans import rendered
from daybook.sources import read_logs
from daybook.streaming import start_level_counts
from conftest import SF_TINY


def test_csv_round_trip_keeps_quotes_commas_and_zeros(spark, tmp_dir):
    import datetime as dt
    rows = [("1485248649253", "application_1485248649253_0132", "0132",
             dt.datetime(2017, 6, 8, 18, 53, 13), dt.datetime(2017, 6, 8, 22, 49, 1))]
    df = spark.createDataFrame(rows, sinks.TIMELINE_SCHEMA)
    sinks.write_csv(df, f"{tmp_dir}/t", single_file=True)
    text = open(glob.glob(f"{tmp_dir}/t/*.csv")[0]).read()
    assert text.splitlines()[1] == ("1485248649253,application_1485248649253_0132,0132,"
                                    "2017-06-08 18:53:13,2017-06-08 22:49:01")
    back = sinks.read_csv(spark, f"{tmp_dir}/t", sinks.TIMELINE_SCHEMA)
    assert back.collect() == df.collect()
    s = spark.createDataFrame([("17/06/07 15:30:58", "INFO", 'Times: total = 40, "boot" = -43')],
                              sinks.SAMPLE_SCHEMA)
    sinks.write_csv(s, f"{tmp_dir}/s", single_file=True)
    assert '"Times: total = 40, ""boot"" = -43"' in open(glob.glob(f"{tmp_dir}/s/*.csv")[0]).read()
    assert sinks.read_csv(spark, f"{tmp_dir}/s", sinks.SAMPLE_SCHEMA).collect() == s.collect()


def test_log_levels_job(spark, tmp_dir):
    logs = rendered.write_event_logs(spark.read.parquet(f"{SF_TINY}/events.parquet"), f"{tmp_dir}/logs")
    files = sorted(glob.glob(f"{logs}/k=*/c=*/*.txt"))
    out = jobs.log_levels_job(spark, files, f"{tmp_dir}/out", seed=7)
    counts = sinks.read_csv(spark, out["counts"], sinks.LEVEL_COUNTS_SCHEMA)
    want = levels.level_counts(read_logs(spark, files))
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, want.collect()))
    assert sinks.read_csv(spark, out["sample"], sinks.SAMPLE_SCHEMA).count() == 10
    report = [r.text for r in sinks.read_report(spark, out["summary"]).collect()]
    assert report[0].startswith("Total log lines processed: ") and report[4] == "Log level distribution:"
    unseeded = jobs.log_levels_job(spark, files, f"{tmp_dir}/out2")
    assert sinks.read_csv(spark, unseeded["sample"], sinks.SAMPLE_SCHEMA).count() == 10


def test_cluster_usage_job(spark, tmp_dir):
    logs = rendered.write_event_logs(spark.read.parquet(f"{SF_TINY}/events.parquet"), f"{tmp_dir}/logs")
    files = sorted(glob.glob(f"{logs}/k=*/c=*/*.txt"))
    out = jobs.cluster_usage_job(spark, files, f"{tmp_dir}/out")
    tl = sinks.read_csv(spark, out["timeline"], sinks.TIMELINE_SCHEMA)
    cs = sinks.read_csv(spark, out["cluster_summary"], sinks.CLUSTER_SUMMARY_SCHEMA)
    assert tl.count() == cs.agg(F.sum("num_applications")).first()[0]
    assert tl.where(F.length("app_number") != 4).count() == 0
    hist = spark.read.option("header", True).option("inferSchema", True).csv(out["histogram"])
    dur = spark.read.option("header", True).csv(out["durations"])
    assert hist.agg(F.sum("count")).first()[0] == dur.count()
    stats = [r.text for r in sinks.read_report(spark, out["stats"]).collect()]
    assert stats[0].startswith("Total unique clusters: ")


def test_daily_summary_job(spark, tmp_dir):
    path = jobs.daily_summary_job(spark, f"{SF_TINY}/lineitem.parquet", tmp_dir, 1998,
                                  ts="l_shipdate", distance="l_quantity", tax="l_tax",
                                  fare="l_extendedprice", tip="l_discount", passengers="l_quantity")
    df = sinks.read_csv(spark, path, sinks.DAILY_SUMMARY_SCHEMA)
    first = df.first()
    assert df.count() > 0 and (first.dt_year, first.dt_month) == (1998, 12)


def test_streaming_level_counts_equal_batch(spark, tmp_dir):
    logs = rendered.write_event_logs(spark.read.parquet(f"{SF_TINY}/events.parquet"), f"{tmp_dir}/logs")
    q = start_level_counts(spark, f"{logs}/k=*/c=*/*.txt", f"{tmp_dir}/ckpt",
                           query_name="lvl_stream_test", max_files_per_trigger=200)
    try:
        q.processAllAvailable()
        got = sorted(map(tuple, spark.sql("select level, count from lvl_stream_test").collect()))
    finally:
        q.stop()
    want = sorted(map(tuple, levels.level_counts(read_logs(spark, logs, recursive=True)).collect()))
    assert got == want and os.path.isdir(f"{tmp_dir}/ckpt")


def test_streaming_counts_grow_with_arriving_files(spark, tmp_dir):
    import shutil
    src = rendered.write_event_logs(spark.read.parquet(f"{SF_TINY}/events.parquet"), f"{tmp_dir}/all")
    files = sorted(glob.glob(f"{src}/k=*/c=*/*.txt"))
    inbox = f"{tmp_dir}/inbox"
    os.makedirs(inbox)
    half = len(files) // 2
    for i, f in enumerate(files[:half]):
        shutil.copy(f, f"{inbox}/f{i:05d}.log")
    q = start_level_counts(spark, f"{inbox}/*.log", f"{tmp_dir}/ckpt2", query_name="lvl_grow")
    try:
        q.processAllAvailable()
        first = dict(map(tuple, spark.sql("select level, count from lvl_grow").collect()))
        for i, f in enumerate(files[half:], start=half):
            shutil.copy(f, f"{inbox}/f{i:05d}.log")
        q.processAllAvailable()
        second = dict(map(tuple, spark.sql("select level, count from lvl_grow").collect()))
    finally:
        q.stop()
    want = dict(map(tuple, levels.level_counts(read_logs(spark, files)).collect()))
    assert second == want
    assert sum(first.values()) < sum(second.values())
