"""Text sources: manifests, lineage, line numbers and entry stitching across splits."""

import os
import random

import pytest
from pyspark.sql import functions as F

from daybook.operators import levels, yarn
from daybook.sources import expand_manifest, number_lines, read_log_glob, read_logs, read_months


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes",
                                          "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _write(path, text, mode="w", newline=None):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, mode, newline=newline) as f:
        f.write(text)
    return path


def test_manifest_strips_drops_blanks_and_dedupes(spark, tmp_dir):
    a = _write(f"{tmp_dir}/logs/application_1_0001/container_1_0001_01_000001.log", "17/01/01 00:00:00 INFO a: b\n")
    _write(f"{tmp_dir}/manifest.txt",
           f"  application_1_0001/container_1_0001_01_000001.log \n\n"
           f"application_1_0001/container_1_0001_01_000001.log\n")
    paths = expand_manifest(spark, f"{tmp_dir}/manifest.txt", f"{tmp_dir}/logs")
    assert paths == [a]
    assert read_logs(spark, paths).count() == 1


def test_duplicate_path_is_read_twice_without_dedupe(spark, tmp_dir):
    a = _write(f"{tmp_dir}/a.log", "x\ny\n")
    assert read_logs(spark, [a, a]).count() == 4


def test_crlf_zero_length_and_blank_lines(spark, tmp_dir):
    _write(f"{tmp_dir}/d/application_1_0001/c.log", "a\r\nb\r\n\r\nc", newline="")
    _write(f"{tmp_dir}/d/application_1_0001/empty.log", "")
    df = read_log_glob(spark, f"{tmp_dir}/d/application_*/*.log")
    assert sorted(r.value for r in df.collect()) == ["", "a", "b", "c"]
    assert df.select("file_path").distinct().count() == 1  # empty file yields no row


def test_line_numbers_exact_across_splits(spark, tmp_dir, small_splits):
    paths = []
    for f in range(3):
        n = 500 + 250 * f
        paths.append(_write(f"{tmp_dir}/n/f{f}.log",
                            "".join(f"{f}:{i}:" + "x" * (i % 37) + "\n" for i in range(1, n + 1))))
    lines = read_logs(spark, paths, positions=True)
    assert lines.select("file_block_start").distinct().count() > 3  # really split
    got = number_lines(lines).select("value", "line_no").collect()
    assert len(got) == 500 + 750 + 1000
    for r in got:
        assert int(r.value.split(":")[1]) == r.line_no


def _expected(text, most):
    """Rows (entry_no, part, first_line_no, n_lines, text), line by line."""
    rows, entry, inside = [], 0, 0
    for i, line in enumerate(text.split("\n")[:-1], start=1):
        if len(line) >= 17 and line[2] == "/" and line[:2].isdigit() and line[8] == " ":
            entry, inside = entry + 1, 0
        inside += 1
        part = inside - 1 if entry == 0 else (inside - 1) // most
        if rows and rows[-1][:2] == (entry, part):
            e, p, first, n, t = rows[-1]
            rows[-1] = (e, p, first, n + 1, t + "\n" + line)
        else:
            rows.append((entry, part, i, 1, line))
    return rows


def _stitched(lines, most):
    rows = yarn.stitch_entries(lines, most=most).collect()
    return sorted((r.entry_no, r.part, r.first_line_no, r.n_lines, r.text) for r in rows)


def test_stitching_across_splits(spark, tmp_dir, small_splits):
    rnd = random.Random(3)
    out = []
    out.append("\tat orphan.before.first")  # continuation before any entry
    for i in range(900):
        out.append(f"17/06/09 12:{i // 60 % 60:02d}:{i % 60:02d} INFO c.D: entry {i}")
        for j in range(rnd.choice([0, 0, 0, 1, 3, 12])):
            out.append(f"\tat frame.{i}.{j}" + "y" * rnd.randrange(40))
    text = "\n".join(out) + "\n"
    p = _write(f"{tmp_dir}/s/application_1_0001/container_1_0001_01_000002.log", text)
    lines = read_logs(spark, [p], positions=True)
    assert lines.select("file_block_start").distinct().count() > 5
    assert _stitched(lines, 1000) == _expected(text, 1000)
    assert _stitched(lines, 4) == _expected(text, 4)


def test_read_months_keeps_partition_and_prunes(spark, tmp_dir):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").limit(50)
    for m in (1, 2, 3):
        li.write.parquet(f"{tmp_dir}/trips/yyyy=2021/yellow_tripdata_2021-{m:02d}.parquet")
    df = read_months(spark, f"{tmp_dir}/trips", 2021, [1, 3])
    assert "yyyy" in df.columns
    assert df.count() == 100
    assert df.where(F.col("yyyy") == 2020).count() == 0


def test_level_counts_on_text_files(spark, tmp_dir):
    p = _write(f"{tmp_dir}/l/x.log", "17/06/09 12:49:56 INFO a: b\n17/06/09 12:49:56 ERROR a: b\n"
                                     "no level\n17/06/09 12:49:56 INFO c: WARN\n")
    got = {r.level: r["count"] for r in levels.level_counts(read_logs(spark, p)).collect()}
    assert got == {"INFO": 2, "ERROR": 1}


def test_stitching_with_splits_that_hold_no_timestamp(spark, tmp_dir, small_splits):
    out = [f"\tat orphan.{j}" + "z" * 30 for j in range(400)]  # several splits before any entry
    for i in range(300):
        out.append(f"17/06/09 13:{i // 60 % 60:02d}:{i % 60:02d} ERROR c.D: entry {i}")
        n = 700 if i in (5, 150) else (i % 4)  # two traces spanning several splits
        out.extend(f"\tat frame.{i}.{j}" + "q" * 25 for j in range(n))
    text = "\n".join(out) + "\n"
    p = _write(f"{tmp_dir}/t/application_1_0001/container_1_0001_01_000003.log", text)
    lines = read_logs(spark, [p], positions=True)
    blocks = lines.groupBy("file_block_start").agg(
        F.count_if(F.col("value").rlike(r"^\d\d/")).alias("heads"))
    assert blocks.where("heads = 0").count() >= 3  # splits without any timestamp
    assert _stitched(lines, 1000) == _expected(text, 1000)
    assert _stitched(lines, 100) == _expected(text, 100)


def test_a_file_without_timestamps_is_no_single_row(spark, tmp_dir, small_splits):
    text = "".join(f"\tat frame.{i}" + "w" * 30 + "\n" for i in range(5000))
    p = _write(f"{tmp_dir}/w/application_1_0001/container_1_0001_01_000004.log", text)
    lines = read_logs(spark, [p], positions=True)
    assert lines.select("file_block_start").distinct().count() >= 50
    rows = yarn.stitch_entries(lines).collect()
    assert len(rows) == 5000 and all(r.n_lines == 1 and r.entry_no == 0 for r in rows)
    assert "\n".join(r.text for r in sorted(rows, key=lambda r: r.first_line_no)) + "\n" == text


def test_one_entry_over_many_splits_is_cut_into_parts(spark, tmp_dir, small_splits):
    text = "17/06/09 13:00:00 ERROR c.D: long\n" + "".join(f"\tat frame.{i}" + "v" * 30 + "\n" for i in range(4000)) + "17/06/09 13:00:01 INFO c.D: end\n"
    p = _write(f"{tmp_dir}/v/application_1_0001/container_1_0001_01_000005.log", text)
    lines = read_logs(spark, [p], positions=True)
    assert _stitched(lines, 1000) == _expected(text, 1000)
    got = yarn.entry_lines(lines).orderBy("line_no").collect()
    assert [r.line_no for r in got] == list(range(1, 4003)) and {r.entry_no for r in got} == {1, 2}


def test_numbers_are_the_same_beyond_the_broadcast_bound(spark, tmp_dir, small_splits, monkeypatch):
    from daybook.sources import text as source
    p = _write(f"{tmp_dir}/b/f.log", "".join(f"{i}:" + "x" * (i % 50) + "\n" for i in range(1, 2001)))
    monkeypatch.setattr(source, "SPLITS", 0)
    got = number_lines(read_logs(spark, [p], positions=True)).select("value", "line_no").collect()
    assert len(got) == 2000 and all(int(r.value.split(":")[0]) == r.line_no for r in got)


ODD = ["\u2028", "\u0085", "\u0001", "\r"]


@pytest.mark.parametrize("odd", ODD)
@pytest.mark.parametrize("where", ["before", "after", "both"])
def test_no_matching_line_is_dropped(spark, odd, where):
    def put(line):
        return (odd if where != "after" else "") + line + (odd + "tail" if where != "before" else "")

    path = "application_1_0001/container_1_0001_01_000002.log"
    texts = {
        "broadcast_reads": "17/01/01 00:00:00 INFO b: Started reading broadcast variable 7",
        "executor_requests": "17/01/01 00:00:00 INFO y: Will request 3 executor containers, each with 5 cores and 100 MB memory including 10 MB overhead",
        "container_requests": "17/01/01 00:00:00 INFO y: Container request (host: h1, capability: <memory:100, vCores:5>)",
        "python_times": "17/01/01 00:00:00 INFO python.PythonRunner: Times: total = 3, boot = -1, init = 2, finish = 2",
        "memory_usage": "17/01/01 00:00:00 INFO m: MemoryStore started with capacity 2.0 GB",
    }
    for name, text in texts.items():
        df = spark.createDataFrame([(put(text), path)], "value string, file_path string")
        assert getattr(yarn, name)(df).count() == 1, (name, odd, where)


def test_tasks_agree_between_attempts_and_failure_rates(spark):
    path = "application_1_0001/container_1_0001_01_000002.log"
    rows = []
    for i, odd in enumerate(["", *ODD]):
        rows.append((f"{odd}17/01/01 00:00:00 INFO e: Running task {i}.0 in stage 1.0 (TID {i}){odd}", path))
        if i % 2:
            rows.append((f"{odd}17/01/01 00:00:09 INFO e: Finished task {i}.0 in stage 1.0 (TID {i}). 5 bytes result{odd}", path))
    df = spark.createDataFrame(rows, "value string, file_path string")
    attempts = yarn.task_attempts(df)
    assert attempts.count() == 5
    summary = yarn.failure_rates(df).first()
    assert summary.unfinished_attempts == 3 and summary.lines == len(rows)
    assert attempts.where("result_bytes IS NULL").count() == 3


def test_control_characters_inside_free_text_shift_nothing(spark):
    path = "application_1_0001/container_1_0001_01_000002.log"
    df = spark.createDataFrame([
        ("x INFO r: Input split: hdfs://a\u0001b:1+2", path),
        ("x INFO y: Container request (host: h\u0001i, capability: <memory:100, vCores:5>)", path)], "value string, file_path string")
    assert tuple(yarn.input_splits(df).first())[:4] == ("hdfs://a\u0001b", 1, 2, 3)
    assert tuple(yarn.container_requests(df).first())[:3] == ("h\u0001i", 100, 5)


def test_application_numbers_are_not_cut(spark):
    from daybook.plans import rendered
    users = [4 * 5, 9_999 * 5 + 4, 10_000 * 5, 149_999 * 5 + 1]
    ev = spark.createDataFrame([(i, u, "click", 1.0) for i, u in enumerate(users)], "event_id long, user_id long, event_type string, value double") \
        .withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    keys = [r.k.rsplit("_", 1)[1] for r in rendered.event_log_lines(ev).orderBy("event_id").collect()]
    assert keys == ["0004", "9999", "10000", "149999"]


def test_sql_count_leaves_the_views_alone(spark):
    from daybook.sources import sql_count
    spark.range(3).createOrReplaceTempView("orders_view")
    before = {t.name for t in spark.catalog.listTables()}
    assert sql_count(spark, spark.range(11)).first().total == 11
    assert {t.name for t in spark.catalog.listTables()} == before and spark.table("orders_view").count() == 3
