"""Drifting schemas, refreshed results, reports in parts, early stops."""

import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook import sinks
from daybook.operators import incremental, levels, usage
from daybook.sources import read_drifting, read_logs
from daybook.sources.drifting import widened


# ---------------------------------------------------------------- drifting schemas

def test_widened_types():
    i, l, f, d = T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType()
    assert widened("c", [i, l, i]) == l and widened("c", [i, f]) == d and widened("c", [f, d]) == d and widened("c", [i, i]) == i
    assert widened("c", [T.NullType(), i]) == i and widened("c", [T.NullType()]) == T.NullType()
    assert widened("c", [T.DecimalType(10, 2), T.DecimalType(8, 4)]) == T.DecimalType(12, 4)
    assert widened("c", [T.DecimalType(10, 2), i]) == T.DecimalType(12, 2)
    assert widened("c", [T.DateType(), T.TimestampNTZType()]) == T.TimestampNTZType()
    for bad in ([T.StringType(), i], [T.BooleanType(), i], [T.DecimalType(38, 30), l], [T.TimestampType(), T.TimestampNTZType()]):
        with pytest.raises(ValueError, match="'c'"):
            widened("c", bad)


def test_drifting_files_read_as_one_table(spark, tmp_path):
    root = str(tmp_path)
    spark.sql("SELECT 1 AS id, CAST(2 AS INT) AS n, CAST(1.5 AS DOUBLE) AS Fee").write.parquet(f"{root}/y=1/a")
    spark.sql("SELECT CAST(2 AS BIGINT) AS id, CAST(2.5 AS DOUBLE) AS n").write.parquet(f"{root}/y=1/b")
    spark.sql("SELECT 3 AS id, CAST(NULL AS INT) AS n, CAST(7 AS INT) AS fee, 'x' AS more").write.parquet(f"{root}/y=2/c")
    spark.sql("SELECT 4 AS id, CAST(9 AS INT) AS n, CAST(1.5 AS DOUBLE) AS Fee LIMIT 0").write.parquet(f"{root}/y=2/d")
    df = read_drifting(spark, *[f"{root}/{p}" for p in ("y=1/a", "y=1/b", "y=2/c", "y=2/d")], base_path=root)
    assert df.dtypes == [("id", "bigint"), ("n", "double"), ("Fee", "double"), ("more", "string"), ("y", "int")]
    assert sorted(map(tuple, df.collect())) == [(1, 2.0, 1.5, None, 1), (2, 2.5, None, None, 1), (3, None, 7.0, "x", 2)]
    plan = spark._jvm.PythonSQLUtils.explainString(df.where("y = 2 AND more = 'x'").select("id")._jdf.queryExecution(), "formatted")
    assert "PushedFilters: [IsNotNull(more), EqualTo(more,x)]" in plan and "PartitionFilters: [isnotnull(y" in plan
    with pytest.raises(ValueError):
        read_drifting(spark)


# ---------------------------------------------------------------- refreshed results

def _log(root, app, container, text):
    folder = root / f"application_1_{app}"
    folder.mkdir(exist_ok=True)
    path = folder / f"container_1_{app}_01_{container:06d}.log"
    path.write_text(text)
    return str(path)


def _line(level, minute=0):
    return f"24/01/01 00:{minute:02d}:00 {level} a.b: text\n"


def test_refresh_reads_only_new_and_changed_files(spark, tmp_path):
    root, store = tmp_path / "logs", str(tmp_path / "store")
    root.mkdir()
    a = _log(root, "0001", 1, _line("INFO") * 3 + _line("WARN"))
    _log(root, "0001", 2, "no level here\n")
    odd = _log(root, "0002", 1, _line("ERROR"))

    def run():
        rows, read = incremental.level_counts(spark, str(root), store)
        got = {r["level"]: r["count"] for r in rows.collect()}
        full = levels.level_counts(read_logs(spark, str(root), recursive=True)).collect()
        assert got == {r["level"]: r["count"] for r in full}
        return read

    assert run() == 3
    assert run() == 0  # a file without levels is known too
    _log(root, "0003", 1, _line("DEBUG", 9))
    assert run() == 1
    with open(a, "a") as f:
        f.write(_line("INFO"))
    os.utime(a, (time.time() + 5, time.time() + 5))
    assert run() == 1
    os.remove(odd)
    assert run() == 0


def test_refresh_in_several_steps_and_names_with_blanks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(incremental, "PATHS", 2)
    root = tmp_path / "my logs+%41"
    root.mkdir()
    for i in range(5):
        _log(root, f"000{i}", 1, _line("INFO", i) + _line("WARN", i + 10))
    rows, read = incremental.app_timeline(spark, str(root), str(tmp_path / "store"))
    assert read == 5
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, usage.app_timeline(read_logs(spark, str(root), recursive=True)).collect()))


def test_refresh_of_an_empty_folder(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    rows, read = incremental.level_counts(spark, str(tmp_path / "logs"), str(tmp_path / "store"))
    assert read == 0 and rows.count() == 0


# ---------------------------------------------------------------- long reports

def test_long_report_is_written_by_many_tasks_and_read_in_order(spark, tmp_path):
    n, path = 200_000, str(tmp_path / "report")
    summary = spark.range(n).select(F.format_string("%07d", "id").alias("cluster_id"), (F.col("id") * 7919 % 1000).alias("num_applications"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        report = usage.cluster_stats_report(summary)
        sinks.write_report(report, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len([f for f in os.listdir(path) if f.startswith("part-") and os.path.getsize(f"{path}/{f}")]) > 3
    got = sinks.read_report(spark, path).orderBy("line_no").collect()
    assert [r["line_no"] for r in got] == list(range(1, n + 6))
    ranked = sorted(((-(i * 7919 % 1000), f"{i:07d}") for i in range(n)))
    assert [r["text"] for r in got[5:]] == [f"  Cluster {c}: {-a} applications" for a, c in ranked]
    joined = "".join(open(f"{path}/{f}").read() for f in sorted(os.listdir(path)) if f.startswith("part-"))
    assert joined.splitlines() == [r["text"] for r in got]


# ---------------------------------------------------------------- first lines

def test_first_lines_stop_early(spark, tmp_path, monkeypatch):
    for i in range(40):
        (tmp_path / f"f{i:02d} a.log").write_text("".join(f"line {j}{' hit' if i % 3 == 1 and j % 4 == 0 else ''}\n" for j in range(20)))
    read = []
    plain = levels.read_logs
    monkeypatch.setattr(levels, "read_logs", lambda s, paths, **kw: read.append((len(paths), kw)) or plain(s, paths, **kw))
    got = levels.first_lines_in(spark, str(tmp_path), "hit", 12, files=2).collect()
    assert [(r["file_path"].split("/")[-1], r["line_no"]) for r in got] == [(f"f{i:02d}%20a.log", j + 1) for i in (1, 4, 7) for j in range(0, 20, 4)][:12]
    assert [n for n, _ in read] == [2, 4, 8, 5]  # fourteen files searched, those with hits read again
    whole = levels.first_lines_containing(plain(spark, str(tmp_path), positions=True), "hit", 12).collect()
    assert [(r["file_path"], r["line_no"], r["value"]) for r in got] == [(r["file_path"], r["line_no"], r["value"]) for r in whole]
    assert levels.first_lines_in(spark, str(tmp_path), "nowhere", 5).count() == 0
    assert levels.first_lines_in(spark, str(tmp_path), "hit", 1000).count() == 13 * 5
