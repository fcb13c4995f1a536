"""Edge lines for the log grammar."""

import datetime as dt

import pytest

from daybook.functions import parse

EDGE = [
    # line, timestamp prefix, level, component, parsed time
    ("17/06/09 12:49:56 INFO storage.BlockManager: Removing RDD 13739",
     "17/06/09 12:49:56", "INFO", "storage.BlockManager", dt.datetime(2017, 6, 9, 12, 49, 56)),
    ("17/06/09 12:49:56 WARN a.B: saw ERROR code", "17/06/09 12:49:56", "WARN", "a.B",
     dt.datetime(2017, 6, 9, 12, 49, 56)),
    ("  at java.INFORMATION.x", "", "INFO", "", None),
    ("99/99/99 10:00:00 ERROR x.Y: bad", "99/99/99 10:00:00", "ERROR", "x.Y", None),
    (" 17/06/09 12:49:56 INFO lead.Space: x", "", "INFO", "lead.Space", None),
    ("17/06/09 12:49:56 FATAL z: q", "17/06/09 12:49:56", "", "", dt.datetime(2017, 6, 9, 12, 49, 56)),
    ("17/06/09 12:49:56 info lower: x", "17/06/09 12:49:56", "", "", dt.datetime(2017, 6, 9, 12, 49, 56)),
    ("17/06/09 12:49:56 INFO no colon here", "17/06/09 12:49:56", "INFO", "",
     dt.datetime(2017, 6, 9, 12, 49, 56)),
    ("", "", "", "", None),
    ("69/01/01 00:00:59 DEBUG y: z", "69/01/01 00:00:59", "DEBUG", "y", dt.datetime(2069, 1, 1, 0, 0, 59)),
    ("17/06/09 12:49:60 INFO y: z", "17/06/09 12:49:60", "INFO", "y", None),
    ("17/02/30 12:00:00 INFO y: z", "17/02/30 12:00:00", "INFO", "y", None),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(r[0],) for r in EDGE] + [(None,)], "value string")
    return df.select("value", parse.timestamp_prefix("value").alias("ts"),
                     parse.level("value").alias("level"), parse.component("value").alias("component"),
                     parse.log_time("value").alias("time")).collect()


def test_edge_lines(parsed):
    got = {r["value"]: r for r in parsed if r["value"] is not None}
    for line, ts, level, comp, time in EDGE:
        r = got[line]
        assert (r["ts"], r["level"], r["component"], r["time"]) == (ts, level, comp, time), line


def test_null_line_stays_null(parsed):
    r = [r for r in parsed if r["value"] is None][0]
    assert r["ts"] is None and r["level"] is None and r["time"] is None


def test_time_is_ntz(spark):
    df = spark.createDataFrame([("17/06/09 12:49:56 INFO a: b",)], "value string")
    assert df.select(parse.log_time("value").alias("t")).schema["t"].dataType.typeName() == "timestamp_ntz"


def test_strict_level(spark):
    df = spark.createDataFrame([("  at java.INFORMATION.x",), ("17/06/09 12:49:56 WARN a: ERROR",)],
                               "value string")
    got = [r[0] for r in df.select(parse.level("value", strict=True)).collect()]
    assert got == ["", "WARN"]


def test_path_ids(spark):
    p = ("s3a://bucket/data/application_1485248649253_0132/"
         "container_1485248649253_0132_01_000001.log")
    df = spark.createDataFrame([(p,), ("file:/x/k=application_1_0002/c=container_1_0002_01_000003/p.txt",),
                                ("file:/no/ids.txt",)], "file_path string")
    r = df.select(parse.application_id("file_path").alias("a"),
                  parse.cluster_id(parse.application_id("file_path")).alias("c"),
                  parse.app_number(parse.application_id("file_path")).alias("n"),
                  parse.container_id("file_path").alias("k"),
                  parse.container_role(parse.container_id("file_path")).alias("role")).collect()
    assert tuple(r[0]) == ("application_1485248649253_0132", "1485248649253", "0132",
                           "container_1485248649253_0132_01_000001", "application_master")
    assert tuple(r[1]) == ("application_1_0002", "1", "0002", "container_1_0002_01_000003", "executor")
    assert tuple(r[2]) == ("", "", "", "", "")


def test_all_levels_counts_every_occurrence(spark):
    df = spark.createDataFrame([("17/06/09 12:49:56 WARN a.B: saw ERROR and INFO, INFOINFO",)],
                               "value string")
    assert df.select(parse.all_levels("value")).first()[0] == ["WARN", "ERROR", "INFO", "INFO", "INFO"]


def test_no_python_udf_in_parsing(spark):
    df = spark.createDataFrame([("17/06/09 12:49:56 INFO a: b",)], "value string")
    q = df.select(parse.log_time("value"), parse.level("value"), parse.component("value"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
