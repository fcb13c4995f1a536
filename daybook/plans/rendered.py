"""Spark-on-YARN style log files rendered from the ``events`` table.

Raw logs are not among the given tables, so the log workloads run on text
files that Spark writes from ``events``: one directory per application (five
users each), one file per container, lines in time order. Every value in a line is a
function of an event's columns, so an independent SQL oracle can compute
each expected result straight from ``events``.

Events are repartitioned by container, each becomes its lines, and partitions
are sorted for the write, so it scales with ``events``.

Layout: ``<root>/k=application_<cluster>_<nnnn>/c=container_<cluster>_<nnnn>_01_<nnnnnn>/part-*.txt``
(the path patterns are unanchored, so the ``k=``/``c=`` prefixes are harmless).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import scratch_path, table_path
from daybook.sources.text import with_lineage

# --- Fixed values of the rendering rule (see FIXTURES.md section 3). ---
CLUSTER_BASE = 1485248649253
USERS_PER_APPLICATION = 5
LINE_TIME_FORMAT = "yy/MM/dd HH:mm:ss"
EVENT_LEVELS = {"error": "ERROR", "purchase": "WARN", "click": "DEBUG", "view": "INFO"}
SECOND_LEVELS = ["INFO", "WARN", "ERROR", "DEBUG"]
UNLEVELED_LINE = "\tat frame"
# --- end of fixed values ---

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # how Spark names a folder of nulls
EVENTS = 50_000  # events whose lines one task writes

BASE = ("base",)
YARN = ("base", "executor_request", "container_request", "task_running", "task_finished",
        "python_times", "input_split", "memory_store", "block_stored", "error_trace",
        "broadcast_read")


def _keys(ev: DataFrame) -> DataFrame:
    app, eid = F.floor(F.col("user_id") / USERS_PER_APPLICATION), F.col("event_id")
    cidx = F.when(app % 10 < 6, F.lit(0)).otherwise(app % 10 - 5)
    cluster = (F.lit(CLUSTER_BASE) + cidx).cast("string")
    num = F.format_string("%04d", app)  # at least four digits; longer numbers stay whole
    return ev.select(
        "event_id", "user_id", "event_type", "value", "ts",
        F.concat(F.lit("application_"), cluster, F.lit("_"), num).alias("k"),
        F.concat(F.lit("container_"), cluster, F.lit("_"), num, F.lit("_01_"),
                 F.lpad((eid % 5 + 1).cast("string"), 6, "0")).alias("c"),
        _stamp(F.col("ts")).alias("now"), _second(F.col("ts")).alias("line_ts"),  # once for all templates
    )


def _stamp(ts: Column) -> Column:
    return F.date_format(ts, LINE_TIME_FORMAT)


def _second(ts: Column) -> Column:
    """Sort key of a line: its wall-clock second as fixed-width text (zone free)."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def _s(c) -> Column:
    return (c if isinstance(c, Column) else F.lit(c)).cast("string")


def _info(stamp: Column, component: str, *msg) -> Column:
    return F.concat(stamp, F.lit(f" INFO {component}: "), *[_s(m) for m in msg])


def _template(name: str, seq: int) -> Column:
    """The line that a template makes of an event: line_ts, seq, text; null if it makes none."""
    eid, uid, ts, v = F.col("event_id"), F.col("user_id"), F.col("ts"), F.col("value")
    now, second = F.col("now"), F.col("line_ts")
    applies = F.lit(True)
    if name == "base":
        level = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(lv))
                             for k, lv in EVENT_LEVELS.items()])
        other = F.element_at(F.array(*[F.lit(x) for x in SECOND_LEVELS]),
                             ((eid / 7).cast("bigint") % 4 + 1).cast("int"))
        line = F.concat(now, F.lit(" "), level, F.lit(" ev."), F.col("event_type"),
                        F.lit(": value = "), F.format_string("%.2f", v),
                        F.when(eid % 7 == 0, F.concat(F.lit(" "), other)).otherwise(F.lit("")))
        text = F.when(level.isNull(), F.lit(UNLEVELED_LINE)).otherwise(line)
    elif name == "executor_request":
        text = _info(now, "yarn.YarnAllocator", "Will request ", eid % 16 + 1,
                     " executor containers, each with 5 cores and 28160 MB memory",
                     F.when(eid % 2 == 0, F.lit(" including 2560 MB overhead")).otherwise(F.lit("")))
    elif name == "container_request":
        host = F.when(eid % 3 == 0, F.lit("Any")).otherwise(F.concat(F.lit("host-"), _s(eid % 4)))
        text = _info(now, "yarn.YarnAllocator", "Container request (host: ", host,
                     ", capability: <memory:28160, vCores:5>)")
    elif name in ("task_running", "task_finished"):
        task = F.concat(_s(eid % 97), F.lit("."), _s((eid / 10).cast("bigint") % 2),
                        F.lit(" in stage "), _s(eid % 7), F.lit(".0 (TID "), _s(eid), F.lit(")"))
        if name == "task_running":
            text = _info(now, "executor.Executor", "Running task ", task)
        else:
            applies = eid % 10 != 0
            when = ts + F.make_interval(secs=F.floor(v).cast("int"))
            second = _second(when)
            text = _info(_stamp(when), "executor.Executor", "Finished task ", task, ". ",
                         eid % 2000 + 1000, " bytes result sent to driver")
    elif name == "python_times":
        boot = F.when(eid % 2 == 1, -(eid % 50)).otherwise(eid % 50)
        init, fin = eid % 90, eid % 4
        text = _info(now, "python.PythonRunner", "Times: total = ", boot + init + fin,
                     ", boot = ", boot, ", init = ", init, ", finish = ", fin)
    elif name == "input_split":
        text = _info(now, "rdd.HadoopRDD", "Input split: hdfs://h:9000/f", uid % 3, ":",
                     (eid % 8) * 1048576, "+", eid % 1000 + 1)
    elif name == "memory_store":
        text = _info(now, "storage.MemoryStore", "MemoryStore started with capacity ",
                     F.format_string("%.1f", (eid % 8 + 1) * 0.5), " ",
                     F.when(eid % 2 == 0, F.lit("GB")).otherwise(F.lit("MB")))
    elif name == "block_stored":
        block = F.when(eid % 2 == 0, F.concat(F.lit("broadcast_"), _s(eid % 9))) \
            .otherwise(F.concat(F.lit("rdd_"), _s(uid % 7), F.lit("_"), _s(eid % 5)))
        text = _info(now, "storage.MemoryStore", "Block ", block, " stored as ",
                     F.when(eid % 3 == 0, F.lit("bytes")).otherwise(F.lit("values")),
                     " in memory (estimated size ", F.format_string("%.1f", (eid % 1000) / 10.0),
                     " ", F.when(eid % 2 == 0, F.lit("KB")).otherwise(F.lit("MB")),
                     ", free ", F.format_string("%.1f", uid % 500 + 0.5), " MB)")
    elif name == "error_trace":
        applies = F.col("event_type") == "error"
        text = F.concat(now, F.lit(" ERROR executor.Executor: Exception in task "), _s(eid),
                        F.lit("\n\tat org.apache.spark.scheduler.Task.run(Task.scala:"),
                        _s(eid % 100), F.lit(")"))
    elif name == "broadcast_read":
        text = _info(now, "broadcast.TorrentBroadcast", "Started reading broadcast variable ", eid % 9)
    else:
        raise ValueError(f"unknown template {name!r}")
    return F.when(applies, F.struct(second.alias("line_ts"), F.lit(seq).alias("seq"), text.alias("text")))


def event_log_lines(events: DataFrame, templates=BASE) -> DataFrame:
    """All rendered lines as rows: k (application), c (container), line_ts,
    event_id, seq, value. A row's value may hold a newline (two file lines)."""
    return _lines(_keys(events), templates)


def _lines(ev: DataFrame, templates) -> DataFrame:
    made = F.array(*[_template(name, seq) for seq, name in enumerate(YARN) if name in templates])
    lines = ev.select("k", "c", "event_id", F.explode(made).alias("_l")).where(F.col("_l").isNotNull())
    return lines.select("k", "c", "_l.line_ts", "event_id", "_l.seq", F.col("_l.text").alias("value"))


def _in_order(events: DataFrame, templates) -> DataFrame:
    """k, c and value of all lines, each container in one partition, lines ordered by (time,
    event, template). Events are shuffled, not their lines, and the partitions grow with them."""
    parts = max(events.sparkSession.sparkContext.defaultParallelism * 4, 8, -(-events.count() // EVENTS))
    lines = _lines(_keys(events).repartition(parts, "k", "c"), templates)
    return lines.sortWithinPartitions("k", "c", "line_ts", "event_id", "seq").select("k", "c", "value")


def write_event_logs(events: DataFrame, path: str, templates=BASE) -> str:
    """Write the rendered files under ``path``: one file per container,
    lines ordered by (time, event, template)."""
    # Tasks move their own files to their place: one after another on the driver takes longer than writing them.
    (_in_order(events, templates).write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
     .partitionBy("k", "c").text(path))
    return path


def write_packed_logs(events: DataFrame, path: str, templates=BASE) -> str:
    """Write the lines of ``write_event_logs`` with many containers in one compressed
    text file; each line follows the path of its container's folder and a tab."""
    folder = F.concat_ws("/", *[F.concat(F.lit(f"{n}="), F.coalesce(n, F.lit(NO_VALUE))) for n in ("k", "c")])
    one = F.explode(F.split(F.coalesce("value", F.lit("")), "\n"))  # a value may be several lines
    lines = _in_order(events, templates).select(folder.alias("_at"), one.alias("_line"))
    lines.select(F.concat("_at", F.lit("\t"), "_line")).write.mode("overwrite").option("compression", "lz4").text(path)
    return path


def unpacked(packed: DataFrame, root: str, positions: bool = False) -> DataFrame:
    """``value`` and ``file_path`` (and positions) of the lines of ``write_packed_logs``, as of container files below ``root``."""
    lines = with_lineage(packed, positions)
    tab = F.instr("value", "\t")
    return lines.withColumns({"file_path": F.concat(F.lit(f"{root}/"), F.substring(F.col("value"), F.lit(1), tab - 1), F.lit("/part.txt")),
                              "value": F.substring(F.col("value"), tab + 1, F.length("value"))})


_RENDERED: dict[tuple, str] = {}
_SOURCES: dict[tuple, DataFrame] = {}


def _listing(spark: SparkSession, sf_dir: str) -> str:
    """Path, size and time of the input files, through Spark's own file
    listing: a changed input is rendered anew."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(table_path(sf_dir, "events"))
    return str(sorted(map(tuple, files.select("path", "length", F.col("modificationTime").cast("string")).collect())))


def _root(spark: SparkSession, sf_dir: str, templates, kind: str, write) -> str:
    tag = f"{_listing(spark, sf_dir)}|{','.join(templates)}|{kind}"
    key = (spark.sparkContext.applicationId, tag)
    if key not in _RENDERED:
        path = scratch_path(spark, "rendered-logs", hashlib.sha1(tag.encode()).hexdigest()[:12])
        _RENDERED[key] = write(spark.read.parquet(table_path(sf_dir, "events")), path, templates)
    return _RENDERED[key]


def log_root(spark: SparkSession, sf_dir: str, templates=BASE) -> str:
    """The folder of the files rendered from ``<sf_dir>/events.parquet``, one per
    container, for queries about files; they are written when first asked for in a
    session, for an input and template set. They stay in the session's shared folder,
    for its owner to remove."""
    return _root(spark, sf_dir, templates, "files", write_event_logs)


def rendered_logs(spark: SparkSession, sf_dir: str, templates=BASE,
                  positions: bool = False) -> DataFrame:
    """The lines of the files of ``log_root`` as ``value, file_path``.

    They are read from packed files: a container holds some dozen events, so that
    writing, listing and opening a file for each would outweigh all work on the lines.
    The source DataFrame is reused within the session: the files are listed once, not
    once per query. No rows are cached.
    """
    path = _root(spark, sf_dir, templates, "packed", write_packed_logs)
    key = (path, id(spark))
    if key not in _SOURCES:
        _SOURCES[key] = spark.read.text(path)
    return unpacked(_SOURCES[key], path, positions)
