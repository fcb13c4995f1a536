"""Registered queries (Spark) and their oracles (DuckDB SQL).

Trip queries map the order-line table onto the trip columns:
``l_shipdate`` -> pickup time, ``l_quantity`` -> distance and passengers,
``l_tax`` -> tax, ``l_extendedprice`` -> fare, ``l_discount`` -> tip.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import sinks
from daybook.functions import parse
from daybook.operators import distribution, incremental, levels, overtime, sampling, trips, usage, yarn
from daybook.plans import rendered
from daybook.session import cut, rename, scratch_path, table_path
from daybook.sources import read_drifting_months, read_log_glob, read_manifest_logs, read_months
from daybook.sources import sql_count as count_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TRIP_YEAR = 1998
TRIP_COLUMNS = dict(ts="l_shipdate", distance="l_quantity", tax="l_tax",
                    fare="l_extendedprice", tip="l_discount", passengers="l_quantity")


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


# The report texts and column names in the oracles below.

# ---------------------------------------------------------------- trips

@register("daily_summary", f"""
SELECT CAST(year(l_shipdate) AS INTEGER) AS dt_year,
       CAST(month(l_shipdate) AS INTEGER) AS dt_month,
       CAST(day(l_shipdate) AS INTEGER) AS dt_day,
       count(*) AS num_trips,
       avg(l_quantity) AS mean_trip_distance,
       max(l_tax) AS max_mta_tax,
       quantile_disc(l_extendedprice, 0.95) AS q95_fare_amount,
       min(l_discount) AS min_tip_amount,
       CAST(ceil(avg(l_quantity)) AS BIGINT) AS mean_passenger_count
FROM lineitem
WHERE l_shipdate >= TIMESTAMP '{TRIP_YEAR}-01-01' AND l_shipdate < TIMESTAMP '{TRIP_YEAR + 1}-01-01'
GROUP BY 1, 2, 3
ORDER BY 1 DESC, 2 DESC, 3 DESC
""")
def daily_summary(spark, sf_dir):
    return trips.daily_summary(_table(spark, sf_dir, "lineitem"), TRIP_YEAR, **TRIP_COLUMNS)


@register("daily_summary_exact", f"""
SELECT CAST(year(l_shipdate) AS INTEGER) AS dt_year,
       CAST(month(l_shipdate) AS INTEGER) AS dt_month,
       CAST(day(l_shipdate) AS INTEGER) AS dt_day,
       count(*) AS num_trips,
       avg(l_quantity) AS mean_trip_distance,
       max(l_tax) AS max_mta_tax,
       quantile_disc(l_extendedprice, 0.95) AS q95_fare_amount,
       min(l_discount) AS min_tip_amount,
       CAST(ceil(avg(l_quantity)) AS BIGINT) AS mean_passenger_count
FROM lineitem
WHERE l_shipdate >= TIMESTAMP '{TRIP_YEAR}-01-01' AND l_shipdate < TIMESTAMP '{TRIP_YEAR + 1}-01-01'
GROUP BY 1, 2, 3
""")
def daily_summary_exact(spark, sf_dir):
    return trips.daily_summary(_table(spark, sf_dir, "lineitem"), TRIP_YEAR, exact=True,
                               newest_first=False, **TRIP_COLUMNS)


@register("daily_overall", f"""
WITH per_day AS (
  SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS n_all,
         count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '{TRIP_YEAR}-01-01'
                            AND l_shipdate < TIMESTAMP '{TRIP_YEAR + 1}-01-01') AS n_year
  FROM lineitem GROUP BY 1)
SELECT CAST(sum(n_all) AS BIGINT) AS total_rows,
       CAST(sum(n_year) AS BIGINT) AS rows_in_year,
       count(*) FILTER (WHERE n_year > 0) AS days_with_data,
       CAST(sum(n_year) AS BIGINT) AS total_trips,
       CAST(sum(n_year) AS DOUBLE) / count(*) FILTER (WHERE n_year > 0) AS mean_daily_trips,
       min(day) FILTER (WHERE n_year > 0) AS first_day,
       max(day) FILTER (WHERE n_year > 0) AS last_day
FROM per_day
""")
def daily_overall(spark, sf_dir):
    return trips.daily_overall(_table(spark, sf_dir, "lineitem"), TRIP_YEAR, ts="l_shipdate")


@register("fare_p95_by_year", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS dt_year,
       quantile_disc(l_extendedprice, 0.95) AS p_exact
FROM lineitem GROUP BY 1
""")
def fare_p95_by_year(spark, sf_dir):
    return trips.percentile_by_year(_table(spark, sf_dir, "lineitem"), "l_extendedprice", 0.95,
                                    ts="l_shipdate")


# ---------------------------------------------------------------- logs
#
# Log queries read text files rendered from `events` (daybook.plans.rendered):
# application = five users, container = event_id % 5 + 1, level by event type,
# one line per event in the base corpus. The oracle recomputes each result
# from the `events` columns.

SAMPLE_SEED = 7
SAMPLE_SIZE = 10
PATTERN = "ev.purchase: value"

_EV = """
ev AS (
  SELECT event_id, user_id, event_type, value, ts,
         date_trunc('second', ts) AS line_ts,
         CAST(1485248649253 + CASE WHEN user_id // 5 % 10 < 6 THEN 0 ELSE user_id // 5 % 10 - 5 END
              AS VARCHAR) AS cluster_id,
         printf('%04d', user_id // 5) AS app_number,
         lpad(CAST(event_id % 5 + 1 AS VARCHAR), 6, '0') AS container_number,
         CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARN'
                         WHEN 'click' THEN 'DEBUG' WHEN 'view' THEN 'INFO' END AS level,
         ['INFO', 'WARN', 'ERROR', 'DEBUG'][CAST((event_id // 7) % 4 AS INTEGER) + 1] AS second_level
  FROM events),
evk AS (
  SELECT *, 'application_' || cluster_id || '_' || app_number AS application_id,
         'container_' || cluster_id || '_' || app_number || '_01_' || container_number AS container_id
  FROM ev),
base AS (
  SELECT *,
         CASE WHEN level IS NULL THEN chr(9) || 'at frame'
              ELSE strftime(ts, '%y/%m/%d %H:%M:%S') || ' ' || level || ' ev.' || event_type
                   || ': value = ' || printf('%.2f', value)
                   || CASE WHEN event_id % 7 = 0 THEN ' ' || second_level ELSE '' END
         END AS line,
         row_number() OVER (PARTITION BY container_id ORDER BY line_ts, event_id) AS line_no
  FROM evk)"""


def _logs(spark, sf_dir, positions=False):
    return rendered.rendered_logs(spark, sf_dir, rendered.BASE, positions=positions)


def _round(df: DataFrame, cols, digits=6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


@register("log_level_counts", f"""
WITH {_EV}
SELECT level, count(*) AS count FROM base WHERE level IS NOT NULL GROUP BY level
""")
def log_level_counts(spark, sf_dir):
    return levels.level_counts(_logs(spark, sf_dir))


@register("log_level_summary", f"""
WITH {_EV},
per AS (SELECT level, count(*) AS count FROM base WHERE level IS NOT NULL GROUP BY level),
tot AS (SELECT count(*) AS total_lines, count(level) AS lines_with_level,
               count(DISTINCT level) AS unique_levels FROM base)
SELECT level, count, CAST(count AS DOUBLE) * 100.0::DOUBLE / lines_with_level AS pct,
       total_lines, lines_with_level, unique_levels
FROM per, tot
""")
def log_level_summary(spark, sf_dir):
    return levels.level_summary(_logs(spark, sf_dir))


@register("log_level_report", f"""
WITH {_EV},
per AS (SELECT level, count(*) AS count FROM base WHERE level IS NOT NULL GROUP BY level),
tot AS (SELECT count(*) AS total_lines, count(level) AS lines_with_level,
               count(DISTINCT level) AS unique_levels FROM base)
SELECT 1 AS line_no, 'Total log lines processed: ' || total_lines AS text FROM tot
UNION ALL SELECT 2, 'Total lines with log levels: ' || lines_with_level FROM tot
UNION ALL SELECT 3, 'Unique log levels found: ' || unique_levels FROM tot
UNION ALL SELECT 4, ''
UNION ALL SELECT 5, 'Log level distribution:'
UNION ALL
SELECT CAST(5 + row_number() OVER (ORDER BY count DESC, level) AS INTEGER),
       printf('  %-5s : %10d (%6.2f%%)', level, count,
              CAST(count AS DOUBLE) * 100.0::DOUBLE / lines_with_level)
FROM per, tot
""")
def log_level_report(spark, sf_dir):
    return levels.level_report(levels.level_summary(_logs(spark, sf_dir)))


@register("log_sample", f"""
WITH {_EV}
SELECT strftime(ts, '%y/%m/%d %H:%M:%S') AS timestamp, level, line AS message,
       container_id, line_no
FROM base WHERE level IS NOT NULL
ORDER BY md5('{SAMPLE_SEED}:' || container_id || ':' || line_no), container_id, line_no
LIMIT {SAMPLE_SIZE}
""")
def log_sample(spark, sf_dir):
    drawn = sampling.sample_lines(_logs(spark, sf_dir, positions=True), SAMPLE_SIZE, SAMPLE_SEED,
                                  parse.level() != "", parse.container_id("file_path"))
    return levels.with_level(drawn.withColumn("container_id", parse.container_id("file_path"))) \
        .select("timestamp", "level", "message", "container_id", "line_no")


@register("log_random_sample", f"""
WITH {_EV}, n AS (SELECT least(count(*), {SAMPLE_SIZE}) AS n FROM base WHERE level IS NOT NULL)
SELECT n AS drawn, n AS lines_of_the_logs FROM n
""")
def log_random_sample(spark, sf_dir):
    """T1 unseeded: which lines are drawn is up to chance, how many and from where isn't."""
    lines = levels.with_level(_logs(spark, sf_dir)).select("file_path", "message")
    drawn = cut(sampling.random_sample(lines, SAMPLE_SIZE))
    known = lines.join(F.broadcast(drawn.distinct()), ["file_path", "message"], "left_semi").distinct()  # SAMPLE_SIZE rows
    found = drawn.join(F.broadcast(known.withColumn("_known", F.lit(1))), ["file_path", "message"], "left")
    return found.agg(F.count(F.lit(1)).alias("drawn"), F.count("_known").alias("lines_of_the_logs"))


@register("component_counts", f"""
WITH {_EV}
SELECT CASE WHEN level IS NULL THEN '' ELSE 'ev.' || event_type END AS component,
       count(*) AS count
FROM base GROUP BY 1
""")
def component_counts(spark, sf_dir):
    return levels.component_counts(_logs(spark, sf_dir))


@register("severity_occurrences", f"""
WITH {_EV},
words AS (SELECT level FROM base WHERE level IS NOT NULL
          UNION ALL
          SELECT second_level FROM base WHERE level IS NOT NULL AND event_id % 7 = 0)
SELECT level, count(*) AS occurrences FROM words GROUP BY level
""")
def severity_occurrences(spark, sf_dir):
    return levels.severity_occurrences(_logs(spark, sf_dir))


@register("error_lines", f"""
WITH {_EV}
SELECT application_id, container_id, line AS value
FROM base WHERE contains(line, 'ERROR')
""")
def error_lines(spark, sf_dir):
    hits = levels.lines_containing(_logs(spark, sf_dir), "ERROR")
    return hits.select(parse.application_id("file_path").alias("application_id"),
                       parse.container_id("file_path").alias("container_id"), "value")


@register("pattern_lines", f"""
WITH {_EV}
SELECT container_id, line_no, line AS value
FROM base WHERE contains(line, '{PATTERN}')
ORDER BY container_id, line_no LIMIT 20
""")
def pattern_lines(spark, sf_dir):
    top = levels.first_lines_in(spark, rendered.log_root(spark, sf_dir, rendered.BASE), PATTERN, 20)
    return top.select(parse.container_id("file_path").alias("container_id"), "line_no", "value")


_TIMELINE = """
timeline AS (
  SELECT cluster_id, application_id, app_number,
         CAST(date_trunc('second', min(ts)) AS TIMESTAMP) AS start_time,
         CAST(date_trunc('second', max(ts)) AS TIMESTAMP) AS end_time
  FROM evk WHERE event_type <> 'signup'
  GROUP BY cluster_id, application_id, app_number),
summary AS (
  SELECT cluster_id, count(*) AS num_applications, min(start_time) AS cluster_first_app,
         max(end_time) AS cluster_last_app
  FROM timeline GROUP BY cluster_id)"""


def _timeline(spark, sf_dir):
    return usage.app_timeline(_logs(spark, sf_dir))


def _shared_timeline(spark, sf_dir):
    """The timeline (one row per application) materialised once in the
    session's checkpoint folder, for queries that read it several times
    (top cluster lookup, global bounds); the logs are then scanned once."""
    return cut(_timeline(spark, sf_dir))


def _shared_durations(spark, sf_dir):
    """The largest cluster's positive durations (one row per application),
    materialised once; the histogram and density read it several times
    (global bounds as scalar subqueries, then the rows)."""
    return cut(usage.largest_cluster_durations(_shared_timeline(spark, sf_dir)))


@register("app_timeline", f"WITH {_EV}, {_TIMELINE} SELECT * FROM timeline")
def app_timeline(spark, sf_dir):
    return _timeline(spark, sf_dir)


@register("cluster_summary", f"WITH {_EV}, {_TIMELINE} SELECT * FROM summary")
def cluster_summary(spark, sf_dir):
    return usage.cluster_summary(_timeline(spark, sf_dir))


@register("cluster_stats", f"""
WITH {_EV}, {_TIMELINE}
SELECT count(*) AS total_clusters, CAST(sum(num_applications) AS BIGINT) AS total_applications,
       CAST(sum(num_applications) AS DOUBLE) / count(*) AS avg_apps_per_cluster
FROM summary
""")
def cluster_stats(spark, sf_dir):
    return usage.cluster_stats(usage.cluster_summary(_timeline(spark, sf_dir)))


@register("cluster_ranking", f"""
WITH {_EV}, {_TIMELINE}
SELECT * FROM summary ORDER BY num_applications DESC, cluster_id
""")
def cluster_ranking(spark, sf_dir):
    return usage.cluster_ranking(usage.cluster_summary(_timeline(spark, sf_dir)))


@register("cluster_stats_report", f"""
WITH {_EV}, {_TIMELINE},
st AS (SELECT count(*) AS c, sum(num_applications) AS a FROM summary)
SELECT 1 AS line_no, 'Total unique clusters: ' || c AS text FROM st
UNION ALL SELECT 2, 'Total applications: ' || a FROM st
UNION ALL SELECT 3, printf('Average applications per cluster: %.2f', CAST(a AS DOUBLE) / c) FROM st
UNION ALL SELECT 4, ''
UNION ALL SELECT 5, 'Most heavily used clusters:'
UNION ALL
SELECT CAST(5 + row_number() OVER (ORDER BY num_applications DESC, cluster_id) AS INTEGER),
       printf('  Cluster %s: %d applications', cluster_id, num_applications)
FROM summary
""")
def cluster_stats_report(spark, sf_dir):
    return usage.cluster_stats_report(cut(usage.cluster_summary(_timeline(spark, sf_dir))))


_DURATIONS = """
top AS (SELECT cluster_id FROM summary ORDER BY num_applications DESC, cluster_id LIMIT 1),
durations AS (
  SELECT t.*, CAST(date_diff('second', start_time, end_time) AS DOUBLE) AS duration_sec
  FROM timeline t WHERE cluster_id IN (SELECT cluster_id FROM top)
    AND date_diff('second', start_time, end_time) > 0),
lx AS (SELECT log10(duration_sec) AS x FROM durations),
b AS (SELECT min(x) AS lo0, max(x) AS hi0, count(*) AS n, stddev_samp(x) AS sd FROM lx),
e AS (SELECT *, CASE WHEN hi0 > lo0 THEN lo0 ELSE lo0 - 0.5 END AS first_edge,
                CASE WHEN hi0 > lo0 THEN hi0 ELSE hi0 + 0.5 END AS last_edge FROM b)"""


@register("largest_cluster_durations", f"WITH {_EV}, {_TIMELINE}, {_DURATIONS} SELECT * FROM durations")
def largest_cluster_durations(spark, sf_dir):
    return usage.largest_cluster_durations(_shared_timeline(spark, sf_dir))


@register("duration_histogram", f"""
WITH {_EV}, {_TIMELINE}, {_DURATIONS},
binned AS (
  SELECT CAST(least(29, floor((x - first_edge) / (last_edge - first_edge) * 30)) AS INTEGER) AS bin,
         count(*) AS cnt
  FROM lx, e GROUP BY 1),
axis AS (SELECT CAST(range AS INTEGER) AS bin FROM range(30))
SELECT axis.bin,
       round(first_edge + axis.bin * (last_edge - first_edge) / 30, 6) AS log_lo,
       round(first_edge + (axis.bin + 1) * (last_edge - first_edge) / 30, 6) AS log_hi,
       round(pow(10, first_edge + axis.bin * (last_edge - first_edge) / 30), 6) AS lo,
       round(pow(10, first_edge + (axis.bin + 1) * (last_edge - first_edge) / 30), 6) AS hi,
       coalesce(cnt, 0) AS count, n
FROM axis CROSS JOIN e LEFT JOIN binned ON binned.bin = axis.bin
""")
def duration_histogram(spark, sf_dir):
    h = distribution.log_histogram(_shared_durations(spark, sf_dir))
    return _round(h, ["log_lo", "log_hi", "lo", "hi"])


@register("duration_density", f"""
WITH {_EV}, {_TIMELINE}, {_DURATIONS},
g AS (SELECT CAST(range AS INTEGER) AS i FROM range(200)),
pts AS (SELECT i, lo0 + i * (hi0 - lo0) / 199 AS gx, n, sd * pow(n, -0.2) AS h,
               (last_edge - first_edge) / 30 AS bw FROM g, e),
s AS (SELECT i, gx, n, h, bw, sum(exp(-0.5 * ((gx - x) / h) * ((gx - x) / h))) AS sm
      FROM pts, lx GROUP BY i, gx, n, h, bw)
SELECT i AS grid_index, round(gx, 6) AS log_x, round(pow(10, gx), 6) AS x,
       round(sm / (n * h * sqrt(2 * pi())), 6) AS density,
       round(sm / (n * h * sqrt(2 * pi())) * n * bw, 6) AS scaled_count
FROM s
""")
def duration_density(spark, sf_dir):
    d = distribution.log_density(_shared_durations(spark, sf_dir))
    return _round(d, ["log_x", "x", "density", "scaled_count"])


@register("file_inventory", f"""
WITH {_EV}
SELECT count(DISTINCT application_id) AS applications, count(DISTINCT container_id) AS files,
       count(*) AS lines
FROM evk
""")
def file_inventory(spark, sf_dir):
    return usage.file_inventory(_logs(spark, sf_dir))


@register("files_per_app", f"""
WITH {_EV}
SELECT application_id, count(DISTINCT container_id) AS files, count(*) AS lines
FROM evk GROUP BY application_id
""")
def files_per_app(spark, sf_dir):
    return usage.files_per_app(_logs(spark, sf_dir))


@register("container_files", f"""
WITH {_EV}
SELECT application_id, container_id, '01' AS attempt, container_number,
       CASE WHEN container_number = '000001' THEN 'application_master' ELSE 'executor' END AS role,
       count(*) AS lines,
       CAST(min(line_ts) FILTER (WHERE level IS NOT NULL) AS TIMESTAMP) AS first_time,
       CAST(max(line_ts) FILTER (WHERE level IS NOT NULL) AS TIMESTAMP) AS last_time,
       CAST(date_diff('second', min(line_ts) FILTER (WHERE level IS NOT NULL),
                      max(line_ts) FILTER (WHERE level IS NOT NULL)) AS DOUBLE) AS span_sec
FROM evk GROUP BY application_id, container_id, container_number
""")
def container_files(spark, sf_dir):
    return usage.files(_logs(spark, sf_dir)).drop("file_path")


@register("containers_by_role", f"""
WITH {_EV},
f AS (SELECT application_id, container_id, container_number, count(*) AS lines
      FROM evk GROUP BY ALL)
SELECT application_id,
       count(*) FILTER (WHERE container_number = '000001') AS am_containers,
       count(*) FILTER (WHERE container_number <> '000001') AS executor_containers,
       CAST(coalesce(sum(lines) FILTER (WHERE container_number = '000001'), 0) AS BIGINT) AS am_lines,
       CAST(coalesce(sum(lines) FILTER (WHERE container_number <> '000001'), 0) AS BIGINT) AS executor_lines
FROM f GROUP BY application_id
""")
def containers_by_role(spark, sf_dir):
    return usage.containers_by_role(usage.files(_logs(spark, sf_dir)))


# ---------------------------------------------------------------- smoke / SQL text

@register("even_keys_doubled", """
SELECT o_orderkey * 2 AS doubled_key FROM orders WHERE o_orderkey % 2 = 0
""")
def even_keys_doubled(spark, sf_dir):
    o = _table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderkey") % 2 == 0).select((F.col("o_orderkey") * 2).alias("doubled_key"))


@register("sql_count", "SELECT COUNT(*) AS total FROM orders")
def sql_count(spark, sf_dir):
    return count_sql(spark, _table(spark, sf_dir, "orders"))


# ---------------------------------------------------------------- YARN log analyses
#
# The YARN corpus adds one line per event for each message template (executor
# and container requests, task start and finish, Python times, input split,
# memory store, stored block, broadcast read) and, for error events, an entry
# with a continuation line. Template values are functions of event columns.


def _yarn_logs(spark, sf_dir, positions=False):
    return rendered.rendered_logs(spark, sf_dir, rendered.YARN, positions=positions)


_STAMP = "strftime({}, '%y/%m/%d %H:%M:%S')"
_TASK_TEXT = "(event_id % 97) || '.' || ((event_id // 10) % 2) || ' in stage ' || (event_id % 7) || '.0 (TID ' || event_id || ')'"
_NOW = _STAMP.format("ts")
_LATER = _STAMP.format("ts + to_seconds(CAST(floor(value) AS BIGINT))")
_ONE_LINERS = f"""
    (1, {_NOW} || ' INFO yarn.YarnAllocator: Will request ' || (event_id % 16 + 1) || ' executor containers, each with 5 cores and 28160 MB memory'
        || CASE WHEN event_id % 2 = 0 THEN ' including 2560 MB overhead' ELSE '' END),
    (2, {_NOW} || ' INFO yarn.YarnAllocator: Container request (host: ' || CASE WHEN event_id % 3 = 0 THEN 'Any' ELSE 'host-' || (event_id % 4) END
        || ', capability: <memory:28160, vCores:5>)'),
    (3, {_NOW} || ' INFO executor.Executor: Running task ' || {_TASK_TEXT}),
    (5, {_NOW} || ' INFO python.PythonRunner: Times: total = '
        || (CASE WHEN event_id % 2 = 1 THEN -(event_id % 50) ELSE event_id % 50 END + event_id % 90 + event_id % 4)
        || ', boot = ' || CASE WHEN event_id % 2 = 1 THEN -(event_id % 50) ELSE event_id % 50 END
        || ', init = ' || (event_id % 90) || ', finish = ' || (event_id % 4)),
    (6, {_NOW} || ' INFO rdd.HadoopRDD: Input split: hdfs://h:9000/f' || (user_id % 3) || ':' || ((event_id % 8) * 1048576) || '+' || (event_id % 1000 + 1)),
    (7, {_NOW} || ' INFO storage.MemoryStore: MemoryStore started with capacity ' || printf('%.1f', (event_id % 8 + 1) * 0.5::DOUBLE) || ' '
        || CASE WHEN event_id % 2 = 0 THEN 'GB' ELSE 'MB' END),
    (8, {_NOW} || ' INFO storage.MemoryStore: Block '
        || CASE WHEN event_id % 2 = 0 THEN 'broadcast_' || (event_id % 9) ELSE 'rdd_' || (user_id % 7) || '_' || (event_id % 5) END || ' stored as '
        || CASE WHEN event_id % 3 = 0 THEN 'bytes' ELSE 'values' END || ' in memory (estimated size '
        || printf('%.1f', CAST(event_id % 1000 AS DOUBLE) / 10.0::DOUBLE) || ' ' || CASE WHEN event_id % 2 = 0 THEN 'KB' ELSE 'MB' END
        || ', free ' || printf('%.1f', CAST(user_id % 500 AS DOUBLE) + 0.5::DOUBLE) || ' MB)'),
    (10, {_NOW} || ' INFO broadcast.TorrentBroadcast: Started reading broadcast variable ' || (event_id % 9))"""

_YLINES = f"""
ylines AS (
  SELECT container_id, application_id, line_ts, event_id, 0 AS seq, 0 AS sub,
         level IS NOT NULL AS has_ts, level AS lvl, line AS text FROM base
  UNION ALL
  SELECT container_id, application_id, line_ts, event_id, s.seq, 0, true, 'INFO', s.text
  FROM evk, LATERAL (VALUES {_ONE_LINERS}) s(seq, text)
  UNION ALL
  SELECT container_id, application_id, line_ts + to_seconds(CAST(floor(value) AS BIGINT)),
         event_id, 4, 0, true, 'INFO',
         {_LATER} || ' INFO executor.Executor: Finished task ' || {_TASK_TEXT} || '. ' || (event_id % 2000 + 1000) || ' bytes result sent to driver'
  FROM evk WHERE event_id % 10 <> 0
  UNION ALL
  SELECT container_id, application_id, line_ts, event_id, 9, 0, true, 'ERROR',
         {_NOW} || ' ERROR executor.Executor: Exception in task ' || event_id
  FROM evk WHERE event_type = 'error'
  UNION ALL
  SELECT container_id, application_id, line_ts, event_id, 9, 1, false, NULL,
         chr(9) || 'at org.apache.spark.scheduler.Task.run(Task.scala:' || (event_id % 100) || ')'
  FROM evk WHERE event_type = 'error'),
ynum AS (
  SELECT *,
         row_number() OVER (PARTITION BY container_id ORDER BY line_ts, event_id, seq, sub) AS line_no,
         sum(CAST(has_ts AS INTEGER)) OVER (PARTITION BY container_id
             ORDER BY line_ts, event_id, seq, sub
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS entry_no
  FROM ylines)"""

_TASKS = """
tasks AS (
  SELECT application_id, container_id, CAST(event_id % 7 AS BIGINT) AS stage,
         CAST(0 AS BIGINT) AS stage_attempt, CAST(event_id % 97 AS BIGINT) AS task,
         CAST((event_id // 10) % 2 AS BIGINT) AS task_attempt, event_id AS tid,
         CAST(line_ts AS TIMESTAMP) AS start_time,
         CASE WHEN event_id % 10 <> 0
              THEN CAST(line_ts + to_seconds(CAST(floor(value) AS BIGINT)) AS TIMESTAMP) END AS finish_time,
         CASE WHEN event_id % 10 <> 0 THEN event_id % 2000 + 1000 END AS result_bytes,
         CASE WHEN event_id % 10 <> 0 THEN CAST(floor(value) AS DOUBLE) END AS duration_sec
  FROM evk)"""


@register("executor_requests", f"""
WITH {_EV}
SELECT application_id, count(*) AS requests,
       CAST(sum(event_id % 16 + 1) AS BIGINT) AS executors_requested,
       CAST(sum((event_id % 16 + 1) * 5) AS BIGINT) AS cores_requested,
       CAST(sum((event_id % 16 + 1) * 28160) AS BIGINT) AS memory_mb_requested,
       count(*) FILTER (WHERE event_id % 2 = 0) AS requests_with_overhead,
       CAST(coalesce(sum((event_id % 16 + 1) * 2560) FILTER (WHERE event_id % 2 = 0), 0) AS BIGINT)
         AS overhead_mb_requested,
       CAST(5 AS BIGINT) AS max_cores, CAST(28160 AS BIGINT) AS max_memory_mb
FROM evk GROUP BY application_id
""")
def executor_requests(spark, sf_dir):
    return yarn.executor_requests(_yarn_logs(spark, sf_dir))


@register("container_requests", f"""
WITH {_EV}
SELECT CASE WHEN event_id % 3 = 0 THEN 'Any' ELSE 'host-' || (event_id % 4) END AS host,
       CAST(28160 AS BIGINT) AS memory_mb, CAST(5 AS BIGINT) AS vcores,
       count(*) AS requests, count(DISTINCT application_id) AS applications
FROM evk GROUP BY 1
""")
def container_requests(spark, sf_dir):
    return yarn.container_requests(_yarn_logs(spark, sf_dir))


@register("task_attempts", f"WITH {_EV}, {_TASKS} SELECT * FROM tasks")
def task_attempts(spark, sf_dir):
    return yarn.task_attempts(_yarn_logs(spark, sf_dir))


@register("task_avg_by_app", f"""
WITH {_EV}, {_TASKS}
SELECT application_id, count(*) AS attempts, count(finish_time) AS finished,
       count(*) - count(finish_time) AS unfinished,
       avg(duration_sec) AS avg_task_sec, max(duration_sec) AS max_task_sec,
       CAST(coalesce(sum(result_bytes), 0) AS BIGINT) AS result_bytes
FROM tasks GROUP BY application_id
""")
def task_avg_by_app(spark, sf_dir):
    return yarn.task_summary_by_app(yarn.task_attempts(_yarn_logs(spark, sf_dir)))


@register("stage_skew", f"""
WITH {_EV}, {_TASKS},
fin AS (SELECT * FROM tasks WHERE duration_sec IS NOT NULL),
med AS (SELECT application_id, stage, count(*) AS tasks,
               quantile_disc(duration_sec, 0.5) AS median_sec, max(duration_sec) AS max_sec
        FROM fin GROUP BY application_id, stage)
SELECT m.application_id, m.stage, m.tasks, m.median_sec, m.max_sec,
       CASE WHEN m.median_sec > 0 THEN m.max_sec / m.median_sec END AS max_over_median,
       count(*) FILTER (WHERE f.duration_sec > 1.5 * m.median_sec) AS stragglers
FROM med m JOIN fin f ON f.application_id = m.application_id AND f.stage = m.stage
GROUP BY ALL
""")
def stage_skew(spark, sf_dir):
    return yarn.stage_skew(yarn.task_attempts(_yarn_logs(spark, sf_dir)))


_PY = """
py AS (
  SELECT application_id,
         CASE WHEN event_id % 2 = 1 THEN -(event_id % 50) ELSE event_id % 50 END AS boot,
         event_id % 90 AS init, event_id % 4 AS fin
  FROM evk)"""


@register("python_times", f"""
WITH {_EV}, {_PY}
SELECT application_id, count(*) AS runs,
       avg(boot + init + fin) AS avg_total_ms, CAST(max(boot + init + fin) AS BIGINT) AS max_total_ms,
       avg(boot) AS avg_boot_ms, CAST(min(boot) AS BIGINT) AS min_boot_ms,
       count(*) FILTER (WHERE boot < 0) AS negative_boot_runs,
       avg(init) AS avg_init_ms, avg(fin) AS avg_finish_ms
FROM py GROUP BY application_id
""")
def python_times(spark, sf_dir):
    return yarn.python_times(_yarn_logs(spark, sf_dir))


@register("input_splits", f"""
WITH {_EV}
SELECT 'hdfs://h:9000/f' || (user_id % 3) AS source, count(*) AS splits,
       CAST(sum(event_id % 1000 + 1) AS BIGINT) AS bytes,
       CAST(max((event_id % 8) * 1048576 + event_id % 1000 + 1) AS BIGINT) AS max_end,
       count(DISTINCT application_id) AS applications
FROM evk GROUP BY 1
""")
def input_splits(spark, sf_dir):
    return yarn.input_splits(_yarn_logs(spark, sf_dir))


@register("memory_usage", f"""
WITH {_EV},
m AS (
  SELECT application_id,
         (event_id % 8 + 1) * 0.5::DOUBLE * CASE WHEN event_id % 2 = 0 THEN 1024.0::DOUBLE ELSE 1.0::DOUBLE END
           AS capacity_mb,
         event_id % 3 = 0 AS as_bytes,
         CAST(event_id % 1000 AS DOUBLE) / 10.0::DOUBLE
           * CASE WHEN event_id % 2 = 0 THEN 1.0::DOUBLE ELSE 1024.0::DOUBLE END AS size_kb,
         CAST(user_id % 500 AS DOUBLE) + 0.5::DOUBLE AS free_mb
  FROM evk)
SELECT application_id, count(*) AS stores_started, max(capacity_mb) AS max_capacity_mb,
       count(*) AS blocks, count(*) FILTER (WHERE as_bytes) AS blocks_as_bytes,
       round(sum(size_kb), 6) AS block_kb, max(size_kb) AS max_block_kb, min(free_mb) AS min_free_mb
FROM m GROUP BY application_id
""")
def memory_usage(spark, sf_dir):
    return _round(yarn.memory_usage(_yarn_logs(spark, sf_dir)), ["block_kb"])


@register("failure_rates", f"""
WITH {_EV}, {_YLINES},
per AS (SELECT application_id, container_id, count(*) AS lines,
               count(*) FILTER (WHERE lvl = 'ERROR') AS error_lines
        FROM ylines GROUP BY application_id, container_id),
unf AS (SELECT container_id, count(*) FILTER (WHERE event_id % 10 = 0) AS unfinished_attempts
        FROM evk GROUP BY container_id)
SELECT per.application_id, per.container_id, lines, error_lines,
       CAST(error_lines AS DOUBLE) / lines AS error_rate, unfinished_attempts
FROM per JOIN unf USING (container_id)
""")
def failure_rates(spark, sf_dir):
    return yarn.failure_rates(_yarn_logs(spark, sf_dir))


@register("broadcast_reads", f"""
WITH {_EV}
SELECT application_id, count(*) AS reads, count(DISTINCT event_id % 9) AS distinct_variables
FROM evk GROUP BY application_id
""")
def broadcast_reads(spark, sf_dir):
    return yarn.broadcast_reads(_yarn_logs(spark, sf_dir))


# ---------------------------------------------------------------- use over time

def _use_sql(keys, source, start, end):
    """Intervals, peak and busy seconds by a sweep over every point, in one window per key."""
    return f"""
iv AS (SELECT {keys}, {start} AS s, {end} AS e FROM {source}),
pt AS (SELECT {keys}, t, sum(step) AS step FROM (
         SELECT {keys}, s AS t, 1 AS step FROM iv UNION ALL SELECT {keys}, greatest(s, e), -1 FROM iv WHERE e IS NOT NULL) GROUP BY ALL),
sw AS (SELECT {keys}, t, sum(step) OVER (PARTITION BY {keys} ORDER BY t) AS now, lead(t) OVER (PARTITION BY {keys} ORDER BY t) AS nxt FROM pt),
at_once AS (SELECT {keys}, CAST(max(now) AS BIGINT) AS peak, CAST(arg_min(t, (-now, t)) AS TIMESTAMP) AS peak_time,
              CAST(coalesce(sum(date_diff('second', t, nxt)) FILTER (WHERE now > 0), 0) AS BIGINT) AS busy_sec FROM sw GROUP BY {keys}),
sized AS (SELECT {keys}, count(*) AS intervals, count(*) FILTER (WHERE e IS NULL) AS open_intervals FROM iv GROUP BY {keys})"""


@register("running_tasks", f"""
WITH {_EV}, {_TASKS}, {_use_sql("application_id", "tasks", "start_time", "finish_time")}
SELECT application_id, intervals AS attempts, open_intervals AS unfinished, peak AS peak_tasks, peak_time, busy_sec
FROM sized JOIN at_once USING (application_id)
""")
def running_tasks(spark, sf_dir):
    """D3: tasks of an application that run at once."""
    use = overtime.concurrency(yarn.task_attempts(_yarn_logs(spark, sf_dir)), ["application_id"])
    return use.select("application_id", F.col("intervals").alias("attempts"), F.col("open_intervals").alias("unfinished"),
                      F.col("peak").alias("peak_tasks"), "peak_time", "busy_sec")


@register("running_containers", f"""
WITH {_EV}, {_YLINES},
spans AS (SELECT application_id, container_id, CAST(min(line_ts) FILTER (WHERE has_ts) AS TIMESTAMP) AS a, CAST(max(line_ts) FILTER (WHERE has_ts) AS TIMESTAMP) AS b
          FROM ylines GROUP BY ALL), {_use_sql("application_id", "spans", "a", "b")}
SELECT application_id, intervals AS containers, peak AS peak_containers, peak_time, busy_sec
FROM sized JOIN at_once USING (application_id)
""")
def running_containers(spark, sf_dir):
    """Containers of an application that are alive at once, from their first line to their last."""
    use = overtime.concurrency(usage.files(_yarn_logs(spark, sf_dir)), ["application_id"], "first_time", "last_time")
    return use.select("application_id", F.col("intervals").alias("containers"), F.col("peak").alias("peak_containers"), "peak_time", "busy_sec")


@register("cluster_use", f"""
WITH {_EV}, {_TIMELINE}, {_use_sql("cluster_id", "timeline", "start_time", "end_time")},
st AS (SELECT cluster_id, s, max(greatest(s, e)) AS e FROM iv GROUP BY ALL),
seen AS (SELECT *, max(e) OVER (PARTITION BY cluster_id ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM st),
gp AS (SELECT cluster_id, CASE WHEN s > before THEN date_diff('second', before, s) END AS gap FROM seen)
SELECT cluster_id, intervals AS applications, peak AS peak_applications, peak_time, busy_sec, gaps, gap_sec, longest_gap_sec
FROM sized JOIN at_once USING (cluster_id)
JOIN (SELECT cluster_id, count(gap) AS gaps, CAST(coalesce(sum(gap), 0) AS BIGINT) AS gap_sec, coalesce(max(gap), 0) AS longest_gap_sec FROM gp GROUP BY cluster_id)
  USING (cluster_id)
""")
def cluster_use(spark, sf_dir):
    """Applications of a cluster at once, its busy time and gaps."""
    return overtime.cluster_use(_shared_timeline(spark, sf_dir))


@register("task_retries", f"""
WITH {_EV}, {_TASKS},
ch AS (SELECT *, lead(start_time) OVER w AS nxt, count(*) OVER (PARTITION BY application_id, stage, stage_attempt, task) AS n
       FROM tasks WINDOW w AS (PARTITION BY application_id, stage, stage_attempt, task ORDER BY start_time, tid)),
per AS (SELECT application_id, stage, stage_attempt, task, count(*) AS n, bool_or(nxt IS NULL AND finish_time IS NOT NULL) AS done,
          sum(CASE WHEN nxt IS NULL THEN 0 WHEN finish_time IS NOT NULL THEN duration_sec ELSE date_diff('second', start_time, nxt) END) AS lost
        FROM ch GROUP BY ALL)
SELECT application_id, stage, count(*) AS chains, count(*) FILTER (WHERE n > 1) AS retried_chains, max(n) AS longest_chain,
       CAST(sum(n - 1) AS BIGINT) AS superseded_attempts, CAST(sum(lost) AS DOUBLE) AS lost_sec,
       count(*) FILTER (WHERE done) AS finished_chains, count(*) FILTER (WHERE NOT done) AS unfinished_chains
FROM per GROUP BY application_id, stage
""")
def task_retries(spark, sf_dir):
    """Attempts at the same task and what was lost on them."""
    return overtime.retries(yarn.task_attempts(_yarn_logs(spark, sf_dir)))


@register("memory_over_time", f"""
WITH {_EV}, {_YLINES},
m AS (SELECT e.application_id, e.container_id, y.seq, y.line_no, CAST(y.line_ts AS TIMESTAMP) AS ts,
        CASE WHEN y.seq = 7 THEN (e.event_id % 8 + 1) * 0.5::DOUBLE * CASE WHEN e.event_id % 2 = 0 THEN 1024.0::DOUBLE ELSE 1.0::DOUBLE END END AS cap,
        CAST(e.user_id % 500 AS DOUBLE) + 0.5::DOUBLE AS free
      FROM ynum y JOIN evk e USING (event_id) WHERE y.seq IN (7, 8)),
k AS (SELECT *, last_value(cap IGNORE NULLS) OVER (PARTITION BY container_id ORDER BY line_no) AS c FROM m),
b AS (SELECT *, greatest(0.0::DOUBLE, 1.0::DOUBLE - free / c) AS share FROM k WHERE seq = 8)
SELECT application_id, container_id, count(*) AS blocks, count(*) FILTER (WHERE c IS NULL) AS unmatched_blocks, max(share) AS peak_share,
       arg_min(ts, (-share, ts, c, free)) AS peak_time, arg_min(c, (-share, ts, c, free)) AS capacity_mb, arg_min(free, (-share, ts, c, free)) AS free_mb
FROM b GROUP BY application_id, container_id
""")
def memory_over_time(spark, sf_dir):
    """Blocks against the capacity of the store they went to."""
    return overtime.memory_over_time(_yarn_logs(spark, sf_dir, positions=True))


@register("stage_overlaps", f"""
WITH {_EV}, {_TASKS},
sp AS (SELECT application_id, stage, min(start_time) AS a, max(greatest(start_time, finish_time)) AS b FROM tasks GROUP BY ALL)
SELECT x.application_id, x.stage AS stage_a, y.stage AS stage_b, date_diff('second', greatest(x.a, y.a), least(x.b, y.b)) AS overlap_sec
FROM sp x JOIN sp y ON x.application_id = y.application_id AND x.stage < y.stage AND date_diff('second', greatest(x.a, y.a), least(x.b, y.b)) > 0
""")
def stage_overlaps(spark, sf_dir):
    """Stages of an application side by side."""
    return overtime.stage_overlaps(yarn.task_attempts(_yarn_logs(spark, sf_dir)))


@register("stitched_entries", f"""
WITH {_EV}, {_YLINES},
placed AS (
  SELECT *, row_number() OVER (PARTITION BY container_id, entry_no ORDER BY line_no) - 1 AS nth FROM ynum)
SELECT container_id, CAST(entry_no AS BIGINT) AS entry_no,
       CAST(nth // CASE WHEN entry_no = 0 THEN 1 ELSE {yarn.ENTRY_LINES} END AS BIGINT) AS part, min(line_no) AS first_line_no,
       count(*) AS n_lines, string_agg(text, chr(10) ORDER BY line_no) AS text
FROM placed GROUP BY 1, 2, 3
""")
def stitched_entries(spark, sf_dir):
    entries = yarn.stitch_entries(_yarn_logs(spark, sf_dir, positions=True))
    return entries.select(parse.container_id("file_path").alias("container_id"),
                          "entry_no", "part", "first_line_no", "n_lines", "text")


# ---------------------------------------------------------------- sources and sinks end to end
#
# These write files into the session's shared folder while the query is
# built, then read them the way a user would.


def _new_path(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register("manifest_level_counts", ORACLES["log_level_counts"])
def manifest_level_counts(spark, sf_dir):
    """The log files listed in a manifest of keys below their root."""
    root = rendered.log_root(spark, sf_dir, rendered.BASE)
    manifest = _new_path(spark, "manifest")
    incremental.listing(spark, root).select(F.regexp_extract("file", r"(k=[^/]+/c=[^/]+/[^/]+)$", 1)).write.text(manifest)
    return levels.level_counts(read_manifest_logs(spark, manifest, root))


@register("glob_level_counts", ORACLES["log_level_counts"])
def glob_level_counts(spark, sf_dir):
    """S3: the log files that a glob matches."""
    root = rendered.log_root(spark, sf_dir, rendered.BASE)
    return levels.level_counts(read_log_glob(spark, f"{root}/k=application_*/c=*/*.txt"))


@register("months_daily_summary", ORACLES["daily_summary"])
def months_daily_summary(spark, sf_dir):
    """Month files of one year below ``yyyy=<year>``, read as one table."""
    root = _month_files(spark, _table(spark, sf_dir, "lineitem"), range(1, 13), _new_path(spark, "trips"))
    return trips.daily_summary(read_months(spark, root, TRIP_YEAR, range(1, 13)), TRIP_YEAR, **TRIP_COLUMNS)


def _month_files(spark, rows, months, root):
    """Files named as the trip data's, written in one pass over the table: one folder by month, which then gets its name."""
    at = F.col("l_shipdate")
    inside = (at >= F.lit(f"{TRIP_YEAR}-01-01").cast("timestamp_ntz")) & (at < F.lit(f"{TRIP_YEAR + 1}-01-01").cast("timestamp_ntz"))
    some = rows.where(inside).withColumns({"yyyy": F.lit(TRIP_YEAR), "m": F.month(at)}).where(F.col("m").isin(list(months)))
    some.write.mode("append").partitionBy("yyyy", "m").parquet(root)
    for m in months:
        rename(spark, f"{root}/yyyy={TRIP_YEAR}/m={m}", f"{root}/yyyy={TRIP_YEAR}/yellow_tripdata_{TRIP_YEAR}-{m:02d}.parquet")
    return root


@register("drifting_months_daily_summary", ORACLES["daily_summary"])
def drifting_months_daily_summary(spark, sf_dir):
    """Month files of two schemas. From April on the quantity is an integer, the
    tax column is spelled in capitals and stands last, there is a column of fees,
    and the line number is wider."""
    rows = _table(spark, sf_dir, "lineitem").withColumn("l_linenumber", F.col("l_linenumber").cast("int"))
    root = _month_files(spark, rows, range(1, 4), _new_path(spark, "drifting"))
    later = rows.select(*[c for c in rows.columns if c != "l_tax"], F.col("l_tax").alias("L_TAX")).withColumns({
        "l_quantity": F.col("l_quantity").cast("int"), "l_linenumber": F.col("l_linenumber").cast("bigint"), "airport_fee": F.lit(1.25)})
    _month_files(spark, later, range(4, 13), root)
    return trips.daily_summary(read_drifting_months(spark, root, TRIP_YEAR, range(1, 13)), TRIP_YEAR, **TRIP_COLUMNS)


@register("refreshed_level_counts", ORACLES["log_level_counts"])
def refreshed_level_counts(spark, sf_dir):
    """The level counts after a first run over some containers and a second over all."""
    root, store = rendered.log_root(spark, sf_dir, rendered.BASE), _new_path(spark, "partials")
    incremental.level_counts(spark, f"{root}/k=application_*/c=*_00000[12]", store)
    return incremental.level_counts(spark, root, store)[0]


@register("refreshed_timeline", f"""
WITH {_EV}, {_TIMELINE},
n AS (SELECT count(DISTINCT container_id) FILTER (WHERE container_number IN ('000001', '000002')) AS first_run,
             count(DISTINCT container_id) FILTER (WHERE container_number NOT IN ('000001', '000002')) AS second_run FROM evk)
SELECT timeline.*, first_run, second_run, 0 AS third_run FROM timeline, n
""")
def refreshed_timeline(spark, sf_dir):
    """The timeline after three runs, the last over nothing new, with the files that each one read."""
    root, store = rendered.log_root(spark, sf_dir, rendered.BASE), _new_path(spark, "partials")
    _, first = incremental.app_timeline(spark, f"{root}/k=application_*/c=*_00000[12]", store)
    _, second = incremental.app_timeline(spark, root, store)
    rows, third = incremental.app_timeline(spark, root, store)
    return rows.withColumns({"first_run": F.lit(first).cast("bigint"), "second_run": F.lit(second).cast("bigint"), "third_run": F.lit(third)})


def _csv(spark, name, df, schema):
    path = _new_path(spark, name)
    sinks.write_csv(df, path)
    return sinks.read_csv(spark, path, schema)


@register("level_csv_roundtrip", ORACLES["log_level_counts"])
def level_csv_roundtrip(spark, sf_dir):
    """S12 + S18."""
    return _csv(spark, "counts", log_level_counts(spark, sf_dir), sinks.LEVEL_COUNTS_SCHEMA)


@register("sample_csv_roundtrip", f"SELECT timestamp, level, message FROM ({ORACLES['log_sample']})")
def sample_csv_roundtrip(spark, sf_dir):
    """S13 + S18."""
    return _csv(spark, "sample", log_sample(spark, sf_dir).select("timestamp", "level", "message"), sinks.SAMPLE_SCHEMA)


@register("timeline_csv_roundtrip", ORACLES["app_timeline"])
def timeline_csv_roundtrip(spark, sf_dir):
    """S14 + S18; application numbers keep their zeros."""
    return _csv(spark, "timeline", app_timeline(spark, sf_dir), sinks.TIMELINE_SCHEMA)


@register("cluster_csv_roundtrip", ORACLES["cluster_summary"])
def cluster_csv_roundtrip(spark, sf_dir):
    """S14 + S18 on the cluster summary."""
    return _csv(spark, "clusters", cluster_summary(spark, sf_dir), sinks.CLUSTER_SUMMARY_SCHEMA)


@register("daily_csv_roundtrip", ORACLES["daily_summary"])
def daily_csv_roundtrip(spark, sf_dir):
    """S15 + S18."""
    return _csv(spark, "daily", daily_summary(spark, sf_dir), sinks.DAILY_SUMMARY_SCHEMA)


def _report(spark, name, report):
    path = _new_path(spark, name)
    sinks.write_report(report, path)
    return sinks.read_report(spark, path)


@register("level_report_roundtrip", f"SELECT CAST(line_no AS BIGINT) AS line_no, text FROM ({ORACLES['log_level_report']})")
def level_report_roundtrip(spark, sf_dir):
    """S16 as a file."""
    return _report(spark, "level-report", log_level_report(spark, sf_dir))


@register("cluster_report_roundtrip", f"SELECT CAST(line_no AS BIGINT) AS line_no, text FROM ({ORACLES['cluster_stats_report']})")
def cluster_report_roundtrip(spark, sf_dir):
    """S17 as a file."""
    return _report(spark, "cluster-report", cluster_stats_report(spark, sf_dir))


# ---------------------------------------------------------------- top N

TOP = 3


@register("top_components", f"SELECT * FROM ({ORACLES['component_counts']}) ORDER BY count DESC, component LIMIT {TOP}")
def top_components(spark, sf_dir):
    """T5 on components."""
    return levels.component_counts(_logs(spark, sf_dir), top=TOP)


@register("largest_apps_by_files", f"SELECT * FROM ({ORACLES['files_per_app']}) ORDER BY files DESC, application_id LIMIT 20")
def largest_apps_by_files(spark, sf_dir):
    """T5 on applications."""
    return usage.largest_apps_by_files(usage.files_per_app(_logs(spark, sf_dir)), 20)
