"""Spark-on-YARN log analyses from the dataset guide.

Each analysis first keeps lines containing a cheap literal (``contains`` is
a byte search), then applies its regex only to those candidates, then
aggregates per application (or finer key) with a partial aggregate before
the shuffle. Keys include the application because task ids are unique only
within one application.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions import parse
from daybook.functions.fmt import safe_ratio
from daybook.functions.time import seconds_between

# --- Fixed values: line shapes of the analysed log messages. ---
EXECUTOR_REQUEST = (r"Will request (\d+) executor containers, each with (\d+) cores and "
                    r"(\d+) MB memory(?: including (\d+) MB overhead)?")
CONTAINER_REQUEST = r"Container request \(host: ([^,]+), capability: <memory:(\d+), vCores:(\d+)>\)"
TASK_EVENT = (r"(Running|Finished) task (\d+)\.(\d+) in stage (\d+)\.(\d+) \(TID (\d+)\)"
              r"(?:\. (\d+) bytes result)?")
PYTHON_TIMES = (r"PythonRunner: Times: total = (-?\d+), boot = (-?\d+), init = (-?\d+), "
                r"finish = (-?\d+)")
INPUT_SPLIT = r"Input split: (.+):(\d+)\+(\d+)$"
MEMORY_STORE = r"MemoryStore started with capacity ([\d.]+) ([KMGT]?B)"
BLOCK_STORED = (r"Block (\S+) stored as (bytes|values) in memory \(estimated size ([\d.]+) "
                r"([KMGT]?B), free ([\d.]+) ([KMGT]?B)\)")
BROADCAST_READ = r"Started reading broadcast variable (\d+)"
UNIT_EXPONENT = {"B": 0, "KB": 1, "MB": 2, "GB": 3, "TB": 4}  # powers of 1024
# --- end of fixed values ---

ENTRY_LINES = 1000  # lines of an entry that one row holds
_SEP = "\u0001"


def _groups(value: str, pattern: str, groups: Sequence[int]) -> Column:
    """The capture groups of the first match as an array, by one regex pass.

    The line is rewritten to its groups with a control character between
    them, then split. Only the last of ``groups`` may hold free text: the
    split stops before it, so a control character in it does no harm. Line
    breaks of any kind before or after the match are passed over.
    """
    rewritten = F.regexp_replace(F.col(value), f"^(?s:.*?)(?:{pattern})(?s:.*)$", _SEP.join(f"${i}" for i in groups))
    return F.split(rewritten, _SEP, len(groups))


def _matching(lines: DataFrame, literal: str, pattern: str, groups: Sequence[int], value: str,
              file_col: str) -> DataFrame:
    """Lines that contain ``literal`` and match ``pattern``, with the groups
    in ``_m`` in the order given and the path renamed ``_f``. The cheap
    ``contains`` test runs first, so regexes only see candidate lines."""
    c = lines.where(F.col(value).contains(literal)).where(F.col(value).rlike(pattern))
    return c.withColumn("_m", _groups(value, pattern, groups)).withColumnRenamed(file_col, "_f")


def _g(i: int) -> Column:
    """The i-th of the groups asked for, from 1."""
    return F.get("_m", F.lit(i - 1))


def _int(i: int) -> Column:
    return F.nullif(_g(i), F.lit("")).try_cast("bigint")


def _in_unit(amount: Column, unit: Column, target: str = "MB") -> Column:
    """Convert ``amount`` given in ``unit`` (B, KB, MB, GB, TB) to ``target``."""
    t = UNIT_EXPONENT[target]
    factor = F.coalesce(*[F.when(unit == u, F.lit(1024.0 ** (e - t))) for u, e in UNIT_EXPONENT.items()])
    return amount.try_cast("double") * factor


def _by_app(per_file: DataFrame, *aggs) -> DataFrame:
    """Fold per-file partial results (column ``_f``) into per-application
    rows: the path is parsed once per file, not once per line."""
    return (per_file.withColumn("application_id", parse.application_id("_f"))
            .groupBy("application_id").agg(*aggs))


def executor_requests(lines: DataFrame, value: str = "value",
                      file_col: str = "file_path") -> DataFrame:
    """Executor requests per application: requests, executors, and the
    cores, memory and overhead they add up to (overhead only when logged)."""
    c = _matching(lines, "Will request ", EXECUTOR_REQUEST, (1, 2, 3, 4), value, file_col)
    n, cores, mem, over = (_int(i) for i in (1, 2, 3, 4))
    rows = c.select("_f", n.alias("n"), cores.alias("cores"), mem.alias("mem"), over.alias("over"))
    per_file = rows.groupBy("_f").agg(
        F.count(F.lit(1)).alias("requests"),
        F.sum("n").alias("executors"),
        F.sum(F.col("n") * F.col("cores")).alias("cores_total"),
        F.sum(F.col("n") * F.col("mem")).alias("mem_total"),
        F.count("over").alias("with_over"),
        F.sum(F.col("n") * F.col("over")).alias("over_total"),
        F.max("cores").alias("cores_max"), F.max("mem").alias("mem_max"))
    return _by_app(
        per_file,
        F.sum("requests").cast("bigint").alias("requests"),
        F.sum("executors").cast("bigint").alias("executors_requested"),
        F.sum("cores_total").cast("bigint").alias("cores_requested"),
        F.sum("mem_total").cast("bigint").alias("memory_mb_requested"),
        F.sum("with_over").cast("bigint").alias("requests_with_overhead"),
        F.coalesce(F.sum("over_total"), F.lit(0)).cast("bigint").alias("overhead_mb_requested"),
        F.max("cores_max").alias("max_cores"), F.max("mem_max").alias("max_memory_mb"))


def container_requests(lines: DataFrame, value: str = "value",
                       file_col: str = "file_path") -> DataFrame:
    """Container requests by host preference and capability."""
    c = _matching(lines, "Container request (host: ", CONTAINER_REQUEST, (2, 3, 1), value, file_col)
    keys = ["host", "memory_mb", "vcores"]
    per_file = (c.select("_f", _g(3).alias("host"), _int(1).alias("memory_mb"),
                         _int(2).alias("vcores"))
                .groupBy("_f", *keys).agg(F.count(F.lit(1)).alias("n")))
    return (per_file.withColumn("application_id", parse.application_id("_f"))
            .groupBy(*keys).agg(F.sum("n").cast("bigint").alias("requests"),
                                F.count_distinct("application_id").alias("applications")))


def task_attempts(lines: DataFrame, value: str = "value", file_col: str = "file_path") -> DataFrame:
    """D3: one row per task attempt, pairing its Running and Finished lines
    with one group-by (no join): start, finish, seconds and result bytes.
    ``finish_time`` is NULL for attempts that never finished."""
    c = _matching(lines, " task ", TASK_EVENT, (1, 2, 3, 4, 5, 6, 7), value, file_col)
    rows = c.select(
        "_f", _int(4).alias("stage"), _int(5).alias("stage_attempt"), _int(2).alias("task"),
        _int(3).alias("task_attempt"), _int(6).alias("tid"), _g(1).alias("kind"),
        parse.log_time(value).alias("ts"), _int(7).alias("result_bytes"))
    running, finished = F.col("kind") == "Running", F.col("kind") == "Finished"
    att = rows.groupBy("_f", "stage", "stage_attempt", "task", "task_attempt", "tid").agg(
        F.min(F.when(running, F.col("ts"))).alias("start_time"),
        F.max(F.when(finished, F.col("ts"))).alias("finish_time"),
        F.max(F.when(finished, F.col("result_bytes"))).alias("result_bytes"))
    return att.select(
        parse.application_id("_f").alias("application_id"),
        parse.container_id("_f").alias("container_id"),
        "stage", "stage_attempt", "task", "task_attempt", "tid", "start_time", "finish_time",
        "result_bytes", seconds_between("start_time", "finish_time").alias("duration_sec"))


def task_summary_by_app(attempts: DataFrame) -> DataFrame:
    """D3 + D7: attempts, finished, unfinished, mean seconds and result bytes per application."""
    done = F.col("finish_time").isNotNull() & F.col("start_time").isNotNull()
    return attempts.groupBy("application_id").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(done).alias("finished"),
        F.count_if(F.col("finish_time").isNull()).alias("unfinished"),
        F.avg(F.when(done, F.col("duration_sec"))).alias("avg_task_sec"),
        F.max(F.when(done, F.col("duration_sec"))).alias("max_task_sec"),
        F.coalesce(F.sum("result_bytes"), F.lit(0)).cast("bigint").alias("result_bytes"))


def stage_skew(attempts: DataFrame, straggler_factor: float = 1.5) -> DataFrame:
    """Per (application, stage) of finished attempts: tasks, median and
    max seconds, max/median, and stragglers (over ``factor`` x median).

    Attempts are first counted by (application, stage, seconds), merged
    map-side; log times have whole seconds, so a stage leaves few rows
    however many tasks it ran, and the exact median and the stragglers come
    from those counts without going back to the attempts.
    """
    keys = ["application_id", "stage"]
    counts = attempts.where(F.col("duration_sec").isNotNull()).groupBy(*keys, "duration_sec").agg(F.count(F.lit(1)).alias("_c"))
    stage = Window.partitionBy(*keys)
    upto = stage.orderBy("duration_sec").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumns({"_upto": F.sum("_c").over(upto), "_n": F.sum("_c").over(stage)})
    half = F.when(F.col("_upto") >= F.lit(0.5) * F.col("_n"), F.col("duration_sec"))
    ranked = ranked.withColumn("median_sec", F.min(half).over(stage))
    out = ranked.groupBy(*keys).agg(
        F.max("_n").alias("tasks"), F.max("median_sec").alias("median_sec"), F.max("duration_sec").alias("max_sec"),
        F.coalesce(F.sum(F.when(F.col("duration_sec") > F.lit(straggler_factor) * F.col("median_sec"), F.col("_c"))), F.lit(0))
        .alias("stragglers"))
    return out.select(*keys, "tasks", "median_sec", "max_sec",
                      F.when(F.col("median_sec") > 0, F.col("max_sec") / F.col("median_sec"))
                      .alias("max_over_median"), "stragglers")


def python_times(lines: DataFrame, value: str = "value", file_col: str = "file_path") -> DataFrame:
    """Python worker timings per application (boot may be negative)."""
    c = _matching(lines, "PythonRunner: Times:", PYTHON_TIMES, (1, 2, 3, 4), value, file_col)
    rows = c.select("_f", *[_int(i).alias(n) for i, n in
                            ((1, "total"), (2, "boot"), (3, "init"), (4, "finish"))])
    per_file = rows.groupBy("_f").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("total").alias("s_total"), F.max("total").alias("max_total"),
        F.sum("boot").alias("s_boot"), F.min("boot").alias("min_boot"),
        F.count_if(F.col("boot") < 0).alias("neg_boot"),
        F.sum("init").alias("s_init"), F.sum("finish").alias("s_finish"))
    runs = F.sum("runs")
    return _by_app(
        per_file,
        runs.cast("bigint").alias("runs"),
        (F.sum("s_total") / runs).alias("avg_total_ms"), F.max("max_total").alias("max_total_ms"),
        (F.sum("s_boot") / runs).alias("avg_boot_ms"), F.min("min_boot").alias("min_boot_ms"),
        F.sum("neg_boot").cast("bigint").alias("negative_boot_runs"),
        (F.sum("s_init") / runs).alias("avg_init_ms"),
        (F.sum("s_finish") / runs).alias("avg_finish_ms"))


def input_splits(lines: DataFrame, value: str = "value", file_col: str = "file_path") -> DataFrame:
    """Input splits by source file: splits, bytes, furthest byte read, readers."""
    c = _matching(lines, "Input split: ", INPUT_SPLIT, (2, 3, 1), value, file_col)
    rows = c.select("_f", _g(3).alias("source"), _int(1).alias("offset"), _int(2).alias("length"))
    per_file = rows.groupBy("_f", "source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("length").alias("b"),
        F.max(F.col("offset") + F.col("length")).alias("e"))
    return (per_file.withColumn("application_id", parse.application_id("_f"))
            .groupBy("source").agg(
                F.sum("n").cast("bigint").alias("splits"),
                F.sum("b").cast("bigint").alias("bytes"),
                F.max("e").alias("max_end"),
                F.count_distinct("application_id").alias("applications")))


def store_lines(lines: DataFrame, value: str = "value", file_col: str = "file_path", *keep: str) -> DataFrame:
    """The memory-store lines with their numbers and the columns of ``keep``: a
    store's start has capacity_mb, a stored block stored_as, size_kb and
    free_mb, the others are null; ts is the line's time, _f its file."""
    # One regex says which message it is, one more takes it apart.
    is_block = F.col(value).rlike(BLOCK_STORED)
    m = F.when(is_block, _groups(value, BLOCK_STORED, (2, 3, 4, 5, 6))) \
        .when(F.col(value).rlike(MEMORY_STORE), _groups(value, MEMORY_STORE, (1, 2)))
    c = lines.where(F.col(value).contains("MemoryStore")).select(
        F.col(file_col).alias("_f"), *keep, m.alias("_m"), parse.log_time(value).alias("ts"))
    block = F.size("_m") == 5
    return c.where(F.col("_m").isNotNull()).select(
        "_f", *keep, "ts", F.when(~block, _in_unit(_g(1), _g(2), "MB")).alias("capacity_mb"),
        F.when(block, _g(1)).alias("stored_as"),
        F.when(block, _in_unit(_g(2), _g(3), "KB")).alias("size_kb"),
        F.when(block, _in_unit(_g(4), _g(5), "MB")).alias("free_mb"))


def memory_usage(lines: DataFrame, value: str = "value", file_col: str = "file_path") -> DataFrame:
    """Per application, memory-store capacity (MB), stored blocks and
    their sizes (KB, summed), and the lowest free memory reported (MB)."""
    rows = store_lines(lines, value, file_col)
    per_file = rows.groupBy("_f").agg(
        F.count("capacity_mb").alias("stores"), F.max("capacity_mb").alias("cap_max"),
        F.count("stored_as").alias("blocks"),
        F.count_if(F.col("stored_as") == "bytes").alias("as_bytes"),
        F.sum("size_kb").alias("kb"), F.max("size_kb").alias("kb_max"),
        F.min("free_mb").alias("free_min"))
    return _by_app(
        per_file,
        F.sum("stores").cast("bigint").alias("stores_started"),
        F.max("cap_max").alias("max_capacity_mb"),
        F.sum("blocks").cast("bigint").alias("blocks"),
        F.sum("as_bytes").cast("bigint").alias("blocks_as_bytes"),
        F.sum("kb").alias("block_kb"),
        F.max("kb_max").alias("max_block_kb"),
        F.min("free_min").alias("min_free_mb"))


def failure_rates(lines: DataFrame, value: str = "value", file_col: str = "file_path") -> DataFrame:
    """Per container: lines, ERROR lines, their share and the task
    attempts that started but never finished -- from one scan.

    Lines are first grouped by (file, task attempt) -- the attempt key is
    NULL for lines that are not task events -- which pairs start and finish
    lines and pre-counts the rest; a second, much smaller aggregate folds
    those rows into one row per file.
    """
    is_task = F.col(value).contains(" task ") & F.col(value).rlike(TASK_EVENT)
    m = F.when(is_task, _groups(value, TASK_EVENT, (4, 5, 2, 3, 6, 1)))
    per_attempt = (lines.select(F.col(file_col).alias("_f"), m.alias("_m"),
                                (parse.level(value) == "ERROR").alias("_err"))
                   .select("_f", "_err", F.array_join(F.slice("_m", 1, 5), ":").alias("_attempt"), _g(6).alias("_kind"))
                   .groupBy("_f", "_attempt")
                   .agg(F.count(F.lit(1)).alias("_lines"), F.count_if("_err").alias("_errors"),
                        F.count_if(F.col("_kind") == "Running").alias("_starts"),
                        F.count_if(F.col("_kind") == "Finished").alias("_finishes")))
    unfinished = F.col("_attempt").isNotNull() & (F.col("_starts") > 0) & (F.col("_finishes") == 0)
    per = per_attempt.groupBy("_f").agg(
        F.sum("_lines").cast("bigint").alias("lines"),
        F.sum("_errors").cast("bigint").alias("error_lines"),
        F.count_if(unfinished).alias("unfinished_attempts"))
    return per.select(parse.application_id("_f").alias("application_id"),
                      parse.container_id("_f").alias("container_id"), "lines", "error_lines",
                      safe_ratio("error_lines", "lines").alias("error_rate"),
                      "unfinished_attempts")


def broadcast_reads(lines: DataFrame, value: str = "value", file_col: str = "file_path") -> DataFrame:
    """Broadcast-variable reads per application."""
    c = _matching(lines, "Started reading broadcast variable", BROADCAST_READ, (1,), value, file_col)
    per_file = (c.select("_f", _int(1).alias("var"))
                .groupBy("_f", "var").agg(F.count(F.lit(1)).alias("n")))
    return _by_app(per_file, F.sum("n").cast("bigint").alias("reads"),
                   F.count_distinct("var").alias("distinct_variables"))


def entry_lines(lines: DataFrame, value: str = "value", file_col: str = "file_path",
                block_col: str = "file_block_start", pos_col: str = "row_pos") -> DataFrame:
    """D10, line by line: every line with the entry it belongs to.

    ``lines`` must come straight from a reader with ``positions=True``, each
    file listed once. Output: file_path, file_block_start, entry_no (0 =
    before the file's first timestamped line), entry_line (from 1 within the
    entry), line_no, last_in_split (whether the entry is its split's last),
    value. A small table with one row per split (lines, timestamped lines,
    last timestamped line) tells what earlier splits hold; inside a split, a
    running count does. Nothing is collected, and one task holds one split.
    """
    split = [file_col, block_col]
    head = parse.is_entry_head(value)
    rows = lines.select(*split, pos_col, value, F.when(head, F.lit(1)).otherwise(F.lit(0)).alias("_head"))
    blocks = (lines.select(*split, pos_col, head.alias("_is_head")).groupBy(*split)
              .agg(F.min(pos_col).alias("_first"), F.count(F.lit(1)).alias("_n"),
                   F.count_if("_is_head").alias("_heads"), F.max(F.when(F.col("_is_head"), F.col(pos_col))).alias("_last_head")))
    before = Window.partitionBy(file_col).orderBy(block_col).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_lines_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    blocks = blocks.select(
        *split, "_first", "_heads", "_lines_before", F.coalesce(F.sum("_heads").over(before), F.lit(0)).alias("_heads_before"),
        F.max(F.col("_lines_before") + F.col("_last_head") - F.col("_first") + 1).over(before).alias("_open_since"))
    inside = Window.partitionBy(*split).orderBy(pos_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumns({"_seen": F.sum("_head").over(inside), "_at": F.max(F.when(F.col("_head") == 1, F.col(pos_col))).over(inside)}) \
        .join(blocks, split)

    def number(pos: str) -> Column:
        return F.col("_lines_before") + F.col(pos) - F.col("_first") + F.lit(1)

    placed = placed.withColumns({"line_no": number(pos_col), "_since": F.coalesce(number("_at"), F.col("_open_since"), F.lit(1).cast("bigint"))})
    return placed.select(
        F.col(file_col).alias("file_path"), F.col(block_col).alias("file_block_start"), (F.col("_heads_before") + F.col("_seen")).alias("entry_no"),
        (F.col("line_no") - F.col("_since") + F.lit(1)).alias("entry_line"), "line_no", (F.col("_seen") == F.col("_heads")).alias("last_in_split"),
        F.col(value).alias("value"))


def stitch_entries(lines: DataFrame, value: str = "value", file_col: str = "file_path",
                   block_col: str = "file_block_start", pos_col: str = "row_pos", most: int = ENTRY_LINES) -> DataFrame:
    """Continuation lines (no timestamp prefix) joined to the entry above.

    Output: file_path, entry_no, part, first_line_no, n_lines, text (lines
    joined with newlines). An entry of more than ``most`` lines is cut into
    parts of that many; lines before a file's first timestamp belong to no
    entry and stay lines of their own (entry 0, a part each). So no row holds
    more than ``most`` lines, whatever a file looks like, and none is lost.
    Lines meet inside their split first; only what a split's edge cuts apart
    is grouped once more.
    """
    rows = entry_lines(lines, value, file_col, block_col, pos_col)
    size = F.when(F.col("entry_no") == 0, F.lit(1)).otherwise(F.lit(most))
    rows = rows.withColumn("part", F.floor((F.col("entry_line") - 1) / size).cast("bigint"))
    first = F.min("entry_no").over(Window.partitionBy("file_path", "file_block_start"))
    rows = rows.withColumn("_edge", (F.col("entry_no") > 0) & (F.col("last_in_split") | (F.col("entry_no") == first)))
    keys = ["file_path", "entry_no", "part"]
    parts = rows.groupBy("file_path", "file_block_start", "entry_no", "part", "_edge").agg(
        F.min("line_no").alias("first_line_no"), F.count(F.lit(1)).alias("n_lines"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "value"))), lambda p: p["value"]), "\n").alias("text"))
    whole = parts.where(~F.col("_edge")).select(*keys, "first_line_no", "n_lines", "text")
    cut_apart = parts.where("_edge").groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("first_line_no", "n_lines", "text"))).alias("p")).select(
        *keys, F.col("p")[0]["first_line_no"].alias("first_line_no"),
        F.aggregate("p", F.lit(0).cast("bigint"), lambda n, x: n + x["n_lines"]).alias("n_lines"), F.array_join("p.text", "\n").alias("text"))
    return whole.unionByName(cut_apart)
