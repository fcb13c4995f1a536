"""Column builders that parse Spark-on-YARN log lines and their file paths.

Each builder returns a Column, so parsing stays inside whole-stage codegen
(``regexp_extract`` and integer casts only; no Python UDF). A pattern that
does not match yields "" (as ``regexp_extract`` does), NULL input stays NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.util import as_col

# --- Fixed values: these patterns define the log and path grammar and must
# stay exactly as written for results to agree with the recorded outputs. ---
TIMESTAMP_PREFIX = r"^(\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})"
LEVEL_ANYWHERE = r"(INFO|WARN|ERROR|DEBUG)"
COMPONENT = r"(INFO|WARN|ERROR|DEBUG)\s+([^:]+):"
APPLICATION_ID = r"(application_\d+_\d+)"
CLUSTER_ID = r"application_(\d+)_\d+"
APP_NUMBER = r"application_\d+_(\d+)"
CONTAINER_ID = r"(container_\d+_\d+_\d+_\d+)"
CONTAINER_PARTS = r"container_\d+_\d+_(\d+)_(\d+)"
LOG_TIME_FORMAT = "yy/MM/dd HH:mm:ss"
APPLICATION_MASTER_CONTAINER = "000001"
# --- end of fixed values ---

# Opt-in strict level: the word right after the timestamp.
LEVEL_AFTER_TIMESTAMP = r"^\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2} (INFO|WARN|ERROR|DEBUG)\b"

LEVELS = ("INFO", "WARN", "ERROR", "DEBUG")


def timestamp_prefix(line="value") -> Column:
    """The ``yy/MM/dd HH:mm:ss`` prefix as a string, "" when absent."""
    return F.regexp_extract(as_col(line), TIMESTAMP_PREFIX, 1)


def is_entry_head(line="value") -> Column:
    """Whether a line begins with a timestamp, and so a log entry; NULL is no head."""
    return F.coalesce(as_col(line).rlike(TIMESTAMP_PREFIX), F.lit(False))


def level(line="value", strict: bool = False) -> Column:
    """Leftmost INFO/WARN/ERROR/DEBUG anywhere in the line ("" if none).

    ``strict=True`` only accepts the word directly after the timestamp.
    """
    return F.regexp_extract(as_col(line), LEVEL_AFTER_TIMESTAMP if strict else LEVEL_ANYWHERE, 1)


def component(line="value") -> Column:
    """The logger name between the level and the first colon."""
    return F.regexp_extract(as_col(line), COMPONENT, 2)


def all_levels(line="value") -> Column:
    """Every level word in the line, left to right (non-overlapping), as an array."""
    return F.regexp_extract_all(as_col(line), F.lit(LEVEL_ANYWHERE), 1)


def application_id(path="file_path") -> Column:
    """``application_<cluster>_<number>`` found anywhere in a path."""
    return F.regexp_extract(as_col(path), APPLICATION_ID, 1)


def cluster_id(app="application_id") -> Column:
    """P5: the cluster (resource manager start) part of an application id."""
    return F.regexp_extract(as_col(app), CLUSTER_ID, 1)


def app_number(app="application_id") -> Column:
    """The application number, leading zeros kept (string)."""
    return F.regexp_extract(as_col(app), APP_NUMBER, 1)


def container_id(path="file_path") -> Column:
    """``container_<cluster>_<app>_<attempt>_<number>`` found in a path."""
    return F.regexp_extract(as_col(path), CONTAINER_ID, 1)


def container_attempt(container="container_id") -> Column:
    """Attempt part of a container id (string, zeros kept)."""
    return F.regexp_extract(as_col(container), CONTAINER_PARTS, 1)


def container_number(container="container_id") -> Column:
    """Container number (string, zeros kept)."""
    return F.regexp_extract(as_col(container), CONTAINER_PARTS, 2)


def container_role(container="container_id") -> Column:
    """``application_master`` for container 000001, else ``executor``; "" if no id."""
    num = container_number(container)
    return (F.when(num == "", F.lit(""))
            .when(num == APPLICATION_MASTER_CONTAINER, F.lit("application_master"))
            .otherwise(F.lit("executor")))


def _assemble(s: Column, guard: Column) -> Column:
    def part(start: int) -> Column:
        return F.substring(s, start, 2).try_cast("int")

    secs = part(16)
    return F.when(guard & (secs < 60),
                  F.try_make_timestamp_ntz(part(1) + F.lit(2000), part(4), part(7),
                                           part(10), part(13), secs))


def parse_log_time(ts_str="timestamp_str") -> Column:
    """``yy/MM/dd HH:mm:ss`` -> TIMESTAMP_NTZ; "" or impossible values -> NULL.

    The fields are cut from the fixed-width text and assembled with
    ``try_make_timestamp_ntz``: zone free (log text carries no zone), never
    raises under ANSI mode, and cheaper than a pattern-based parser. Two-digit
    years are 20yy. Second 60 is rejected, as a ``ss`` pattern would.
    """
    s = as_col(ts_str)
    return _assemble(s, s.rlike(r"^\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}$"))


def log_time(line="value") -> Column:
    """P1 + P9 in one step: the line's timestamp or NULL. The fixed-width
    prefix is cut from the line and its shape tested by the only regex."""
    return parse_log_time(F.substring(as_col(line), 1, 17))
