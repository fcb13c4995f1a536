"""Readers: text logs (paths, manifests, globs), parquet (multi-file,
partitioned), SQL text."""

from daybook.sources.drifting import read_drifting, read_drifting_months
from daybook.sources.parquet import month_paths, read_months, read_parquet
from daybook.sources.text import (
    expand_manifest,
    in_tasks,
    listing,
    number_lines,
    read_log_glob,
    read_logs,
    read_manifest_logs,
    split_table,
)
from daybook.sources.generated import sql_count

__all__ = [
    "expand_manifest", "in_tasks", "listing", "month_paths", "number_lines", "read_drifting", "read_drifting_months", "read_log_glob",
    "read_logs", "read_manifest_logs", "read_months", "read_parquet", "split_table", "sql_count",
]
