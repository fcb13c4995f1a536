"""Incremental forms of the batch operators over arriving log files."""

from daybook.streaming.levels import level_counts_stream, start_level_counts

__all__ = ["level_counts_stream", "start_level_counts"]
