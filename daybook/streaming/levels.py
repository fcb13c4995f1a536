"""Level counts over a directory that keeps receiving log files.

The batch operator is reused unchanged on a streaming DataFrame: Structured
Streaming keeps the per-level counts (at most five rows) as state, and each
micro-batch only parses the new files. ``maxFilesPerTrigger`` bounds a
micro-batch; the checkpoint location must be on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from daybook.operators import levels


def level_counts_stream(spark: SparkSession, source_glob: str,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``level, count`` over text files matching ``source_glob``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return levels.level_counts(reader.load(source_glob))


def start_level_counts(spark: SparkSession, source_glob: str, checkpoint: str,
                       query_name: str = "level_counts",
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the running count; ``query_name`` is a table with the counts so far."""
    counts = level_counts_stream(spark, source_glob, max_files_per_trigger)
    return (counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
            .format("memory").queryName(query_name).start())
