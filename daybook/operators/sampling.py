"""Reproducible uniform sample of rows.

Rows are ranked by ``md5(seed:key)`` where the key identifies the *row*
(for log lines: file and line number), so the sample does not depend on
partitioning, and identical texts at different places are drawn
independently. ``orderBy(...).limit(n)`` plans as a per-task top-n merged on
one task (TakeOrderedAndProject): no full shuffle, ``n`` rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.sources.text import number_lines, split_table


def hash_rank(seed: int | str, key_cols: Sequence[str]):
    parts = [F.lit(str(seed))] + [F.col(c).cast("string") for c in key_cols]
    return F.md5(F.concat_ws(":", *parts))


def sample_rows(df: DataFrame, n: int, seed: int | str, key_cols: Sequence[str]) -> DataFrame:
    """``n`` rows chosen uniformly by hash of (seed, key); ties broken by key."""
    r = hash_rank(seed, key_cols)
    return df.orderBy(r, *[F.col(c) for c in key_cols]).limit(n)


def sample_lines(lines: DataFrame, n: int, seed: int | str, keep: Column, key: Column | None = None,
                 file_col: str = "file_path", block_col: str = "file_block_start",
                 pos_col: str = "row_pos") -> DataFrame:
    """``n`` of the lines that ``keep`` accepts, drawn by hash of (seed, key, line number), with ``line_no``.

    ``lines`` come straight from a reader with ``positions=True``; ``key``
    names the file (its path if not given). Only places, not texts, are
    numbered and ranked; the texts of the ``n`` places drawn are then read
    back, so no text is shuffled.
    """
    splits = split_table(lines, file_col, block_col, pos_col)
    places = lines.where(keep).select(file_col, block_col, pos_col)
    numbered = number_lines(places, file_col, block_col, pos_col, splits=splits)
    named = numbered.withColumn("_key", F.col(file_col) if key is None else key)
    drawn = sample_rows(named, n, seed, ["_key", "line_no"]).drop("_key")
    return lines.join(F.broadcast(drawn), [file_col, block_col, pos_col])  # n rows


def random_sample(df: DataFrame, n: int) -> DataFrame:
    """The reference's unseeded form: ``orderBy(rand()).limit(n)``."""
    return df.orderBy(F.rand()).limit(n)
