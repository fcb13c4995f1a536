"""Text log sources: explicit path lists, manifests of keys, globs.

Every reader yields ``value`` (one row per line; ``\\n`` and ``\\r\\n`` both end
a line) and ``file_path`` (the file the line came from, from the scan's own
``_metadata`` column -- no per-row function call). With ``positions=True``
it also keeps each line's split start (``file_block_start``) and a scan-order
id (``row_pos``) taken directly over the scan, which ``number_lines`` turns
into exact per-file line numbers without ever holding a file in one task.
"""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.session import checked_broadcast, cut, few_listers, listers, qualified

SPLITS = 100_000  # rows of a split table that are broadcast at most
FILES = 1_000  # small files that one task reads
BYTES = 32 << 20  # of larger ones
MANY = 100_000  # keys of a manifest that is read as a folder, if it can be
OTHERS = 100  # files in that folder which it doesn't name, at most
NAMES = 5_000_000  # hashes of names that are broadcast at most


def with_lineage(df: DataFrame, positions: bool) -> DataFrame:
    """``value`` and ``file_path`` of a raw text scan; with ``positions``
    also the split start and a scan-order id, taken directly over the scan."""
    cols = [F.col("value"), F.col("_metadata.file_path").alias("file_path")]
    if positions:
        cols += [F.col("_metadata.file_block_start").alias("file_block_start"),
                 F.monotonically_increasing_id().alias("row_pos")]
    return df.select(*cols)


def read_logs(spark: SparkSession, paths: str | Iterable[str], positions: bool = False,
              recursive: bool = False) -> DataFrame:
    """S1 + S8: text lines of the given files or directories, with their path.

    A missing path fails the read (as in Spark). Directories are read
    recursively when ``recursive`` is set (no partition columns are inferred).
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    with few_listers(spark):
        return with_lineage(reader.text(paths), positions)


def listing(spark: SparkSession, pattern: str) -> DataFrame:
    """file (as a scan names it), size, changed (a time as text) and path of the files of a folder or glob; their content isn't read.

    Spark plans a task for every few files, however little there is to do for each; ``listers`` do it all.
    """
    with few_listers(spark):
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(pattern)
    return found.select(F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"),
                        F.col("modificationTime").cast("double").cast("string").alias("changed"), "path").coalesce(listers(spark))


def in_tasks(lines: DataFrame, files: int, size: int) -> DataFrame:
    """``lines`` of so many files and bytes, read in no more tasks than they are worth.

    Spark counts the opening of a file as megabytes, and so plans a task for every
    few files, even of one line each. Never more tasks than Spark plans.
    """
    return lines.coalesce(max(lines.sparkSession.sparkContext.defaultParallelism * 4, -(-files // FILES), -(-size // BYTES)))


def read_log_glob(spark: SparkSession, pattern: str, positions: bool = False) -> DataFrame:
    """S3: text lines of all files matching a glob such as ``root/application_*/*.log``."""
    with few_listers(spark):
        return with_lineage(spark.read.text(pattern), positions)


def expand_manifest(spark: SparkSession, manifest: str, base_uri: str = "") -> list[str]:
    """A file of object keys -> sorted, de-duplicated list of full paths.

    Keys are stripped and blank lines dropped. Only the key list reaches the
    driver (Spark needs the paths to plan the scan); duplicates are removed
    because Spark would read a repeated path twice.
    """
    return _paths(manifest_keys(spark, manifest), base_uri)


def _paths(keys: DataFrame, base_uri: str) -> list[str]:
    prefix = base_uri.rstrip("/") + "/" if base_uri else ""
    return sorted(prefix + r["key"] for r in keys.collect())


def manifest_keys(spark: SparkSession, manifest: str) -> DataFrame:
    """The keys of a manifest, stripped, without blank lines, each once."""
    keys = spark.read.text(manifest).select(F.trim(F.col("value")).alias("key"))
    return keys.where(F.col("key") != "").distinct()


def read_manifest_logs(spark: SparkSession, manifest: str, base_uri: str = "",
                       positions: bool = False) -> DataFrame:
    """S2 + S1: read every file listed in a manifest.

    Paths that are given one by one cost the driver more than twice what the
    files of a folder do. So a manifest of more than MANY keys that names all files of a
    folder but OTHERS is read as that folder without those others.
    """
    keys = cut(manifest_keys(spark, manifest))
    n = keys.count()
    lines = _as_folder(spark, keys, n, base_uri, positions) if base_uri.rstrip("/") and n > MANY else None
    return read_logs(spark, _paths(keys, base_uri), positions) if lines is None else lines


def _as_folder(spark: SparkSession, keys: DataFrame, n: int, base_uri: str, positions: bool) -> DataFrame | None:
    """The lines of the files that ``n`` keys name, as those of the folder that holds them all; None if that isn't the same."""
    ends = keys.agg(F.min("key"), F.max("key")).first()
    below = os.path.commonprefix(ends).rpartition("/")[0]  # in order of text the first and the last key share what all do
    folder = base_uri.rstrip("/") + ("/" + below if below else "")
    top = qualified(spark, base_uri.rstrip("/")) + "/"
    # A key that is no file's path in just this form (it is missing, a folder, a glob) makes the counts differ.
    own = F.when(F.col("path").startswith(top), F.substring(F.col("path"), len(top) + 1, 1 << 30)).alias("key")
    marked = cut(listing(spark, folder).select("file", "size", own).join(keys.withColumn("named", F.lit(True)), "key", "left"))
    named, others, size = marked.agg(F.count("named"), F.count_if(F.col("named").isNull()), F.sum(F.when(F.col("named"), F.col("size")))).first()
    if named != n or others > OTHERS:
        return None
    hashes = marked.select(F.xxhash64("file").alias("_h"), "named").groupBy("_h").agg(F.count("named").alias("_n"), F.count(F.lit(1)).alias("_all"))
    if not hashes.where("_n > 0 AND _n < _all").isEmpty():  # a file with a hash of a named one
        return None
    left_out = [r["file"] for r in marked.where("named IS NULL").collect()]
    lines = read_logs(spark, folder, positions, recursive=True)
    if left_out:
        lines = lines.where(~F.col("file_path").isin(left_out))
    # Files that came since are no part of it.
    hashes = checked_broadcast(hashes.where("_n > 0").select("_h"), NAMES)
    lines = lines.join(hashes, F.xxhash64("file_path") == F.col("_h"), "left_semi")
    return in_tasks(lines, n, size)


def split_table(lines: DataFrame, file_col: str = "file_path",
                block_col: str = "file_block_start", pos_col: str = "row_pos") -> DataFrame:
    """One row per input split: its first scan id and the number of lines of
    its file before it (file, split start, ``first_pos``, ``lines_before``).

    ``lines`` must come straight from a reader with ``positions=True`` (no
    filter in between), each file listed once. The scan behind it reads no
    more than line counts; the window is over one file's splits.
    """
    blocks = (lines.groupBy(file_col, block_col)
              .agg(F.min(pos_col).alias("first_pos"), F.count(F.lit(1)).alias("_n")))
    earlier = (Window.partitionBy(file_col).orderBy(block_col)
               .rowsBetween(Window.unboundedPreceding, -1))
    return blocks.select(file_col, block_col, "first_pos",
                         F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("lines_before"))


def number_lines(lines: DataFrame, file_col: str = "file_path",
                 block_col: str = "file_block_start", pos_col: str = "row_pos",
                 out: str = "line_no", splits: DataFrame | None = None) -> DataFrame:
    """Exact 1-based line number of every line within its file.

    A split's lines are read in order by one task and get consecutive scan
    ids, so a line's number is the count of lines in earlier splits of the
    same file plus its distance from its split's first id. ``lines`` may be
    filtered or projected if ``splits`` (the ``split_table`` of the whole
    reader) is given. Up to SPLITS splits the table is broadcast, and no line
    is shuffled; beyond that the join shuffles what columns ``lines`` has, so
    project the text away first where it isn't needed.
    """
    keys = [file_col, block_col]
    table = split_table(lines, file_col, block_col, pos_col) if splits is None else splits
    return (lines.join(checked_broadcast(table, SPLITS), keys)
            .withColumn(out, F.col("lines_before") + F.col(pos_col) - F.col("first_pos") + F.lit(1))
            .drop("first_pos", "lines_before"))
