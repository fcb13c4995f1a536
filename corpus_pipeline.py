"""From raw documents to packed training sequences.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one
before it kept; all but the last return the columns of ``documents`` and
leave any others behind, whatever their names. Whole texts count, however
long; an empty table gives an empty result. What nulls, ties and repeated
rows give is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import langid, mixing, packing, quality, simhash
from daybook.llm.common import cut, id_bucket, remove, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A text whose best cosine is lower has no letters to speak of.
LEAST_SCORE = 0.03


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality policy keeps. Null, empty and blank texts have
    too few words and go; each repeated row is judged by itself."""
    rated = quality.with_ledger(docs.select(*COLUMNS), name="ledger")
    return rated.where(~quality.fails(F.col("ledger.bits"), quality.POLICY)).select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, by profiles learnt from the documents that came in.

    Texts without letters, null ones among them, go. Null languages teach
    nothing, and if nothing can be learnt no language is known and all go.
    Equal scores go to the first language in order; each repeated row is judged by itself."""
    docs = docs.select(*COLUMNS)
    profiles = langid.fit(docs.where(id_bucket(F.col("doc_id"), 5) != 0))
    told = docs.withColumn("told", langid.predict(F.col("text"), profiles))
    return told.where((F.col("told.lang_pred") != langid.UNKNOWN) & (F.col("told.score") >= LEAST_SCORE)).select(*COLUMNS)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group: the one with the smallest id (null last), of equal ids the one whose text has the smallest hash.

    Null and blank texts are one group; of rows repeated whole one stays."""
    return simhash.keep_one(docs.select(*COLUMNS)).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources and shuffled.

    A null source is a source; a document without an id draws by its text;
    repeated rows draw the same count each."""
    return mixing.mix(docs.select(*COLUMNS)).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences.

    A null text is an empty one, a piece of its end alone; ids may be null or
    repeat, each row (each copy of a mixed document) is packed by itself."""
    return packing.pack(packing.pieces(docs)).select(
        "doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("SimHash near-dedup", simhash_near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", best_fit_packing),
]

#: SQL can express neither the fingerprints nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each one's rows are written as Parquet to
    the shared folder for the next, and removed once that one is written; the
    last stage's result reads files of its own."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        if name == STAGES[-1][0]:
            made = cut(made)
        else:
            docs, path = written(made, "pipeline")
        if before:
            remove(spark, before)
        before = path
    return made
