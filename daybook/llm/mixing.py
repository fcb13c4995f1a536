"""Mixing sources to target weights by Poisson replication.

A source's target weight and size give its repetition rate, the mean number
of times each of its documents should appear. Every document draws its own
count from a Poisson distribution of that mean by inverting it at a uniform
number hashed from the seed and the document, is repeated that often, and
the copies are shuffled globally by another hash. Nothing is drawn at random
at run time: a lost task computes the same rows again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import bounded, free

SEED = 20_24
POWER = 0.5  # without given weights a source weighs its size to this power
MEAN = 16.0  # a larger rate is the sum of draws of at most this mean
TERMS = 96  # the distribution of mean 16 is cut where less than 2**-52 is left
SOURCES = 50_000  # rates are broadcast up to this many sources


def rates(docs: DataFrame, source: str = "source", weights: dict[str | None, float] | None = None,
          power: float = POWER, epochs: float = 1.0) -> DataFrame:
    """One row per source: source, n_docs, rate (mean copies of each of its documents).

    The copies expected in all are ``epochs`` times the documents, shared out
    in proportion to the weights. ``weights`` that lack a source that occurs
    give it weight zero; a null source is a source of its own, under None.
    """
    sizes = docs.groupBy(F.col(f"`{source}`").alias("source")).agg(F.count("*").alias("n_docs"))
    if weights is None:
        weight = F.pow(F.col("n_docs").cast("double"), F.lit(float(power)))
    else:
        weight = F.lit(0.0)
        for name, w in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(weight)
    sizes = sizes.withColumn("weight", weight)
    total = sizes.agg(F.sum("n_docs").alias("n"), F.sum("weight").alias("w")).first()
    if not total["w"]:
        return sizes.select("source", "n_docs", F.lit(0.0).alias("rate"))
    share = F.col("weight") / F.lit(float(total["w"]))
    return sizes.select("source", "n_docs", (share * F.lit(float(epochs * total["n"])) / F.col("n_docs")).alias("rate"))


def _cumulative(mean: Column) -> Column:
    """P(X <= k) for k from 0 to TERMS - 1."""
    first = F.exp(-mean)

    def step(acc: Column, k: Column) -> Column:
        term = acc["term"] * mean / k
        upto = acc["upto"] + term
        return F.struct(term.alias("term"), upto.alias("upto"), F.concat(acc["all"], F.array(upto)).alias("all"))

    start = F.struct(first.alias("term"), first.alias("upto"), F.array(first).alias("all"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS - 1)), start, step, lambda acc: acc["all"])


def uniform(key: Column) -> Column:
    """A number in [0, 1) from 52 bits of the key's md5."""
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def document_key(id_col: str, text: str, seed: int) -> Column:
    """What a document's hashes start from: its id, or its text's md5 where the id is null."""
    of_text = F.concat(F.lit("text:"), F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")))
    return F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), of_text))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, id_col: str = "doc_id", text: str = "text",
        source: str = "source", power: float = POWER, epochs: float = 1.0, seed: int = SEED) -> DataFrame:
    """All columns of ``docs``, each row as often as it drew, with copy (int, from 1) and shuffle_key (string).

    The order by shuffle_key is the global order: rows go to partitions by
    its hash and are sorted by it there. Documents that draw zero are left
    out, as the weights ask. Repeated rows draw the same count each; input
    columns called copy or shuffle_key are replaced and all others stay,
    whatever their names; an empty table gives no rows. Rates are broadcast while there are at most SOURCES of them,
    beyond that the join shuffles by source and adaptive execution splits
    the hot ones.
    """
    of, draws, upto, own_key, n = own = free(docs, "source", "draws", "upto", "key", "count")
    table, _ = bounded(rates(docs, source, weights, power, epochs).select(
        F.col("source").alias(of), F.ceil(F.col("rate") / MEAN).cast("int").alias(draws),
        F.when(F.col("rate") > 0, _cumulative(F.col("rate") / F.ceil(F.col("rate") / MEAN))).alias(upto)), SOURCES)
    key = document_key(id_col, text, seed)
    # A draw is how many k have P(X <= k) at or below its uniform number.
    numbers = F.transform(F.sequence(F.lit(1), F.col(draws)),
                          lambda j: uniform(F.concat(own_key, F.lit(":"), j.cast("string"))))
    count = F.aggregate(numbers, F.lit(0), lambda sum_, u: sum_ + F.size(F.filter(upto, lambda p: p <= u)))
    drawn = docs.join(table, F.col(f"`{source}`").eqNullSafe(F.col(of))).where(F.col(draws) > 0) \
        .withColumn(own_key, key).withColumn(n, count).where(F.col(n) > 0)
    copies = drawn.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(n)))) \
        .withColumn("shuffle_key", F.md5(F.concat(own_key, F.lit(":order:"), F.col("copy").cast("string")))) \
        .drop(*own)
    return copies.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
