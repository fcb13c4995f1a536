"""Small tables that every operator must take: nulls, blanks, long texts, repeated rows, clashing columns."""

from pyspark.sql import SparkSession
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def words(n: int, seed: int = 0, kinds: int = 400) -> str:
    """Invented prose: n words, no long run of which repeats."""
    out, x = [], seed * 7919 + 1
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        k = (x >> 8) % kinds
        out.append("".join("bcdfglmnprst"[(k // 12 ** i + i) % 12] + "aeiou"[(k + i) % 5] for i in range(2 + k % 3)))
    return " ".join(out)


ODD = [
    (1, words(60, 1), "en", "a", 300),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, " \t\n ", "en", "b", 4),
    (None, words(40, 4), "en", "b", 200),
    (5, words(60, 1), "en", "a", 300),
    (5, words(60, 1), "en", "a", 300),
    (6, words(30_000, 6), "fr", "c", 200_000),
    (7, "Kelvin K É 中文 <|endoftext|> x\u0085y z", None, "c", 9),
    (8, "one", "de", None, 3),
    (9, "ha " * 300, "en", "a", 900),
]


def docs(spark: SparkSession, rows=ODD, clash: tuple[str, ...] = ()):
    df = spark.createDataFrame(rows, DOCS)
    for name in clash:
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit("theirs"))
    return df
