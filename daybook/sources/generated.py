"""SQL text over a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def sql_count(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Count ``df`` through SQL text. The name in the text is bound to the
    DataFrame for this query only: no view of the session is touched."""
    return spark.sql("SELECT COUNT(*) AS total FROM {input}", input=df)
