"""Daily summaries of timestamped trip (or order) tables: P10, P11, A9-A12, T2.

Column names are parameters; the defaults are the taxi-trip names. The year
filter is a half-open range on the raw timestamp so both bounds are pushed
into the parquet scan; grouping is on (year, month, day), whose cardinality
is tiny, so the partial aggregate leaves one row per day per task and the
shuffle is negligible at any input size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.time import year_range
from daybook.operators import percentile

# The output column names of the daily summary here and below.
DAY_KEYS = ["dt_year", "dt_month", "dt_day"]


def _with_day(df: DataFrame, ts: str) -> DataFrame:
    c = F.col(ts)
    return df.withColumns({"dt_year": F.year(c), "dt_month": F.month(c),
                           "dt_day": F.dayofmonth(c)})


def in_year(df: DataFrame, year: int | None, ts: str = "tpep_pickup_datetime") -> DataFrame:
    """rows of one calendar year (all rows when ``year`` is None)."""
    return df if year is None else df.where(year_range(df, ts, year))


def daily_summary(trips: DataFrame, year: int | None = None, *,
                  ts: str = "tpep_pickup_datetime", distance: str = "trip_distance",
                  tax: str = "mta_tax", fare: str = "fare_amount", tip: str = "tip_amount",
                  passengers: str = "passenger_count", q: float = 0.95,
                  accuracy: int = 10000, exact: bool = False,
                  newest_first: bool = True) -> DataFrame:
    """One row per day with trips, mean distance, max tax, p95 fare,
    min tip and the rounded-up mean passenger count.

    ``exact=True`` replaces the sketch percentile by the exact discrete one
    (``percentile_disc``); the two agree on day-sized groups.
    Sorted newest day first (T2) unless ``newest_first`` is False.
    """
    days = _with_day(in_year(trips, year, ts), ts)
    p95 = [] if exact else [percentile.approx(fare, q, accuracy).alias("q95_fare_amount")]
    out = days.groupBy(*DAY_KEYS).agg(
        F.count(F.lit(1)).alias("num_trips"),
        F.avg(distance).alias("mean_trip_distance"),
        F.max(tax).alias("max_mta_tax"), *p95,
        F.min(tip).alias("min_tip_amount"),
        F.ceil(F.avg(passengers)).alias("mean_passenger_count"))
    if exact:
        # Both sides have one row per day; a day whose fares are all NULL has no percentile.
        fares = percentile.exact(days.where(F.col(ts).isNotNull()), DAY_KEYS, fare, q, alias="q95_fare_amount")
        out = out.join(fares, DAY_KEYS, "left")
    out = out.select(*DAY_KEYS, "num_trips", "mean_trip_distance", "max_mta_tax",
                     "q95_fare_amount", "min_tip_amount", "mean_passenger_count")
    if newest_first:
        out = out.orderBy(*[F.col(k).desc() for k in DAY_KEYS])
    return out


def daily_overall(trips: DataFrame, year: int, ts: str = "tpep_pickup_datetime") -> DataFrame:
    """A11 + A12 in one scan: rows before and after the year filter, days
    with data, total and mean trips per day, first and last day.

    Rows are first counted per calendar day (tiny shuffle), then summed; the
    day range is min/max of the date (the reference took min month and min
    day independently, which can name a day that never occurs).
    """
    inside = year_range(trips, ts, year)
    per_day = (trips.groupBy(F.to_date(F.col(ts)).alias("day"))
               .agg(F.count(F.lit(1)).alias("n_all"),
                    F.count_if(inside).alias("n_year")))
    has = F.col("n_year") > 0
    return per_day.agg(
        F.sum("n_all").cast("bigint").alias("total_rows"),
        F.sum("n_year").cast("bigint").alias("rows_in_year"),
        F.count_if(has).alias("days_with_data"),
        F.sum("n_year").cast("bigint").alias("total_trips"),
        F.try_divide(F.sum("n_year").cast("double"), F.count_if(has)).alias("mean_daily_trips"),
        F.min(F.when(has, F.col("day"))).alias("first_day"),
        F.max(F.when(has, F.col("day"))).alias("last_day"),
    )


def percentile_by_year(trips: DataFrame, value: str, q: float = 0.95,
                       ts: str = "tpep_pickup_datetime") -> DataFrame:
    """A10 exact option on large groups: exact discrete percentile per year."""
    return percentile.exact(trips.withColumn("dt_year", F.year(ts)), ["dt_year"], value, q,
                            alias="p_exact")
