"""Time helpers: pushdown-friendly year ranges, seconds between."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.util import as_col


def year_range(df: DataFrame, ts: str, year: int) -> Column:
    """F4 as a half-open range ``[year-01-01, year+1-01-01)`` on the raw column.

    Same rows as ``year(ts) == year`` but both bounds reach the parquet reader
    as pushed filters (row-group skipping); ``year(ts)`` would not. Bounds are
    cast to the column's own type (NTZ or session-zone timestamp, or date).
    """
    dtype = df.schema[ts].dataType
    lo = F.lit(f"{year:04d}-01-01 00:00:00").cast(dtype)
    hi = F.lit(f"{year + 1:04d}-01-01 00:00:00").cast(dtype)
    c = F.col(ts)
    return (c >= lo) & (c < hi)


EPOCH = "2000-01-01"


def wall_seconds(ts) -> Column:
    """Whole seconds on the wall clock since EPOCH, as a bigint.

    The fields are taken from the zone-free timestamp: a difference function
    would go through the session zone, in which a time may not exist.
    """
    t = as_col(ts).cast("timestamp_ntz")
    day = F.date_diff(t.cast("date"), F.lit(EPOCH).cast("date")).cast("bigint")
    return day * 86_400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def wall_time(seconds: Column) -> Column:
    """The zone-free timestamp so many seconds after EPOCH."""
    return F.lit(f"{EPOCH} 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def seconds_between(start, end) -> Column:
    """Wall-clock seconds from ``start`` to ``end`` as a double.

    On TIMESTAMP_NTZ inputs the difference is computed without any zone, so a
    daylight-saving change in the session zone cannot shift it.
    """
    def fraction(ts) -> Column:
        of = F.date_part(F.lit("SECOND"), as_col(ts).cast("timestamp_ntz"))
        return of - F.floor(of)

    return ((wall_seconds(end) - wall_seconds(start)) + (fraction(end) - fraction(start))).cast("double")
