"""Guards and report formatting as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.util import as_col


def safe_ratio(num, den, scale: float = 1.0) -> Column:
    """``num * scale / den``, 0.0 when ``den`` is 0 or NULL."""
    n, d = as_col(num), as_col(den)
    return F.when(d > 0, n.cast("double") * F.lit(scale) / d).otherwise(F.lit(0.0))


def percent(num, den) -> Column:
    """Share in percent with a zero guard."""
    return safe_ratio(num, den, 100.0)


def report_line(no: int, text) -> Column:
    """One ``(line_no, text)`` struct of a text report."""
    t = text if isinstance(text, Column) else F.lit(text)
    return F.struct(F.lit(no).alias("line_no"), t.alias("text"))
