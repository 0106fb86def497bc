"""Small reusable expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bool_flag(cond: Column) -> Column:
    """``when(cond, True).otherwise(False)``: a NULL condition gives False, never NULL."""
    return F.when(cond, True).otherwise(False)


def count_if(cond: Column) -> Column:
    """Conditional count as ``sum(when(cond, 1).otherwise(0))`` (bigint, 0 on no match)."""
    return F.sum(F.when(cond, 1).otherwise(0))


def safe_div(num: Column, den: Column, zero: float | None = 0.0) -> Column:
    """``num / den`` as a double when ``den > 0``, else ``zero`` (NULL if ``zero`` is None)."""
    fallback = F.lit(None).cast("double") if zero is None else F.lit(float(zero))
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(fallback)


def surrogate_key(*cols: str, sep: str = "_") -> Column:
    """Text key ``concat_ws(sep, cast(c as string) ...)``; NULL parts are skipped."""
    return F.concat_ws(sep, *[F.col(c).cast("string") for c in cols])
