"""Order keys as ascending-comparable expressions (for struct / min comparisons)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType


def spec_parts(spec) -> tuple[str, bool]:
    """``"col"`` or ``("col", ascending)`` -> (name, ascending)."""
    return (spec, True) if isinstance(spec, str) else (spec[0], bool(spec[1]))


def ascending_key(df: DataFrame, spec) -> Column:
    """An expression whose ascending order is the spec's order.

    Descending keys are negated, so only numeric, date and timestamp columns can
    be descending.
    """
    name, asc = spec_parts(spec)
    if asc:
        return F.col(name)
    dtype = df.schema[name].dataType
    if isinstance(dtype, NumericType):
        return -F.col(name)
    if isinstance(dtype, DateType):
        return -F.unix_date(F.col(name))
    if isinstance(dtype, TimestampType):
        return -F.unix_micros(F.col(name))
    if isinstance(dtype, TimestampNTZType):
        # Zone-free microseconds since the epoch (no local-time conversion).
        return -F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)")
    raise ValueError(f"descending order on {dtype.simpleString()} column {name!r} is not supported")


def window_order(spec) -> Column:
    name, asc = spec_parts(spec)
    return F.col(name).asc() if asc else F.col(name).desc()


def count_at_or_below(x: Column, bounds: list) -> Column:
    """Number of ``bounds`` (sorted ascending; literals or literal Columns) that are <= x.

    A balanced CASE tree: a built-in, codegen'd expression with
    O(log len(bounds)) comparisons per row.
    """
    def lit(b):
        return b if isinstance(b, Column) else F.lit(b)

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2          # answer >= mid  <=>  x >= bounds[mid - 1]
        return F.when(x >= lit(bounds[mid - 1]), tree(mid, hi)).otherwise(tree(lo, mid - 1))
    return tree(0, len(bounds))
