"""Date parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_date(df: DataFrame, col: str, fmt: str = "yyyy-MM-dd", strict: bool = True) -> DataFrame:
    """Parse a text column into a date in place.

    ``strict=True`` uses ``to_date``: under ANSI mode a malformed string fails the
    query, NULL stays NULL.  ``strict=False`` uses ``try_to_date`` (bad -> NULL).
    """
    fn = F.to_date if strict else F.try_to_date
    return df.withColumn(col, fn(F.col(col), fmt))
