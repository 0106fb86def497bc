"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def initcap_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Title-case each listed column with Spark's ``initcap``.

    Semantics kept on purpose: the tail of every word is lower-cased
    (``mcLaren`` -> ``Mclaren``) and only the space character separates words.
    """
    return df.withColumns({c: F.initcap(F.col(c)) for c in cols})
