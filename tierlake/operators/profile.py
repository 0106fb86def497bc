"""Dataset profile and class distribution as small DataFrames (no driver loops)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def profile(df: DataFrame, distinct_col: str) -> DataFrame:
    """One row: row count, distinct values of ``distinct_col``, column count."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(distinct_col).alias("n_seasons" if distinct_col == "season" else f"n_{distinct_col}"),
        F.lit(len(df.columns)).alias("n_columns"),
    )


def class_balance(df: DataFrame, y: str) -> DataFrame:
    """Rows and share per class.  The share divides by a total taken over the
    already aggregated per-class rows (at most a handful), never over raw rows."""
    counts = df.groupBy(F.col(y).cast("int").alias(y)).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))
