"""Shared column helpers of the text operators.

White space everywhere in this package is the six ASCII characters
``[\\x20\\x09-\\x0D]``; a word is a maximal run of anything else.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_SPACES = " \t\n\x0b\x0c\r"
SLICE_ROWS = 1000       # rows of an Arrow batch that become Python objects at a time


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def without_spaces(text: Column) -> Column:
    """``text`` with every ASCII white-space character deleted."""
    return F.translate(text, ASCII_SPACES, "")


def words(text: Column) -> Column:
    """Array of the words of ``text``: one literal split, no regular expression."""
    flat = F.translate(text, ASCII_SPACES, " " * len(ASCII_SPACES))
    return F.array_remove(F.split(flat, " "), "")


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``; nothing is copied."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` over all columns by position: column names need not be plain."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))]).mapInArrow(run, schema)
