"""Lineage columns added at ingestion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_ingestion_meta(df: DataFrame) -> DataFrame:
    """Add ``ingested_at`` (load time) and ``source_file`` (the row's file path).

    ``_metadata.file_path`` exists only directly over a file scan, so call this
    on the frame returned by a reader, before any join or aggregation.
    """
    return df.withColumns({
        "ingested_at": F.current_timestamp(),
        "source_file": F.col("_metadata.file_path"),
    })
