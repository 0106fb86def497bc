"""Strict landing-file readers (CSV, JSON Lines, multi-line JSON).

A declared schema is always given (no inference job), and ``mode=FAILFAST``
makes a malformed record fail the load.  FAILFAST only fires for columns that
are actually parsed, so callers project every column into the write (bronze
keeps all of them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv_strict(spark: SparkSession, path: str, schema: StructType | str, header: bool = True,
                    strict_header: bool = False) -> DataFrame:
    """Header CSV bound to ``schema`` by position.

    ``strict_header=True`` also checks the header names against the schema
    (``enforceSchema=false``); by default the header line is only skipped.
    """
    reader = (spark.read.format("csv").option("header", header).option("mode", "FAILFAST")
              .option("enforceSchema", not strict_header).schema(schema))
    return reader.load(path)


def read_json_strict(spark: SparkSession, path: str, schema: StructType | str,
                     multi_line: bool = False, recursive: bool = False) -> DataFrame:
    """JSON bound to ``schema`` by name; ``path`` may be a file or a directory.

    ``multi_line=True`` reads each file as one document (an object or a
    top-level array of records); such files are not splittable, so land many
    moderate files rather than one large one.  ``recursive=True`` reads nested
    batch directories without inferring partition columns from their names.
    """
    reader = spark.read.format("json").option("mode", "FAILFAST").schema(schema)
    if multi_line:
        reader = reader.option("multiLine", True)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.load(path)
