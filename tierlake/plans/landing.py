"""Write the fixture's bronze frames as landing files in the reference's formats.

circuits / races -> header CSV, constructors / drivers -> JSON Lines,
results -> a directory of JSON Lines files (optionally one sub-directory per
season batch), sprints -> a directory of multi-line JSON files, each a
pretty-printed top-level array.  All writes are distributed Spark writes.
"""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.plans import fixtures as fx

FORMATS = {
    "circuits": ("csv", "circuits.csv"),
    "races": ("csv", "races.csv"),
    "constructors": ("json", "constructors.json"),
    "drivers": ("json", "drivers.json"),
    "results": ("json", "results"),
    "sprints": ("json_array", "sprints"),
}


def _json_arrays(batches):
    """mapInPandas body: the records of one partition as the lines of one JSON array,
    a batch at a time."""
    opened = False
    for b in batches:
        if len(b):
            first, rest = b["j"].iloc[0], b["j"].iloc[1:]
            yield pd.DataFrame({"value": [f"  ,{first}" if opened else f"[ {first}", *("  ," + rest)]})
            opened = True
    if opened:
        yield pd.DataFrame({"value": ["]"]})


def _spread(df: DataFrame, files: int | None) -> DataFrame:
    # ``None`` keeps the upstream partitioning (AQE-sized), so file count and
    # file size scale with the data instead of being fixed.
    return df if files is None else df.repartition(files)


def write_json_arrays(df: DataFrame, path: str, files: int | None = None) -> None:
    """One multi-line JSON array file per partition (a file is at most one partition)."""
    (_spread(df.select(F.to_json(F.struct(*df.columns)).alias("j")), files)
       .mapInPandas(_json_arrays, "value string")
       .write.mode("overwrite").text(path))


def write_landing(df: DataFrame, path: str, fmt: str, files: int | None = None,
                  batch_col: str | None = None) -> str:
    """Write ``df`` at ``path`` as ``csv``, ``json`` (JSON Lines) or ``json_array``."""
    if fmt == "csv":
        _spread(df, files).write.mode("overwrite").option("header", True).csv(path)
    elif fmt == "json_array":
        write_json_arrays(df, path, files)
    elif batch_col is not None:
        # Batch sub-directories (``batch=<value>``) named after a copy of the
        # column, so the records themselves stay complete.
        (_spread(df.withColumn("batch", F.col(batch_col)), files)
           .write.mode("overwrite").partitionBy("batch").json(path))
    else:
        _spread(df, files).write.mode("overwrite").json(path)
    return path


def land(df: DataFrame, root: str, name: str, files: int | None = None, batch_col: str | None = None) -> str:
    """Write one source under ``root`` in its landing format; returns its path."""
    fmt, rel = FORMATS[name]
    return write_landing(df, os.path.join(root, rel), fmt, files, batch_col)


def land_all(spark: SparkSession, sf_dir: str, root: str, files: int | None = None) -> dict[str, str]:
    """Land all six sources derived from the driver's tables under ``root``."""
    return {name: land(fx.bronze(spark, sf_dir, name), root, name, files) for name in FORMATS}
