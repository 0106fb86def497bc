"""Catalog-table, snapshot and local-row sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VERSION_COL = "_version"


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a catalog table by (up to three-part) name."""
    return spark.table(name)


def from_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """Turn a *bounded* list of local rows (e.g. a top-k report) into a DataFrame."""
    return spark.createDataFrame(rows, schema=schema)


def _list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the immediate sub-directories of ``path`` (one listing call, no job)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    return [st.getPath().getName() for st in fs.listStatus(hpath) if st.isDirectory()]


def version_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{VERSION_COL}={int(version)}"


def version_numbers(spark: SparkSession, path: str) -> list[int]:
    """Every version number in use under ``path``, loads that never committed included."""
    prefix = VERSION_COL + "="
    return sorted(int(n[len(prefix):]) for n in _list_dirs(spark, path)
                  if n.startswith(prefix) and n[len(prefix):].isdigit())


def _committed(spark: SparkSession, path: str, version: int) -> bool:
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{version_path(path, version)}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def snapshot_versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions: those whose own ``_SUCCESS`` marker the load has written."""
    return [v for v in version_numbers(spark, path) if _committed(spark, path, v)]


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Read one version of a snapshot table (``None`` = latest).

    Only that version's directory is listed and read, so the cost does not grow
    with the number of versions kept.  A version that was never committed does
    not exist.
    """
    versions = snapshot_versions(spark, path)
    if not versions or version is not None and version not in versions:
        raise FileNotFoundError(f"no snapshot {'' if version is None else version} under {path}")
    return spark.read.parquet(version_path(path, versions[-1] if version is None else version))
