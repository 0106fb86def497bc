"""Session helpers: a local session for tests/bench and the shared scratch root.

Library functions never set static confs; they take the session they are given.
``scratch_path`` resolves intermediate-output locations from the cluster's
``spark.checkpoint.dir`` (a shared filesystem on a real cluster) and only
falls back to a private temp dir when that setting is absent, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app: str = "tierlake", cpus: int | str = "*", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """A local-mode session with AQE on and the UI off (tests and bench only)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint root; set a private one only if none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # Local mode only: driver and executors are one process.
        configured = tempfile.mkdtemp(prefix="tierlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


# What this process has created, by application: released together.
_RUN = f"run-{uuid.uuid4().hex[:12]}"
_SCHEMAS: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path in this run's folder under the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "tierlake-scratch", _RUN, f"{name}-{uuid.uuid4().hex[:12]}")


def scratch_schema(spark: SparkSession, tag: str) -> str:
    """A fresh catalog schema located in this run's scratch folder."""
    name = f"tierlake_{tag}_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION '{scratch_path(spark, name)}'")
    _SCHEMAS.setdefault(spark.sparkContext.applicationId, []).append(name)
    return name


def release_scratch(spark: SparkSession) -> None:
    """Drop the schemas and delete the files that this run created; frames that still
    read them become invalid."""
    for name in _SCHEMAS.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
        os.path.join(ensure_checkpoint_dir(spark), "tierlake-scratch", _RUN))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df, name: str = "stage"):
    """Write ``df`` once as Parquet under the shared scratch root and read it back.

    Used where a frame is read several times (sampling, counting, two branches,
    many model passes): the plan runs once, later reads get column pruning and
    filter pushdown, and the lineage is cut, so a lost executor re-reads files
    instead of recomputing from the sources.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
