"""Table sinks: schema creation, overwrite, keyed writes, snapshots, previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierlake.sources.tables import version_numbers, version_path


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` (idempotent); ``location`` for a shared path."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{loc}")


def overwrite_table(df: DataFrame, name: str, strict_schema: bool = True, fmt: str = "parquet") -> None:
    """Full-refresh a catalog table.

    Parquet tables accept a changed schema silently on overwrite, so with
    ``strict_schema`` an existing table must have the same column names and
    types.  The frame must not read the table it replaces.
    """
    spark = df.sparkSession
    if strict_schema and spark.catalog.tableExists(name):
        old = spark.table(name).schema
        if [(f.name, f.dataType) for f in old.fields] != [(f.name, f.dataType) for f in df.schema.fields]:
            raise ValueError(f"schema of {name} would change: {old.simpleString()} -> {df.schema.simpleString()}")
    df.write.format(fmt).mode("overwrite").saveAsTable(name)


def check_keys(df: DataFrame, keys: list[str]) -> dict:
    """One aggregate: rows, distinct keys and rows with a NULL key part."""
    null_key = F.greatest(*[F.col(k).isNull().cast("int") for k in keys]) if len(keys) > 1 \
        else F.col(keys[0]).isNull().cast("int")
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(*[F.col(k) for k in keys]).alias("distinct_keys"),
        F.sum(null_key).alias("null_keys"),
    ).first()
    return {"rows": row["rows"], "distinct_keys": row["distinct_keys"], "null_keys": row["null_keys"] or 0}


def append_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Append to a catalog table, creating it on first use."""
    df.write.format(fmt).mode("append").saveAsTable(name)


def write_keyed_table(df: DataFrame, name: str, keys: list[str], strict_schema: bool = True) -> dict:
    """Replace ``name`` by ``df`` if ``keys`` is a primary key (unique, non-NULL).

    The load goes to a staging table first and its key columns are checked
    there, so the input plan runs once and a bad load raises while the last good
    table stays as it was.
    """
    spark = df.sparkSession
    staging = f"{name}__staging"
    spark.sql(f"DROP TABLE IF EXISTS {staging}")
    overwrite_table(df, staging)
    try:
        stats = check_keys(spark.table(staging), keys)
        # count(DISTINCT a, b) skips rows with any NULL part.
        if stats["null_keys"] or stats["distinct_keys"] != stats["rows"]:
            raise ValueError(f"{keys} is not a primary key of {name}: {stats}")
        overwrite_table(spark.table(staging), name, strict_schema)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
    return stats


def _same_key(a: DataFrame, b: DataFrame, keys: list[str], how: str) -> DataFrame:
    return a.join(b.select(*keys), keys, how)


def update_keyed_table(df: DataFrame, name: str, keys: list[str], partition: str) -> dict:
    """Create the keyed table ``name``, or update it by the rows of ``df``: a row whose key is
    there replaces the old one, any other is added, rows of no new key stay.

    The table is partitioned by ``partition``, a column that belongs to a row's identity (a
    season): only the partitions that the batch touches are read and rewritten, the files of
    all others stay as they are.  The batch goes to a staging table first and is checked
    there: keys must be unique and non-NULL, the partition non-NULL, and a key that is in the
    table must be in the same partition; else nothing changes.  The new content of the
    touched partitions is written in full before it is published by one dynamic partition
    overwrite, so the plan never reads what it replaces.  One writer per table at a time.
    """
    spark = df.sparkSession
    batch_name, merged_name = f"{name}__batch", f"{name}__merged"
    for t in (batch_name, merged_name):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    overwrite_table(df, batch_name)
    try:
        batch = spark.table(batch_name)
        stats = check_keys(batch, keys)
        homeless = batch.filter(F.col(partition).isNull()).limit(1).count()
        if stats["null_keys"] or homeless or stats["distinct_keys"] != stats["rows"]:
            raise ValueError(f"{keys} is not a primary key of the batch for {name}, or {partition} is NULL: {stats}")
        if not spark.catalog.tableExists(name):
            batch.write.format("parquet").partitionBy(partition).saveAsTable(name)
            return {**stats, "updated": 0, "inserted": stats["rows"], "partitions": None}
        table = spark.table(name)
        if {(f.name, f.dataType) for f in table.schema.fields} != {(f.name, f.dataType) for f in batch.schema.fields}:
            raise ValueError(f"schema of {name} would change: {table.schema.simpleString()} -> {batch.schema.simpleString()}")
        touched = [r[0] for r in batch.select(partition).distinct().collect()]      # partition values of one batch
        inside = F.col(partition).isin(touched)
        if _same_key(table.filter(~inside).select(*keys), batch, keys, "left_semi").limit(1).count():
            raise ValueError(f"a key of the batch for {name} is in another {partition}")
        old = table.filter(inside)
        updated = _same_key(old.select(*keys), batch, keys, "left_semi").count()
        merged = _same_key(old, batch, keys, "left_anti").unionByName(batch)
        overwrite_table(merged, merged_name)
        setting = "spark.sql.sources.partitionOverwriteMode"
        mode = spark.conf.get(setting)
        spark.conf.set(setting, "dynamic")
        try:
            spark.table(merged_name).select(*table.columns).write.insertInto(name, overwrite=True)
        finally:
            spark.conf.set(setting, mode)
        return {**stats, "updated": updated, "inserted": stats["rows"] - updated, "partitions": len(touched)}
    finally:
        for t in (batch_name, merged_name):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def write_snapshot(df: DataFrame, path: str) -> int:
    """Append ``df`` as the next version of a snapshot table; returns its number.

    Each load is one ``_version=n`` directory that counts once its own ``_SUCCESS``
    marker is there; the number of a load that died is not used again, and an
    empty load is a version like any other.  One writer per path at a time.
    """
    used = version_numbers(df.sparkSession, path)
    version = used[-1] + 1 if used else 0
    df.write.parquet(version_path(path, version))
    return version


def preview(df: DataFrame, n: int, order_by: list) -> DataFrame:
    """First ``n`` rows under a total order (planned as a distributed top-k)."""
    return df.orderBy(*order_by).limit(n)
