"""Source / sink keys: strict scans of landed files, tables, snapshots, lineage.

Each builder lands data derived from the driver's tables under a fresh path in
the shared scratch root (``spark.checkpoint.dir``), then returns the lazy read.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tierlake.operators import marts
from tierlake.plans import fixtures as fx
from tierlake.plans import landing
from tierlake.plans import oracle_sql as osql
from tierlake.plans.catalog import register
from tierlake.session import scratch_path, scratch_schema
from tierlake.sinks.tables import ensure_schema, overwrite_table, preview, write_snapshot
from tierlake.sources.files import read_csv_strict, read_json_strict
from tierlake.sources.lineage import add_ingestion_meta
from tierlake.sources.schemas import DRIVERS_SCHEMA, RESULTS_SCHEMA, SPRINTS_SCHEMA
from tierlake.sources.tables import from_rows, read_snapshot, read_table

def _top20_sql() -> str:
    from tierlake.plans.queries_gold import DRIVER_STANDINGS_SQL
    return (f"SELECT season, season_rank, driver_id, driver_name, total_points FROM ({DRIVER_STANDINGS_SQL}) "
            "ORDER BY season, season_rank, driver_id, constructor_name LIMIT 20")


RESULTS_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RESULTS_SCHEMA.fields)


def _bronze_sql(name: str, select: str | None = None) -> str:
    return osql.with_ctes(*osql.bronze_prefix(name)) + (select or f"SELECT * FROM bronze_{name}")


@register("scan_csv", _bronze_sql("results"))
def q_scan_csv(spark, sf_dir):
    path = landing.write_landing(fx.bronze(spark, sf_dir, "results"), scratch_path(spark, "results-csv"), "csv")
    return read_csv_strict(spark, path, RESULTS_SCHEMA)


@register("scan_json", _bronze_sql("results"))
def q_scan_json(spark, sf_dir):
    path = landing.write_landing(fx.bronze(spark, sf_dir, "results"), scratch_path(spark, "results-jsonl"), "json")
    return read_json_strict(spark, path, RESULTS_DDL)


@register("scan_json_nested", _bronze_sql("drivers", """
SELECT driverId, name.givenName AS name_givenName, name.familyName AS name_familyName,
       dateOfBirth, nationality, url FROM bronze_drivers"""))
def q_scan_json_nested(spark, sf_dir):
    # Read with the nested schema; the struct's fields are projected for the
    # comparison so the check does not depend on how a struct value is hashed.
    root = scratch_path(spark, "landing-nested")
    path = landing.land(fx.bronze(spark, sf_dir, "drivers"), root, "drivers")
    df = read_json_strict(spark, path, DRIVERS_SCHEMA)
    return df.select("driverId", F.col("name.givenName").alias("name_givenName"),
                     F.col("name.familyName").alias("name_familyName"), "dateOfBirth", "nationality", "url")


@register("scan_json_dir", _bronze_sql("results"))
def q_scan_json_dir(spark, sf_dir):
    root = scratch_path(spark, "landing-dir")
    path = landing.land(fx.bronze(spark, sf_dir, "results"), root, "results")
    return read_json_strict(spark, path, RESULTS_SCHEMA)


@register("scan_json_multiline", _bronze_sql("sprints"))
def q_scan_json_multiline(spark, sf_dir):
    root = scratch_path(spark, "landing-multiline")
    path = landing.land(fx.bronze(spark, sf_dir, "sprints"), root, "sprints")
    return read_json_strict(spark, path, SPRINTS_SCHEMA, multi_line=True)


@register("ingest_lineage", _bronze_sql("results", """
SELECT season, round, driverId, CAST(season AS INTEGER) AS source_batch, true AS has_ingested_at
FROM bronze_results"""))
def q_ingest_lineage(spark, sf_dir):
    root = scratch_path(spark, "landing-batches")
    path = landing.land(fx.bronze(spark, sf_dir, "results"), root, "results", batch_col="season")
    df = add_ingestion_meta(read_json_strict(spark, path, RESULTS_SCHEMA, recursive=True))
    return df.select(
        "season", "round", "driverId",
        F.regexp_extract("source_file", r"/batch=(\d+)/", 1).cast("int").alias("source_batch"),
        F.col("ingested_at").isNotNull().alias("has_ingested_at"),
    )


@register("scan_table", _bronze_sql("results"))
def q_scan_table(spark, sf_dir):
    name = f"{scratch_schema(spark, 'bronze')}.results"
    overwrite_table(fx.bronze(spark, sf_dir, "results"), name)
    return read_table(spark, name)


@register("table_roundtrip", osql.with_ctes(*osql.gold_prefix()) + "SELECT * FROM race_results")
def q_table_roundtrip(spark, sf_dir):
    name = f"{scratch_schema(spark, 'gold')}.race_results"
    overwrite_table(fx.gold_race_results(spark, sf_dir), name)
    return read_table(spark, name)


@register("ensure_schema", osql.with_ctes(*osql.gold_prefix()) + """
SELECT season, count(*) AS n_rows, 1 AS n_schemas, 1 AS n_tables FROM race_results GROUP BY season""")
def q_ensure_schema(spark, sf_dir):
    """A schema that is asked for three times is made once, and keeps the table written between."""
    name = scratch_schema(spark, "ensured")
    ensure_schema(spark, name)
    overwrite_table(fx.gold_race_results(spark, sf_dir), f"{name}.race_results")
    ensure_schema(spark, name)
    schemas = spark.sql(f"SHOW SCHEMAS LIKE '{name}'").count()
    tables = spark.sql(f"SHOW TABLES IN {name}").count()
    return read_table(spark, f"{name}.race_results").groupBy("season").agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(schemas).alias("n_schemas"), F.lit(tables).alias("n_tables"))


@register("snapshot_read", _bronze_sql("results"))
def q_snapshot_read(spark, sf_dir):
    path = scratch_path(spark, "snapshots")
    bronze = fx.bronze(spark, sf_dir, "results")
    first = write_snapshot(bronze, path)                                        # version 0
    write_snapshot(bronze.withColumn("status", F.upper("status")), path)        # version 1
    return read_snapshot(spark, path, version=first)


@register("scan_local_rows", _top20_sql())
def q_scan_local_rows(spark, sf_dir):
    # A bounded top-20 report brought to the driver and turned back into a frame.
    top = preview(marts.driver_standings(fx.gold_race_results(spark, sf_dir), sort=False),
                  20, ["season", "season_rank", "driver_id", "constructor_name"])
    top = top.select("season", "season_rank", "driver_id", "driver_name", "total_points")
    return from_rows(spark, top.collect(), top.schema)
