"""Silver conformance keys and scalar-function keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierlake.functions.dates import parse_date
from tierlake.functions.exprs import surrogate_key
from tierlake.functions.text import initcap_columns
from tierlake.operators.conform import RESULT_NAMES, flatten_struct, rename_columns
from tierlake.operators.dedupe import dedupe
from tierlake.plans import fixtures as fx
from tierlake.plans import oracle_sql as osql
from tierlake.plans.catalog import register

IC = osql.initcap_sql
GOLD = osql.with_ctes(*osql.gold_prefix())


def _bronze(name: str, select: str) -> str:
    return osql.with_ctes(*osql.bronze_prefix(name)) + select


def _silver(name: str, select: str) -> str:
    return osql.with_ctes(*osql.silver_prefix(name)) + select


@register("project", GOLD + "SELECT season, round, driver_id, grid, position, points FROM race_results")
def q_project(spark, sf_dir):
    return fx.gold_race_results(spark, sf_dir).select("season", "round", "driver_id", "grid", "position", "points")


@register("drop_columns", _bronze("results", "SELECT * EXCLUDE (url) FROM bronze_results"))
def q_drop_columns(spark, sf_dir):
    return fx.bronze(spark, sf_dir, "results").drop("url")


@register("rename_columns", _bronze("results", """
SELECT date, raceName AS race_name, round, season, url, constructorId AS constructor_id,
       driverId AS driver_id, grid, laps, number, points, position,
       positionText AS position_text, status FROM bronze_results"""))
def q_rename_columns(spark, sf_dir):
    # ``nonexistent`` is absent from the frame and therefore ignored.
    return rename_columns(fx.bronze(spark, sf_dir, "results"), {**RESULT_NAMES, "nonexistent": "x"})


@register("flatten_struct", _bronze("drivers", """
SELECT driverId, dateOfBirth, nationality, url, name.givenName AS first_name,
       name.familyName AS last_name FROM bronze_drivers"""))
def q_flatten_struct(spark, sf_dir):
    return flatten_struct(fx.bronze(spark, sf_dir, "drivers"), "name",
                          {"givenName": "first_name", "familyName": "last_name"})


@register("derive_columns", _bronze("results", f"""
SELECT * REPLACE ({IC('raceName')} AS raceName, {IC('status')} AS status),
       grid - position AS positions_gained
FROM bronze_results"""))
def q_derive_columns(spark, sf_dir):
    df = fx.bronze(spark, sf_dir, "results")
    return df.withColumns({
        "raceName": F.initcap("raceName"),
        "status": F.initcap("status"),
        "positions_gained": F.col("grid") - F.col("position"),
    })


_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register("dedupe_single", """
SELECT * FROM orders QUALIFY row_number() OVER (
  PARTITION BY o_custkey
  ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey ASC NULLS FIRST, o_orderstatus ASC NULLS FIRST,
           o_totalprice ASC NULLS FIRST, o_orderdate ASC NULLS FIRST, o_orderpriority ASC NULLS FIRST) = 1""")
def q_dedupe_single(spark, sf_dir):
    """Latest order per customer (ties: lowest order key)."""
    return dedupe(fx.table(spark, sf_dir, "orders"), ["o_custkey"], [("o_orderdate", False), "o_orderkey"])


_LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate"]


@register("dedupe_composite", "SELECT * FROM lineitem QUALIFY row_number() OVER ("
          "PARTITION BY l_orderkey, l_linenumber ORDER BY "
          + ", ".join(f"{c} ASC NULLS FIRST" for c in _LI_REST) + ") = 1")
def q_dedupe_composite(spark, sf_dir):
    """One row per (l_orderkey, l_linenumber); survivor = smallest remaining row."""
    return dedupe(fx.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("fn_initcap", _bronze("results", f"""
SELECT season, round, driverId, {IC('raceName')} AS race_name, {IC('status')} AS status
FROM bronze_results"""))
def q_fn_initcap(spark, sf_dir):
    df = fx.bronze(spark, sf_dir, "results").select(
        "season", "round", "driverId", F.col("raceName").alias("race_name"), "status")
    return initcap_columns(df, ["race_name", "status"])


@register("fn_concat_ws", GOLD + "SELECT season, round, driver_id, driver_name FROM race_results")
def q_fn_concat_ws(spark, sf_dir):
    return fx.gold_race_results(spark, sf_dir).select("season", "round", "driver_id", "driver_name")


@register("fn_surrogate_key", _silver("results", """
SELECT concat_ws('_', driver_id, CAST(season AS VARCHAR), CAST(round AS VARCHAR)) AS feature_key,
       driver_id, season, round FROM silver_results"""))
def q_fn_surrogate_key(spark, sf_dir):
    df = fx.silver(spark, sf_dir, "results")
    return df.select(surrogate_key("driver_id", "season", "round").alias("feature_key"),
                     "driver_id", "season", "round")


@register("fn_subtract", _silver("results", """
SELECT season, round, driver_id, grid, position, grid - position AS positions_gained FROM silver_results"""))
def q_fn_subtract(spark, sf_dir):
    df = fx.silver(spark, sf_dir, "results")
    return df.select("season", "round", "driver_id", "grid", "position",
                     (F.col("grid") - F.col("position")).alias("positions_gained"))


@register("fn_to_date", _bronze("sprints", """
SELECT season, round, driverId, CAST(strptime(date, '%Y-%m-%d') AS DATE) AS date FROM bronze_sprints"""))
def q_fn_to_date(spark, sf_dir):
    df = fx.bronze(spark, sf_dir, "sprints").select("season", "round", "driverId", "date")
    return parse_date(df, "date", "yyyy-MM-dd")


@register("fn_casts", GOLD + """
SELECT season, round, driver_id, CAST(is_podium AS INTEGER) AS is_podium_int,
       CAST(season AS VARCHAR) AS season_text, CAST(points AS DECIMAL(10,2)) AS points_dec
FROM race_results""")
def q_fn_casts(spark, sf_dir):
    df = fx.gold_race_results(spark, sf_dir)
    return df.select("season", "round", "driver_id",
                     F.col("is_podium").cast("int").alias("is_podium_int"),
                     F.col("season").cast("string").alias("season_text"),
                     F.col("points").cast("decimal(10,2)").alias("points_dec"))


@register("fn_fillna", GOLD + """
SELECT season, round, driver_id, coalesce(position, 0) AS position,
       coalesce(positions_gained, 0) AS positions_gained FROM race_results""")
def q_fn_fillna(spark, sf_dir):
    df = fx.gold_race_results(spark, sf_dir).fillna(0, subset=["position", "positions_gained"])
    return df.select("season", "round", "driver_id", "position", "positions_gained")
