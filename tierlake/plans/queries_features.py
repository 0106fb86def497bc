"""History-feature keys: rolling, expanding, combined features, feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierlake.operators import features as ft
from tierlake.plans import fixtures as fx
from tierlake.plans import oracle_sql as osql
from tierlake.plans.catalog import register
from tierlake.session import materialize, scratch_schema
from tierlake.sinks.tables import update_keyed_table, write_keyed_table
from tierlake.sources.tables import read_table

GOLD = osql.with_ctes(*osql.gold_prefix())
FEAT = osql.with_ctes(*osql.features_prefix())
KEYS = ["season", "round", "driver_id"]


def classified(spark, sf_dir):
    return fx.gold_race_results(spark, sf_dir).filter(F.col("position").isNotNull())


TEAM_COLS = [*KEYS, "constructor_id", "points", "is_podium", "is_dnf"]      # what the constructor family reads


def features(spark, sf_dir, labels=()):
    return ft.podium_features(fx.gold_race_results(spark, sf_dir), labels=labels)


@register("rolling_driver_form", GOLD + """
SELECT season, round, driver_id,
       avg(position) OVER dw AS driver_avg_position_last5,
       avg(points) OVER dw AS driver_avg_points_last5,
       avg(CAST(is_podium AS INTEGER)) OVER dw AS driver_podium_rate_last5,
       avg(CAST(is_winner AS INTEGER)) OVER dw AS driver_win_rate_last5,
       avg(CAST(is_dnf AS INTEGER)) OVER dw AS driver_dnf_rate_last5
FROM race_results WHERE position IS NOT NULL
WINDOW dw AS (PARTITION BY driver_id ORDER BY season, round ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)""")
def q_rolling_driver_form(spark, sf_dir):
    return ft.driver_form(classified(spark, sf_dir)).select(*KEYS, *ft.DRIVER_MEASURES)


@register("rolling_constructor_form", GOLD + """
SELECT season, round, driver_id, constructor_id,
       avg(points) OVER cw AS constructor_avg_points_last10,
       avg(CAST(is_podium AS INTEGER)) OVER cw AS constructor_podium_rate_last10,
       avg(CAST(is_dnf AS INTEGER)) OVER cw AS constructor_dnf_rate_last10
FROM race_results WHERE position IS NOT NULL
WINDOW cw AS (PARTITION BY constructor_id ORDER BY season, round, driver_id
              ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)""")
def q_rolling_constructor_form(spark, sf_dir):
    return ft.constructor_form(classified(spark, sf_dir).select(*TEAM_COLS), "rows").select(
        *KEYS, "constructor_id", *ft.CONSTRUCTOR_MEASURES)


@register("rolling_constructor_prior_races", GOLD + """, ordinals AS (
  SELECT *, dense_rank() OVER (PARTITION BY constructor_id ORDER BY season, round) AS race_no
  FROM race_results WHERE position IS NOT NULL
)
SELECT season, round, driver_id, constructor_id,
       avg(points) OVER pw AS constructor_avg_points_last10,
       avg(CAST(is_podium AS INTEGER)) OVER pw AS constructor_podium_rate_last10,
       avg(CAST(is_dnf AS INTEGER)) OVER pw AS constructor_dnf_rate_last10
FROM ordinals
WINDOW pw AS (PARTITION BY constructor_id ORDER BY race_no RANGE BETWEEN 5 PRECEDING AND 1 PRECEDING)""")
def q_rolling_constructor_prior_races(spark, sf_dir):
    return ft.constructor_form(classified(spark, sf_dir).select(*TEAM_COLS), "prior_races").select(
        *KEYS, "constructor_id", *ft.CONSTRUCTOR_MEASURES)


_HW = """
WINDOW hw AS (PARTITION BY driver_id, circuit_name ORDER BY season, round
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


@register("expanding_circuit_mean", GOLD + f"""
SELECT season, round, driver_id, circuit_name, avg(position) OVER hw AS driver_circuit_avg_position
FROM race_results WHERE position IS NOT NULL {_HW}""")
def q_expanding_circuit_mean(spark, sf_dir):
    return ft.circuit_history(classified(spark, sf_dir)).select(*KEYS, "circuit_name",
                                                                "driver_circuit_avg_position")


@register("expanding_circuit_count", GOLD + f"""
SELECT season, round, driver_id, circuit_name, count(*) OVER hw AS driver_circuit_races
FROM race_results WHERE position IS NOT NULL {_HW}""")
def q_expanding_circuit_count(spark, sf_dir):
    return ft.circuit_history(classified(spark, sf_dir)).select(*KEYS, "circuit_name", "driver_circuit_races")


_PF_COLS = ["season", "round", "driver_id", "constructor_id", "circuit_name", "grid",
            *ft.DRIVER_MEASURES, "driver_circuit_avg_position", "driver_circuit_races",
            *ft.CONSTRUCTOR_MEASURES, "is_podium"]


@register("podium_features", FEAT + f"SELECT {', '.join(_PF_COLS)} FROM features")
def q_podium_features(spark, sf_dir):
    return features(spark, sf_dir).select(*_PF_COLS)


@register("filter_has_history", osql.with_ctes(*osql.model_prefix()) + "SELECT * FROM model_frame")
def q_filter_has_history(spark, sf_dir):
    return ft.model_frame(features(spark, sf_dir, ft.LABELS))


@register("feature_table", FEAT + """
SELECT concat_ws('_', driver_id, CAST(season AS VARCHAR), CAST(round AS VARCHAR)) AS feature_key,
       driver_id, season, round, grid,
       driver_avg_position_last5, driver_avg_points_last5,
       driver_podium_rate_last5, driver_win_rate_last5, driver_dnf_rate_last5,
       constructor_avg_points_last10, constructor_podium_rate_last10, constructor_dnf_rate_last10,
       driver_circuit_avg_position, driver_circuit_races
FROM features WHERE driver_avg_position_last5 IS NOT NULL""")
def q_feature_table(spark, sf_dir):
    # Through the keyed sink: staged, its key validated, then published.
    name = f"{scratch_schema(spark, 'features')}.driver_race_features"
    write_keyed_table(ft.feature_table(features(spark, sf_dir)), name, ["feature_key"])
    return read_table(spark, name)


@register("feature_table_update", FEAT + f"""
SELECT concat_ws('_', driver_id, CAST(season AS VARCHAR), CAST(round AS VARCHAR)) AS feature_key,
       driver_id, season, round, grid + CASE WHEN season >= {fx.CUT_SEASON} AND round % 2 = 0 THEN 100 ELSE 0 END AS grid,
       driver_avg_position_last5, driver_circuit_races
FROM features WHERE driver_avg_position_last5 IS NOT NULL""")
def q_feature_table_update(spark, sf_dir):
    """The keyed table as first written without the newest rounds, then updated by the later
    seasons: changed rows replace their old ones, missing rows are added, other seasons stay."""
    name = f"{scratch_schema(spark, 'updated')}.driver_race_features"
    rows = ft.feature_table(features(spark, sf_dir)).select(
        "feature_key", "driver_id", "season", "round", "grid", "driver_avg_position_last5", "driver_circuit_races")
    rows = materialize(rows, "features")
    late, even = F.col("season") >= fx.CUT_SEASON, F.col("round") % 2 == 0
    update_keyed_table(rows.filter(~(late & (F.col("round") % 3 == 0))), name, ["feature_key"], "season")
    changed = rows.filter(late & (even | (F.col("round") % 3 == 0)))
    changed = changed.withColumn("grid", F.col("grid") + F.when(even, 100).otherwise(0))
    update_keyed_table(changed, name, ["feature_key"], "season")
    return read_table(spark, name)


@register("profile", GOLD + """
SELECT count(*) AS n_rows, count(DISTINCT season) AS n_seasons, 23 AS n_columns FROM race_results""")
def q_profile(spark, sf_dir):
    from tierlake.operators.profile import profile
    return profile(fx.gold_race_results(spark, sf_dir), "season")
