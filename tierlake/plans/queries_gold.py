"""Gold keys: star join pieces, flags, aggregates, ranks, standings, previews."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierlake.operators import marts
from tierlake.operators.conform import require_not_null
from tierlake.plans import fixtures as fx
from tierlake.plans import oracle_sql as osql
from tierlake.plans.catalog import register
from tierlake.sinks.tables import preview

GOLD = osql.with_ctes(*osql.gold_prefix())
A2 = osql.avg_2dp_sql
RECENT_SEASON = fx.CUT_SEASON


def rr(spark, sf_dir):
    return fx.gold_race_results(spark, sf_dir)


def silver(spark, sf_dir, name):
    return fx.silver(spark, sf_dir, name)


# --- the star join and its pieces ------------------------------------------------

@register("race_results", GOLD + "SELECT * FROM race_results")
def q_race_results(spark, sf_dir):
    return rr(spark, sf_dir)


@register("left_join_single", osql.with_ctes(*osql.silver_prefix("results", "drivers")) + """
SELECT r.season, r.round, r.driver_id, d.first_name, d.last_name, d.nationality AS driver_nationality
FROM silver_results r LEFT JOIN silver_drivers d ON r.driver_id = d.driver_id""")
def q_left_join_single(spark, sf_dir):
    df = marts.join_drivers(silver(spark, sf_dir, "results"), silver(spark, sf_dir, "drivers"))
    return df.select("season", "round", "driver_id", "first_name", "last_name", "driver_nationality")


@register("left_join_aliased", osql.with_ctes(*osql.silver_prefix("results", "constructors")) + """
SELECT r.season, r.round, r.driver_id, r.constructor_id, k.constructor_name,
       k.nationality AS constructor_nationality
FROM silver_results r LEFT JOIN silver_constructors k ON r.constructor_id = k.constructor_id""")
def q_left_join_aliased(spark, sf_dir):
    df = marts.join_constructors(silver(spark, sf_dir, "results"), silver(spark, sf_dir, "constructors"))
    return df.select("season", "round", "driver_id", "constructor_id", "constructor_name",
                     "constructor_nationality")


@register("left_join_composite", osql.with_ctes(*osql.silver_prefix("results", "races")) + """
SELECT r.season, r.round, r.driver_id, ra.circuit_id, ra.race_date
FROM silver_results r LEFT JOIN silver_races ra ON r.season = ra.season AND r.round = ra.round""")
def q_left_join_composite(spark, sf_dir):
    df = marts.join_races(silver(spark, sf_dir, "results"), silver(spark, sf_dir, "races"))
    return df.select("season", "round", "driver_id", "circuit_id", "race_date")


@register("left_join_snowflake", osql.with_ctes(*osql.silver_prefix("results", "races", "circuits")) + """
SELECT r.season, r.round, r.driver_id, ra.circuit_id, c.circuit_name, c.locality, c.country
FROM silver_results r
LEFT JOIN silver_races ra ON r.season = ra.season AND r.round = ra.round
LEFT JOIN silver_circuits c ON ra.circuit_id = c.circuit_id""")
def q_left_join_snowflake(spark, sf_dir):
    df = marts.join_races(silver(spark, sf_dir, "results"), silver(spark, sf_dir, "races"))
    df = marts.join_circuits(df, silver(spark, sf_dir, "circuits"))
    return df.select("season", "round", "driver_id", "circuit_id", "circuit_name", "locality", "country")


@register("race_flags", GOLD + """
SELECT season, round, driver_id, position, status, driver_name, positions_gained,
       is_winner, is_podium, is_dnf FROM race_results""")
def q_race_flags(spark, sf_dir):
    return rr(spark, sf_dir).select("season", "round", "driver_id", "position", "status", "driver_name",
                                    "positions_gained", "is_winner", "is_podium", "is_dnf")


@register("filter_not_null", GOLD + """
SELECT season, round, driver_id, position FROM race_results WHERE position IS NOT NULL""")
def q_filter_not_null(spark, sf_dir):
    return require_not_null(rr(spark, sf_dir), ["position"]).select("season", "round", "driver_id", "position")


# --- aggregates ---------------------------------------------------------------------

_BY_DRIVER = "GROUP BY season, driver_id"


@register("agg_sum", GOLD + f"""
SELECT season, driver_id, CAST(sum(points) AS DOUBLE) AS total_points FROM race_results {_BY_DRIVER}""")
def q_agg_sum(spark, sf_dir):
    return marts.season_stats(rr(spark, sf_dir), ["driver_id"], ["total_points"])


@register("agg_count", GOLD + f"""
SELECT season, driver_id, count(*) AS races_entered FROM race_results {_BY_DRIVER}""")
def q_agg_count(spark, sf_dir):
    return marts.season_stats(rr(spark, sf_dir), ["driver_id"], ["races_entered"])


@register("agg_count_distinct", GOLD + """
SELECT season, constructor_id, count(DISTINCT round) AS races_entered,
       count(DISTINCT driver_id) AS num_drivers
FROM race_results GROUP BY season, constructor_id""")
def q_agg_count_distinct(spark, sf_dir):
    return marts.season_stats(rr(spark, sf_dir), ["constructor_id"], ["races_entered", "num_drivers"],
                              races_entered="rounds_entered")


_COND_SQL = """CAST(sum(CASE WHEN is_winner THEN 1 ELSE 0 END) AS BIGINT) AS wins,
       CAST(sum(CASE WHEN is_podium THEN 1 ELSE 0 END) AS BIGINT) AS podiums,
       CAST(sum(CASE WHEN is_dnf THEN 1 ELSE 0 END) AS BIGINT) AS dnfs"""


@register("agg_conditional", GOLD + f"SELECT season, driver_id, {_COND_SQL} FROM race_results {_BY_DRIVER}")
def q_agg_conditional(spark, sf_dir):
    return marts.season_stats(rr(spark, sf_dir), ["driver_id"], ["wins", "podiums", "dnfs"])


@register("agg_min", GOLD + f"SELECT season, driver_id, min(position) AS best_finish FROM race_results {_BY_DRIVER}")
def q_agg_min(spark, sf_dir):
    return marts.season_stats(rr(spark, sf_dir), ["driver_id"], ["best_finish"])


@register("agg_avg_decimal", GOLD + f"""
SELECT season, driver_id, {A2('position')} AS avg_finish_position,
       {A2('positions_gained')} AS avg_positions_gained
FROM race_results {_BY_DRIVER}""")
def q_agg_avg_decimal(spark, sf_dir):
    return marts.season_stats(rr(spark, sf_dir), ["driver_id"], ["avg_finish_position", "avg_positions_gained"])


# --- standings and ranks ----------------------------------------------------------------

_DRIVER_AGG_SQL = f"""
SELECT season, driver_id, driver_name, driver_nationality, constructor_name,
       CAST(sum(points) AS DOUBLE) AS total_points,
       count(*) AS races_entered,
       {_COND_SQL},
       min(position) AS best_finish,
       {A2('position')} AS avg_finish_position,
       {A2('positions_gained')} AS avg_positions_gained
FROM race_results
GROUP BY season, driver_id, driver_name, driver_nationality, constructor_name"""

_CONSTRUCTOR_AGG_SQL = f"""
SELECT season, constructor_id, constructor_name, constructor_nationality,
       CAST(sum(points) AS DOUBLE) AS total_points,
       count(DISTINCT round) AS races_entered,
       count(DISTINCT driver_id) AS num_drivers,
       {_COND_SQL},
       min(position) AS best_finish,
       {A2('position')} AS avg_finish_position
FROM race_results
GROUP BY season, constructor_id, constructor_name, constructor_nationality"""

_RANK_SQL = ("CAST(rank() OVER (PARTITION BY season ORDER BY total_points DESC, wins DESC) AS INTEGER) "
             "AS season_rank")

DRIVER_STANDINGS_SQL = GOLD.rstrip() + f",\nds AS ({_DRIVER_AGG_SQL})\nSELECT *, {_RANK_SQL} FROM ds"
CONSTRUCTOR_STANDINGS_SQL = GOLD.rstrip() + f",\ncs AS ({_CONSTRUCTOR_AGG_SQL})\nSELECT *, {_RANK_SQL} FROM cs"


@register("driver_standings", DRIVER_STANDINGS_SQL)
def q_driver_standings(spark, sf_dir):
    return marts.driver_standings(rr(spark, sf_dir))


@register("constructor_standings", CONSTRUCTOR_STANDINGS_SQL)
def q_constructor_standings(spark, sf_dir):
    return marts.constructor_standings(rr(spark, sf_dir))


@register("rank_drivers", GOLD.rstrip() + f""",
ds AS ({_DRIVER_AGG_SQL})
SELECT season, driver_id, constructor_name, total_points, wins, {_RANK_SQL} FROM ds""")
def q_rank_drivers(spark, sf_dir):
    return marts.season_rank(marts.driver_season_stats(rr(spark, sf_dir)).select(
        "season", "driver_id", "constructor_name", "total_points", "wins"))


@register("rank_constructors", GOLD.rstrip() + f""",
cs AS ({_CONSTRUCTOR_AGG_SQL})
SELECT season, constructor_id, total_points, wins, {_RANK_SQL} FROM cs""")
def q_rank_constructors(spark, sf_dir):
    return marts.season_rank(marts.constructor_season_stats(rr(spark, sf_dir)).select(
        "season", "constructor_id", "total_points", "wins"))


@register("recent_standings", f"SELECT * FROM ({DRIVER_STANDINGS_SQL}) WHERE season >= {RECENT_SEASON}")
def q_recent_standings(spark, sf_dir):
    # A season is ranked by itself, so the filter goes below the rank and the joins.
    return marts.driver_standings(rr(spark, sf_dir).filter(F.col("season") >= RECENT_SEASON))


PREVIEW_ORDER = ["season", "season_rank", "driver_id", "constructor_name"]


@register("preview_sorted", f"""SELECT * FROM ({DRIVER_STANDINGS_SQL}) WHERE season >= {RECENT_SEASON}
ORDER BY season, season_rank, driver_id, constructor_name LIMIT 20""")
def q_preview_sorted(spark, sf_dir):
    recent = rr(spark, sf_dir).filter(F.col("season") >= RECENT_SEASON)
    return preview(marts.driver_standings(recent, sort=False), 20, PREVIEW_ORDER)
