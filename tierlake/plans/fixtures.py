"""Race-shaped landing data derived from the driver's TPC-H-style tables.

The reference ingests motor-racing landing files; the test data are TPC-H-style
parquet tables.  This module maps one onto the other with plain DataFrame
operations so every query's work grows with the input tables:

* an *entry* (one driver in one race) is a (season, month, supplier) group of
  ``lineitem JOIN orders``: season = year(o_orderdate), driver = l_suppkey;
* suppliers are dealt to grids of 20 (``l_suppkey div 20``) and every grid races
  once a month: round = month + 12 * grid block.  So races, teams and drivers
  multiply with the input while a race keeps at most 20 cars, a team two or
  three and a driver one entry per month - every window group stays bounded;
* laps = rows in the group, points = sum(l_quantity) (integer-valued, exact);
* grid = row_number in the race by (min(l_extendedprice), driver);
* finishing order = row_number in the race by (points desc, driver);
  every 5th lap count (laps % 5 = 0) retires (NULL position, text 'R'),
  laps % 5 = 1 finishes '+1 LAP' behind, the rest 'finished'; laps % 9 = 4 has a
  NULL status;
* team = ``l_suppkey div 2``, with a mid-season switch to the next team for every
  10th driver (the last one to a team without a dimension row) and a NULL team
  for ``l_suppkey % 13 = 5`` in March;
* laps % 4 = 3 lands twice: the second row has number + 100 and is 'disqualified';
* the result date is the first day of the race month; sprint entries are the
  same grid with half the points and the date as text;
* drivers = supplier x nation (some without a family name, some without any
  name), teams = supplier pairs x nation x region, races = the distinct
  (season, round) of the entries, circuits = regions; every sixth
  (season + round) points to a circuit that does not exist, so the left join
  keeps those races with NULLs.

Every frame is landing-shaped: the column names and types of the declared
landing schemas in ``tierlake.sources.schemas``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GRID_CARS = 20
# The derived calendar's cut between train and test (the tables span 1995-2001).
CUT_SEASON = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ordered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def _round(month: Column, driver_key: Column) -> Column:
    return month + 12 * F.floor(driver_key / GRID_CARS).cast("int")


def _entry_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = (
        _ordered_lines(spark, sf_dir)
        .groupBy(
            F.year("o_orderdate").alias("season"),
            F.month("o_orderdate").alias("month"),
            F.col("l_suppkey").alias("driver_key"),
        )
        .agg(
            F.count("*").cast("int").alias("laps"),
            F.sum("l_quantity").alias("qty"),
            F.min("l_extendedprice").alias("min_price"),
            F.min("o_orderdate").cast("date").alias("first_date"),
        )
    )
    return groups.withColumn("round", _round(F.col("month"), F.col("driver_key")))


def ranked_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(season, month, round, driver_key, laps, qty, grid, finish, team_key), lazily."""
    race = Window.partitionBy("season", "round")
    switch = F.when((F.col("month") > 6) & (F.col("driver_key") % 10 == 0), 1).otherwise(0)
    no_team = (F.col("month") == 3) & (F.col("driver_key") % 13 == 5)
    return _entry_groups(spark, sf_dir).withColumns({
        "grid": F.row_number().over(race.orderBy("min_price", "driver_key")),
        "finish": F.row_number().over(race.orderBy(F.desc("qty"), "driver_key")),
        "team_key": F.when(~no_team, F.floor(F.col("driver_key") / 2) + switch),
    })


def _result_rows(entries: DataFrame, date_as_text: bool, points: F.Column) -> DataFrame:
    copies = F.sequence(F.lit(0), F.when(F.col("laps") % 4 == 3, 1).otherwise(0))
    entries = entries.withColumn("copy", F.explode(copies))
    retired = F.col("laps") % 5 == 0
    position = F.when(~retired, F.col("finish"))
    date = F.make_date(F.col("season"), F.col("month"), F.lit(1))
    status = (F.when(F.col("copy") == 1, "disqualified")
              .when(F.col("laps") % 9 == 4, F.lit(None).cast("string"))
              .when(retired, "retired").when(F.col("laps") % 5 == 1, "+1 LAP").otherwise("finished"))
    return entries.select(
        (F.date_format(date, "yyyy-MM-dd") if date_as_text else date).alias("date"),
        F.concat(F.lit("grand prix "), F.col("round").cast("string")).alias("raceName"),
        F.col("round").cast("int").alias("round"),
        F.col("season").cast("int").alias("season"),
        F.concat_ws("/", F.lit("results"), F.col("season"), F.col("round"), F.col("driver_key")).alias("url"),
        F.col("team_key").cast("string").alias("constructorId"),
        F.col("driver_key").cast("string").alias("driverId"),
        F.col("grid").cast("int").alias("grid"),
        F.col("laps").cast("int").alias("laps"),
        (F.col("driver_key") % 100 + 100 * F.col("copy")).cast("int").alias("number"),
        points.cast("float").alias("points"),
        position.cast("int").alias("position"),
        F.coalesce(position.cast("string"), F.lit("R")).alias("positionText"),
        status.alias("status"),
    )


def bronze_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _result_rows(ranked_entries(spark, sf_dir), False, F.col("qty"))


def bronze_sprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sprint entries: the same grid, half the points, the date as text."""
    return _result_rows(ranked_entries(spark, sf_dir), True, F.col("qty") / 2)


def bronze_drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("s_suppkey").cast("string").alias("driverId"),
        F.struct(F.when(F.col("s_suppkey") % 27 != 4, F.substring("s_name", 1, 8)).alias("givenName"),
                 F.when(F.col("s_suppkey") % 9 != 4, F.expr("substring(s_name, 10)")).alias("familyName")).alias("name"),
        F.date_add(F.lit("1960-01-01").cast("date"), (F.col("s_suppkey") % 7300).cast("int")).alias("dateOfBirth"),
        F.lower("n_name").alias("nationality"),
        F.concat(F.lit("drivers/"), F.col("s_suppkey").cast("string")).alias("url"),
    )


def bronze_constructors(spark: SparkSession, sf_dir: str) -> DataFrame:
    teams = table(spark, sf_dir, "supplier").groupBy(F.floor(F.col("s_suppkey") / 2).alias("team")).agg(
        F.min("s_nationkey").alias("nation"))
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    joined = teams.join(n, F.col("nation") == F.col("n_nationkey"), "left").join(
        r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return joined.select(
        F.col("team").cast("string").alias("constructorId"),
        F.concat_ws(" ", "n_name", F.lit("team"), F.col("team").cast("string")).alias("name"),
        F.col("r_name").alias("nationality"),
        F.concat(F.lit("constructors/"), F.col("team").cast("string")).alias("url"),
    )


def bronze_races(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Straight from the lines: a race is far fewer rows than its entries.
    races = _ordered_lines(spark, sf_dir).groupBy(
        F.year("o_orderdate").alias("season"),
        _round(F.month("o_orderdate"), F.col("l_suppkey")).alias("round"),
    ).agg(F.min("o_orderdate").cast("date").alias("date"))
    return races.select(
        F.col("season").cast("int").alias("season"),
        F.col("round").cast("string").alias("round"),
        F.concat_ws("/", F.lit("races"), F.col("season"), F.col("round")).alias("url"),
        F.concat(F.lit("grand prix "), F.col("round").cast("string")).alias("raceName"),
        F.col("date"),
        ((F.col("season") + F.col("round")) % 6).cast("string").alias("circuitId"),
    )


def bronze_circuits(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    return r.select(
        F.col("r_regionkey").cast("string").alias("circuitId"),
        F.concat(F.lit("circuits/"), F.col("r_regionkey").cast("string")).alias("url"),
        F.col("r_name").alias("circuitName"),
        (F.col("r_regionkey") * 10.5).cast("double").alias("lat"),
        (F.col("r_regionkey") * -3.25).cast("double").alias("long"),
        F.concat(F.lower("r_name"), F.lit(" city")).alias("locality"),
        F.col("r_name").alias("country"),
    )


BRONZE_BUILDERS = {
    "circuits": bronze_circuits,
    "races": bronze_races,
    "constructors": bronze_constructors,
    "drivers": bronze_drivers,
    "results": bronze_results,
    "sprints": bronze_sprints,
}


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return BRONZE_BUILDERS[name](spark, sf_dir)


def silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from tierlake.operators.conform import CONFORMERS
    return CONFORMERS[name](bronze(spark, sf_dir, name))


def gold_race_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tierlake.operators.marts import race_results
    return race_results(*(silver(spark, sf_dir, n) for n in ("results", "drivers", "constructors", "races", "circuits")))
