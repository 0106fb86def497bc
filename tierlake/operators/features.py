"""Leak-free history features over ordered per-entity sequences.

All features are window aggregates whose frame ends one row (or one race)
before the current one, so a row never sees its own outcome.  The three window
families are applied constructor -> driver -> driver x circuit: the last two
share the ``driver_id`` hash partitioning.  A team's rows are not bounded - entries
without a team are one group - so the constructor family runs over halo buckets
(``operators.halo``) instead of a plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.functions.exprs import surrogate_key
from tierlake.operators import halo

# --- fixed values: feature names and frame sizes of the reference model --------
DRIVER_FRAME = 5        # rows -5 .. -1 per driver
CONSTRUCTOR_FRAME = 10  # rows -10 .. -1 per constructor (named "last10")
PRIOR_RACES = 5         # stated intent for the constructor: the previous 5 races

FEATURE_COLS = [
    "grid",
    "season", "round",
    "driver_avg_position_last5",
    "driver_avg_points_last5",
    "driver_podium_rate_last5",
    "driver_win_rate_last5",
    "driver_dnf_rate_last5",
    "constructor_avg_points_last10",
    "constructor_podium_rate_last10",
    "constructor_dnf_rate_last10",
    "driver_circuit_avg_position",
    "driver_circuit_races",
]
TARGET_COL = "is_podium"
FEATURE_TABLE_COLS = [
    "feature_key", "driver_id", "season", "round",
    "grid",
    "driver_avg_position_last5", "driver_avg_points_last5",
    "driver_podium_rate_last5", "driver_win_rate_last5", "driver_dnf_rate_last5",
    "constructor_avg_points_last10", "constructor_podium_rate_last10", "constructor_dnf_rate_last10",
    "driver_circuit_avg_position", "driver_circuit_races",
]
# feature name -> (source column, boolean outcome averaged as a 0/1 rate)
DRIVER_MEASURES = {
    "driver_avg_position_last5": ("position", False),
    "driver_avg_points_last5": ("points", False),
    "driver_podium_rate_last5": ("is_podium", True),
    "driver_win_rate_last5": ("is_winner", True),
    "driver_dnf_rate_last5": ("is_dnf", True),
}
CONSTRUCTOR_MEASURES = {
    "constructor_avg_points_last10": ("points", False),
    "constructor_podium_rate_last10": ("is_podium", True),
    "constructor_dnf_rate_last10": ("is_dnf", True),
}
# --- end fixed values ------------------------------------------------------------
BUCKET_ROUNDS = 16      # rounds of a season in one halo bucket


def _rate(col: str) -> Column:
    """A boolean outcome as 0/1 so its mean is a rate."""
    return F.col(col).cast("int")


def rolling_mean(df: DataFrame, measures: dict[str, Column], by: list[str], order: list[str],
                 n: int) -> DataFrame:
    """Mean of each measure over the ``n`` preceding rows (current row excluded).

    An empty frame (first row of an entity) gives NULL.  ``order`` must be a
    total order within ``by`` for the result to be deterministic.
    """
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(-n, -1)
    return df.withColumns({name: F.avg(expr).over(w) for name, expr in measures.items()})


def expanding_stats(df: DataFrame, col: str, by: list[str], order: list[str],
                    mean_name: str, count_name: str) -> DataFrame:
    """Mean of ``col`` and count of rows over all earlier rows (0 count when none)."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns({mean_name: F.avg(col).over(w), count_name: F.count("*").over(w)})


def measures(spec: dict[str, tuple[str, bool]]) -> dict[str, Column]:
    return {name: _rate(src) if as_rate else F.col(src) for name, (src, as_rate) in spec.items()}


def driver_form(df: DataFrame) -> DataFrame:
    # Plain window: silver results are unique on (season, round, driver), so a
    # driver's group - even a NULL driver's - has at most one row per race.
    return rolling_mean(df, measures(DRIVER_MEASURES), ["driver_id"], ["season", "round"], DRIVER_FRAME)


def circuit_history(df: DataFrame) -> DataFrame:
    # Keyed by circuit *name*: entries without a circuit form one NULL-name group.
    # Bounded like the driver window (at most one row per race), and it reuses
    # the driver window's hash partitioning (driver_id), so no extra exchange.
    return expanding_stats(df, "position", ["driver_id", "circuit_name"], ["season", "round"],
                           "driver_circuit_avg_position", "driver_circuit_races")


def season_buckets(rounds: int = BUCKET_ROUNDS) -> list[Column]:
    """Ordered buckets of (season, round): the season, then stretches of ``rounds`` rounds."""
    return [F.col("season"), F.floor(F.col("round") / F.lit(rounds))]


def constructor_form(df: DataFrame, mode: str = "rows") -> DataFrame:
    """``rows``: the previous 10 rows by (season, round), team-mates ordered by
    driver_id (parity with the reference's frame, which can see a team-mate's
    same-race result).  ``prior_races``: all cars of the previous 5 races.

    NULL teams form one group, as in any window; no group is one task's.
    """
    if mode == "rows":
        return halo.rolling_mean(df, measures(CONSTRUCTOR_MEASURES), ["constructor_id"],
                                 ["season", "round", "driver_id"], CONSTRUCTOR_FRAME, season_buckets())
    if mode == "prior_races":
        return halo.rolling_mean_of_events(df, measures(CONSTRUCTOR_MEASURES), ["constructor_id"], ["season", "round"],
                                           PRIOR_RACES, season_buckets())
    raise ValueError(f"unknown constructor mode {mode!r}")


FAMILIES = ("driver", "circuit", "constructor")
# What the families read or a consumer reports of an entry.
ENTRY_COLS = ["season", "round", "driver_id", "constructor_id", "circuit_name", "grid", "position", "points",
              "is_podium", "is_winner", "is_dnf"]
LABELS = ("driver_name", "race_name")


def podium_features(race_results: DataFrame, constructor_mode: str = "rows",
                    families: tuple[str, ...] = FAMILIES, labels: tuple[str, ...] = LABELS) -> DataFrame:
    """Classified entries (non-NULL position) with the history features of ``families``, and
    the named ``labels``.

    Entries without a position are removed *before* the windows, so history
    skips them.  The whole frame is lazy; name the families and labels that are needed:
    the constructor family reads its rows whole.
    """
    df = race_results.filter(F.col("position").isNotNull())
    if "constructor" in families:
        df = constructor_form(df.select(*ENTRY_COLS, *labels), constructor_mode)
    if "driver" in families:
        df = driver_form(df)
    return circuit_history(df) if "circuit" in families else df


def has_history(features: DataFrame) -> DataFrame:
    """Rows with at least one earlier classified race of the driver (drops each driver's first)."""
    return features.filter(F.col("driver_avg_position_last5").isNotNull())


def model_frame(features: DataFrame) -> DataFrame:
    """The modelling frame: features, target and two labels for reports."""
    return has_history(features).select(*FEATURE_COLS, TARGET_COL, "driver_name", "race_name", "driver_id")


def feature_table(features: DataFrame) -> DataFrame:
    """Keyed feature rows: ``feature_key`` = driver_season_round plus 14 columns."""
    df = has_history(features).withColumn("feature_key", surrogate_key("driver_id", "season", "round"))
    return df.select(*FEATURE_TABLE_COLS)
