"""Small reports over scored predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_COLS = ["race_name", "driver_name", "grid", "predicted_podium_prob", "predicted_podium", "is_podium"]


def latest_season_topk(scored: DataFrame, k: int = 20, season: str = "season",
                       prob: str = "predicted_podium_prob") -> DataFrame:
    """The ``k`` most probable podiums of the newest season (ties: season, round, driver).

    The newest season is a one-row aggregate joined back on ``season`` (an
    equi-join with a one-row broadcast side), and ``orderBy + limit`` plans as
    a distributed top-k (each task keeps k rows).
    """
    latest = scored.agg(F.max(season).alias(season))
    top = scored.join(F.broadcast(latest), season)
    return top.orderBy(F.desc(prob), season, "round", "driver_id").limit(k).select(*REPORT_COLS)
