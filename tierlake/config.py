"""Layer and table names, passed explicitly (no notebook globals)."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LakeNames:
    """Three-level names ``catalog.layer.table``; ``catalog`` may be ``spark_catalog``."""

    catalog: str = "spark_catalog"
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"

    def schema(self, layer: str) -> str:
        return f"{self.catalog}.{getattr(self, layer)}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.schema(layer)}.{name}"


# The six landing sources and the gold tables, in build order.
SOURCES = ("circuits", "races", "constructors", "drivers", "results", "sprints")
GOLD_TABLES = ("race_results", "driver_standings", "constructor_standings")

# Season from which the "recent" preview starts (the queries over the derived
# calendar pass their own, ``plans.fixtures.CUT_SEASON``).
RECENT_SEASON = 2020
