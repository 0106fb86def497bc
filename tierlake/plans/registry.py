"""Query registry: importing this module registers every query key.

Every builder takes ``(spark, sf_dir)``, reads the driver's parquet tables (or
data Spark derives from them) and returns a lazy DataFrame whose column names
match the key's DuckDB oracle SQL.
"""

from __future__ import annotations

from tierlake.plans import (  # noqa: F401  (imported for registration)
    queries_gold,
    queries_io,
    queries_conform,
    queries_features,
    queries_eval,
    queries_model,
)
from tierlake.plans.catalog import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
