"""Deterministic de-duplication.

``dropDuplicates`` keeps an arbitrary survivor.  Here the survivor is the first
row of each key under a *total* order: the caller's ``order_by`` keys, then every
remaining column.  It is expressed as ``min(struct(order..., payload...))`` per
key.  A struct has no fixed-width buffer, so Spark plans it as a sort aggregate:
rows are sorted by key within each map task and combined there (partial
aggregation), and the combined rows once more after the exchange.  A key that
holds a third of all rows still ships one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tierlake.functions.ordering import ascending_key

_ORD = "__ord"


def dedupe(df: DataFrame, keys: list[str], order_by: list | None = None) -> DataFrame:
    """One row per ``keys``: the smallest under (order_by..., all other columns).

    NULL keys form one group (as ``dropDuplicates``).  Within the order, NULLs
    sort first.  Output keeps the input column order.
    """
    order_by = list(order_by or [])
    payload = [c for c in df.columns if c not in keys]
    ord_fields = [ascending_key(df, s).alias(f"{_ORD}{i}") for i, s in enumerate(order_by)]
    best = F.min(F.struct(*ord_fields, *[F.col(c) for c in payload])).alias("__best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*[F.col(k) if k in keys else F.col(f"__best.{k}").alias(k) for k in df.columns])
