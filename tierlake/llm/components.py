"""Connected components of a link table by alternating large-star and small-star steps.

Every step re-hangs links on the smallest neighbour; after O(log n) rounds each
component is a star around its smallest node.  A round is pre-aggregated minima
joined back to the links, written as Parquet under the checkpoint folder, so the
lineage stays one round long and nothing but a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.session import materialize


def _with_smallest(links: DataFrame) -> DataFrame:
    """links (u, v) with m, the smallest v of each u."""
    smallest = links.groupBy("u").agg(F.min("v").alias("m"))
    return links.join(smallest, "u")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    hung = _with_smallest(both).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    return hung.distinct()


def _small_star(links: DataFrame) -> DataFrame:
    near = _with_smallest(links)
    moved = near.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = near.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).distinct()


def stars(links: DataFrame, name: str = "components") -> DataFrame:
    """(u, v): every node but the smallest of its component, with that smallest node.

    ``links`` has two columns of the same orderable type; direction, repeats and
    links of a node to itself do not matter.
    """
    a, b = (F.col(c) for c in links.columns)
    now = materialize(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(),
                      name)

    def mark(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    before, after = None, mark(now)
    while before != after:
        now = materialize(_small_star(_large_star(now)), name)
        before, after = after, mark(now)
    return now
