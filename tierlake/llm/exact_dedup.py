"""Exact dedup with a heavy-hitter split (DataFrame functions only).

Two texts are equal when they are identical after deleting white space.  Each
row is reduced to (doc_id, SHA-256 of the normalised text, code points of the
original), so no text is shuffled to find the groups:

1. ``freqItems`` - Spark's Misra-Gries / Karp-Shenker-Papadimitriou counter -
   returns every digest that holds more than ``support`` of all rows, and at
   most ``1 / support`` digests in all;
2. the exact size and winner of each such candidate come from one
   pre-aggregated ``groupBy`` over the candidates' rows; candidates that are
   not really repeated are discarded.  The verified winners (at most
   ``1 / support`` rows, a bound that does not depend on the data) are broadcast;
3. rows of a heavy digest are settled map-side from the broadcast row, only the
   others are shuffled by digest, where every group now holds at most a
   ``support`` share of the rows.

The row with the most code points stays, then the smallest ``doc_id`` (NULL
last); fully tied rows (a repeated row) leave exactly one.  A very long text is
hashed whole.  NULL text counts as empty, so NULL, empty and all-white-space texts
form one group.  An empty table gives an empty result.  Only ``doc_id`` and ``text`` are read by
``duplicate_report``; ``drop_exact_duplicates`` returns the input's columns,
whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.common import text_or_empty, without_spaces
from tierlake.session import materialize

# Share of all rows from which a digest counts as heavy: at most 512 are tracked.
HEAVY_SUPPORT = 1.0 / 512


def digest(text: Column) -> Column:
    return F.sha2(without_spaces(text), 256)


def frequent_digests(keyed: DataFrame, support: float = HEAVY_SUPPORT) -> DataFrame:
    """Misra-Gries candidates: one row per digest that may exceed ``support``."""
    found = keyed.select("__digest").freqItems(["__digest"], support)
    return found.select(F.explode("__digest_freqItems").alias("__digest"))


def verified_winners(keyed: DataFrame, support: float = HEAVY_SUPPORT) -> DataFrame:
    """Exact group size and winner of every candidate digest that has copies.

    ``keyed`` has ``__digest``, ``__points``, ``doc_id`` and ``__rid``.  The
    result is written out: it has at most ``1 / support`` rows and is read more
    than once.
    """
    best = F.min(F.struct((-F.col("__points")).alias("p"), F.col("doc_id").isNull().alias("n"),
                          F.col("doc_id").alias("d"), F.col("__rid").alias("r")))
    winners = (keyed.join(F.broadcast(frequent_digests(keyed, support)), "__digest")
               .groupBy("__digest").agg(F.count(F.lit(1)).alias("__heavy_size"), best.alias("__best"))
               .filter(F.col("__heavy_size") > 1)
               .select("__digest", "__heavy_size", F.col("__best.d").alias("__heavy_keep"),
                       F.col("__best.r").alias("__heavy_rid")))
    return materialize(winners.coalesce(1), "dedup-winners")


def _keyed(docs: DataFrame) -> DataFrame:
    """The narrow digest table, written once so that its row ids are stable."""
    text = text_or_empty()
    return materialize(docs.select("doc_id", digest(text).alias("__digest"), F.length(text).alias("__points"),
                                   F.monotonically_increasing_id().alias("__rid")), "dedup-digests")


def duplicate_report(docs: DataFrame, support: float = HEAVY_SUPPORT) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per input row."""
    keyed = _keyed(docs)
    winners = verified_winners(keyed, support)
    heavy = keyed.join(F.broadcast(winners), "__digest").select(
        "doc_id", F.col("__heavy_keep").alias("keep_id"), F.col("__heavy_size").alias("group_size"),
        (F.col("__rid") == F.col("__heavy_rid")).alias("kept"), F.col("__digest").alias("text_sha256"))
    group = Window.partitionBy("__digest")
    order = group.orderBy(F.desc("__points"), F.asc_nulls_last("doc_id"), "__rid")
    light = keyed.join(F.broadcast(winners), "__digest", "left_anti").select(
        "doc_id", F.first("doc_id").over(order).alias("keep_id"),
        F.count(F.lit(1)).over(group).alias("group_size"),
        (F.row_number().over(order) == 1).alias("kept"), F.col("__digest").alias("text_sha256"))
    return heavy.unionByName(light)


def drop_exact_duplicates(docs: DataFrame, support: float = HEAVY_SUPPORT) -> DataFrame:
    """The rows that stay, with their own columns.

    Losers of heavy groups are removed map-side against the broadcast winners;
    what is left is shuffled once by digest.
    """
    text = text_or_empty()
    tagged = docs.withColumns({"__digest": digest(text), "__points": F.length(text)})
    narrow = tagged.select("doc_id", "__digest", "__points", F.lit(0).alias("__rid"))
    winners = verified_winners(materialize(narrow, "dedup-digests"), support)
    best = (F.col("__heavy_size").isNull() | F.col("doc_id").eqNullSafe(F.col("__heavy_keep")))
    left = tagged.join(F.broadcast(winners), "__digest", "left").filter(best)
    order = Window.partitionBy("__digest").orderBy(
        F.desc("__points"), F.asc_nulls_last("doc_id"), F.col("text").asc_nulls_last(),
        F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    return left.withColumn("__row", F.row_number().over(order)).filter("__row = 1").select(
        *[F.col(f"`{c}`") for c in docs.columns])
