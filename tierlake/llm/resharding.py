"""Minimum-cost-flow resharding.

Documents lie in old shards and are to fill new shards of given capacities.  The
cheapest transfers between old and new shards are a minimum-cost flow: supply =
bytes of each old shard, demand = capacity of each new shard, cost = 0 to stay in
the shard of the same number and 1 per byte moved (or a given matrix).  The flow
runs over shard numbers only, so it is as small for 100 TB as for 1 MB.

Transfers are carried out in blocks.  An old shard's documents are hashed into
blocks of about 1 / ``BLOCKS_PER_SHARD`` of a mean new shard; a document larger
than that is a block of its own.  Both kinds together are at most
``(2 * BLOCKS_PER_SHARD + 1) * new shards + old shards`` rows whatever the data's
size, so the block list may go to the driver, where blocks are dealt to the
flow's transfers, largest first, and to broadcast back as block -> new shard.

Only shards whose contents change are rewritten; others keep their files.
Within a shard rows get gapless slots from two-level counts over hash buckets of about
``BUCKET_BYTES``, as many as the data needs, not from one sorted partition per shard.

Blocks and buckets are hashed by id and text, so rows with a NULL or repeated ``doc_id``
spread like any others; only rows that repeat id and text travel together.  The size of a
row is the UTF-8 length of ``text`` plus one, so NULL and empty texts take one byte.  A very
long text is one row of a block of its own.  An empty table gives an empty result.  Extra columns travel along; the
operator's own columns replace columns of the same name.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.llm.common import text_or_empty
from tierlake.session import materialize, scratch_path

BLOCKS_PER_SHARD = 512
BUCKET_BYTES = 1 << 18      # of one slot bucket, about: many buckets a task keep tasks even


# --- the flow over shards (a few dozen nodes) --------------------------------------

def min_cost_flow(supply: list[int], demand: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Cheapest flow[i][j] from supplies to demands; total demand >= total supply.

    Successive cheapest paths with potentials (Dijkstra) on the bipartite graph.
    """
    n, m = len(supply), len(demand)
    left, room = list(supply), list(demand)
    flow = [[0] * m for _ in range(n)]
    potential = [0] * (n + m)
    while any(left):
        dist = [float("inf")] * (n + m)
        back = [-1] * (n + m)
        queue = [(0, i) for i in range(n) if left[i]]
        for _, i in queue:
            dist[i] = 0
        heapq.heapify(queue)
        while queue:
            d, u = heapq.heappop(queue)
            if d > dist[u]:
                continue
            steps = [(n + j, cost[u][j]) for j in range(m)] if u < n else \
                [(i, -cost[i][u - n]) for i in range(n) if flow[i][u - n]]
            for v, c in steps:
                nd = d + c + potential[u] - potential[v]
                if nd < dist[v]:
                    dist[v], back[v] = nd, u
                    heapq.heappush(queue, (nd, v))
        ends = [n + j for j in range(m) if room[j] and dist[n + j] < float("inf")]
        if not ends:
            raise ValueError("the capacities are smaller than the data")
        end = min(ends, key=lambda v: (dist[v] + potential[v], v))
        path, v = [end], end
        while back[v] >= 0:
            v = back[v]
            path.append(v)
        path.reverse()
        amount = min(left[path[0]], room[end - n])
        for u, v in zip(path, path[1:]):
            if u >= n:
                amount = min(amount, flow[v][u - n])
        for u, v in zip(path, path[1:]):
            if u < n:
                flow[u][v - n] += amount
            else:
                flow[v][u - n] -= amount
        left[path[0]] -= amount
        room[end - n] -= amount
        reach = max(d for d in dist if d < float("inf"))
        potential = [p + min(d, reach) for p, d in zip(potential, dist)]
    return flow


def equal_capacities(total: int, shards: int) -> list[int]:
    """Capacities that differ by at most one byte and hold ``total``."""
    return [total // shards + (j < total % shards) for j in range(shards)]


def deal_blocks(blocks: list[tuple[int, str, int]], flow: list[list[int]], capacity: list[int]) -> dict[tuple[int, str], int]:
    """(old shard, block) -> new shard: blocks (old, name, bytes) fill the transfers,
    largest first; then single blocks move from the fullest to the emptiest shard
    (against capacity) while that evens them out."""
    remaining = [list(row) for row in flow]
    load = [0] * len(capacity)
    placed: dict[tuple[int, str], int] = {}
    for old, name, size in sorted(blocks, key=lambda b: (-b[2], b[0], b[1])):
        new = max(range(len(capacity)), key=lambda j: (remaining[old][j], j == old, -j))
        remaining[old][new] -= size
        load[new] += size
        placed[old, name] = new
    inside: list[list[tuple[int, int, str]]] = [[] for _ in capacity]
    for old, name, size in blocks:
        inside[placed[old, name]].append((size, old, name))
    for _ in range(len(blocks)):
        over = max(range(len(capacity)), key=lambda j: load[j] - capacity[j])
        under = min(range(len(capacity)), key=lambda j: load[j] - capacity[j])
        gap = load[over] - capacity[over] - load[under] + capacity[under]
        fits = [b for b in inside[over] if 0 < b[0] < gap]
        if not fits:
            break
        best = min(fits, key=lambda b: (abs(gap - 2 * b[0]), b))
        inside[over].remove(best)
        inside[under].append(best)
        load[over] -= best[0]
        load[under] += best[0]
        placed[best[1], best[2]] = under
    return placed


# --- Spark ---------------------------------------------------------------------------

@dataclass
class Plan:
    """Block destinations, the flow, and which new shards have to be written."""

    blocks: DataFrame
    flow: list[list[int]]
    threshold: int
    small_blocks: list[int]
    affected: list[int]
    slot_buckets: int


def row_hash(text: str = "text") -> Column:
    """Of id and text: what blocks and slot buckets are dealt by."""
    return F.xxhash64("doc_id", text_or_empty(text))


def row_size(text: str = "text") -> Column:
    return (F.octet_length(text_or_empty(text)) + 1).cast("long")


def _block_name(threshold: int, small_blocks: list[int]) -> Column:
    """Name of a row's block inside its old shard."""
    n = F.element_at(F.array(*[F.lit(max(1, k)) for k in small_blocks]), (F.col("old_shard") + 1).cast("int"))
    own = F.concat(F.lit("d"), F.col("__hash").cast("string"))
    hashed = F.concat(F.lit("h"), F.pmod(F.col("__hash"), n).cast("string"))
    return F.when(F.col("size") > threshold, own).otherwise(hashed)


def plan_resharding(sizes: DataFrame, n_old: int, n_new: int, capacity: list[int] | None = None,
                    cost: list[list[int]] | None = None, blocks_per_shard: int = BLOCKS_PER_SHARD) -> Plan:
    """Plan from (__hash, old_shard, size): two pre-aggregated passes over narrow rows."""
    spark = sizes.sparkSession
    per = {r["old_shard"]: r["n"] for r in sizes.groupBy("old_shard").agg(F.sum("size").alias("n")).collect()}
    supply = [int(per.get(i, 0)) for i in range(n_old)]
    total = sum(supply)
    capacity = capacity or equal_capacities(total, n_new)
    cost = cost or [[int(i != j) for j in range(n_new)] for i in range(n_old)]
    flow = min_cost_flow(supply, capacity, cost)
    threshold = max(1, total // (n_new * blocks_per_shard))
    small_blocks = [-(-s // threshold) for s in supply]
    name = _block_name(threshold, small_blocks)
    rows = sizes.groupBy("old_shard", name.alias("block")).agg(F.sum("size").alias("n")).collect()
    blocks = [(r["old_shard"], r["block"], int(r["n"])) for r in rows]
    placed = deal_blocks(blocks, flow, capacity)
    table = spark.createDataFrame([(o, b, s) for (o, b), s in placed.items()], "old_shard int, block string, shard int")
    changed = {s for (o, _), s in placed.items() if o != s} | {o for (o, _), s in placed.items() if o != s and o < n_new}
    return Plan(table, flow, threshold, small_blocks, sorted(changed), max(1, -(-total // (n_new * BUCKET_BYTES))))


def assign(docs: DataFrame, plan: Plan) -> DataFrame:
    """Add ``shard`` (and ``size``): a map-side join with the bounded block table."""
    d = docs.withColumns({"size": row_size(), "__hash": row_hash()})
    d = d.withColumn("__block", _block_name(plan.threshold, plan.small_blocks))
    table = plan.blocks.select(F.col("old_shard").alias("__old"), F.col("block").alias("__name"), "shard")
    joined = d.drop("shard").join(F.broadcast(table), (F.col("old_shard") == F.col("__old")) & (F.col("__block") == F.col("__name")))
    return joined.drop("__old", "__name", "__block")


def with_slots(assigned: DataFrame, buckets: int) -> DataFrame:
    """Add ``slot``: gapless from 0 in each shard, in (bucket, doc_id) order."""
    # other digits of the hash than the blocks': a block is not a bucket
    bucketed = assigned.withColumn("__bucket", F.pmod(F.xxhash64("__hash"), F.lit(buckets)).cast("int")).drop("__hash")
    counts = bucketed.groupBy("shard", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("shard").alias("__s"), F.col("__bucket").alias("__b"),
                            F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("shard", "__bucket").orderBy("doc_id", "text")
    numbered = bucketed.withColumn("__row", F.row_number().over(inside))
    # the rows are already dealt by this key
    joined = numbered.join(offsets, (F.col("shard") == F.col("__s")) & (F.col("__bucket") == F.col("__b")))
    return joined.withColumn("slot", (F.col("__offset") + F.col("__row") - 1).cast("long")).drop(
        "__bucket", "__row", "__offset", "__s", "__b")


def rewrite_affected(assigned: DataFrame, plan: Plan, path: str) -> DataFrame:
    """Write the affected shards under ``path`` (one folder per shard) and return all
    rows: rewritten shards from their new files, the others as they were."""
    spark = assigned.sparkSession
    changed = with_slots(assigned.filter(F.col("shard").isin(plan.affected)), plan.slot_buckets)
    changed.write.partitionBy("shard").parquet(path)
    schema = changed.schema
    out = spark.read.schema(schema).parquet(path)
    untouched = sorted(set(range(len(plan.flow[0]) if plan.flow else 0)) - set(plan.affected))
    if untouched:
        out = out.unionByName(with_slots(assigned.filter(F.col("shard").isin(untouched)), plan.slot_buckets))
    return out


def reshard(docs: DataFrame, old_shard: Column, n_old: int, n_new: int, capacity: list[int] | None = None,
            cost: list[list[int]] | None = None, path: str | None = None) -> DataFrame:
    """Move ``docs`` from ``n_old`` shards (``old_shard``: 0 to n_old - 1) to ``n_new``;
    the rows as they lie afterwards, with old_shard, shard, slot and size."""
    spark = docs.sparkSession
    docs = docs.withColumn("old_shard", old_shard.cast("int"))
    sizes = materialize(docs.select("old_shard", row_size().alias("size"), row_hash().alias("__hash")), "reshard-sizes")
    plan = plan_resharding(sizes, n_old, n_new, capacity, cost)
    return rewrite_affected(assign(docs, plan), plan, path or scratch_path(spark, "reshard"))
