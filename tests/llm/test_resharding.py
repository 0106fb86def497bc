"""The flow against exhaustive search; shards, slots and untouched files."""

import itertools
import os
import random
import zlib

from pyspark.sql import functions as F

from tierlake.llm import queries, resharding


def cheapest(supply, demand, cost):
    """Exhaustive minimum over all integer transports (tiny cases)."""
    best = None
    n, m = len(supply), len(demand)

    def rows(i):
        return [c for c in itertools.product(range(supply[i] + 1), repeat=m) if sum(c) == supply[i]]
    for flow in itertools.product(*(rows(i) for i in range(n))):
        if all(sum(flow[i][j] for i in range(n)) <= demand[j] for j in range(m)):
            c = sum(flow[i][j] * cost[i][j] for i in range(n) for j in range(m))
            best = c if best is None else min(best, c)
    return best


def test_flow_is_cheapest():
    rng = random.Random(1)
    for _ in range(60):
        n, m = rng.randint(1, 3), rng.randint(1, 3)
        supply = [rng.randint(0, 4) for _ in range(n)]
        demand = resharding.equal_capacities(sum(supply) + rng.randint(0, 2), m)
        cost = [[rng.randint(0, 5) for _ in range(m)] for _ in range(n)]
        flow = resharding.min_cost_flow(supply, demand, cost)
        assert [sum(r) for r in flow] == supply
        assert all(sum(flow[i][j] for i in range(n)) <= demand[j] for j in range(m))
        assert sum(flow[i][j] * cost[i][j] for i in range(n) for j in range(m)) == cheapest(supply, demand, cost)


def test_moves_as_few_bytes_as_capacities_allow():
    supply, demand = [900, 50, 50], resharding.equal_capacities(1000, 4)
    flow = resharding.min_cost_flow(supply, demand, [[int(i != j) for j in range(4)] for i in range(3)])
    assert sum(flow[i][j] for i in range(3) for j in range(4) if i != j) == 650


def test_query_shards_are_near_equal_and_gapless(spark, small_docs):
    rows = queries.op1_resharding(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in small_docs.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    load, slots = [0] * 16, [[] for _ in range(16)]
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert max(load) - min(load) <= max(len(t.encode()) + 1 for t in texts.values())


def test_only_affected_shards_are_rewritten(spark, tmp, edge_docs):
    docs = edge_docs.filter("doc_id < 90 or doc_id >= 300")
    old = F.when(F.col("doc_id") < 50, 0).when(F.col("doc_id") < 306, 1).otherwise(2)
    per = {r["s"]: r["n"] for r in docs.withColumn("s", old).groupBy("s").agg(
        F.sum(resharding.row_size()).alias("n")).collect()}
    # shard 2 keeps exactly its bytes; 0 and 1 change
    out = resharding.reshard(docs, old, 3, 3, [per[0] + per[1] - 10, 10, per[2]], path=tmp)
    rows = out.collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
    assert all(r.shard == 2 for r in rows if r.old_shard == 2)
    written = {d for d in os.listdir(tmp.removeprefix("file:")) if d.startswith("shard=")}
    assert "shard=2" not in written and written
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_rows_without_or_with_repeated_ids_spread(spark, monkeypatch):
    """A third without id, a third with one id: near equal shards and small slot buckets."""
    monkeypatch.setattr(resharding, "BUCKET_BYTES", 2000)
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else k, "text %d " % k * (1 + k % 5)) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = resharding.reshard(docs, F.pmod(F.xxhash64("text"), F.lit(3)), 3, 4).collect()
    load, slots = [0] * 4, [[] for _ in range(4)]
    for r in out:
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert sorted((r.doc_id or 0, r.text) for r in out) == sorted((d or 0, t) for d, t in rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    assert max(load) - min(load) <= 2 * max(len(t) + 1 for _, t in rows)
    sizes = docs.select(F.lit(0).alias("old_shard"), resharding.row_size().alias("size"), resharding.row_hash().alias("__hash"))
    plan = resharding.plan_resharding(sizes, 1, 4)
    assert plan.slot_buckets >= sum(load) // 4 // 2000
    buckets = sizes.groupBy(F.pmod(F.xxhash64("__hash"), F.lit(plan.slot_buckets))).agg(F.sum("size").alias("n"))
    assert buckets.agg(F.max("n")).first()[0] <= 3 * 4 * 2000


def test_block_list_is_bounded_by_shards_not_rows(spark):
    sizes = spark.range(200_000).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("int").alias("old_shard"),
                                        (F.col("id") % 50 + 1).alias("size"), F.xxhash64("id").alias("__hash"))
    plan = resharding.plan_resharding(sizes, 3, 4, blocks_per_shard=16)
    assert plan.blocks.count() <= (2 * 16 + 1) * 4 + 3
    load = {r["shard"]: r["n"] for r in resharding_loads(sizes, plan)}
    assert max(load.values()) - min(load.values()) <= 2 * plan.threshold


def resharding_loads(sizes, plan):
    d = sizes.withColumn("__block", resharding._block_name(plan.threshold, plan.small_blocks))
    t = plan.blocks.withColumnRenamed("old_shard", "o").withColumnRenamed("block", "b")
    return d.join(t, (F.col("old_shard") == F.col("o")) & (F.col("__block") == F.col("b"))).groupBy("shard").agg(
        F.sum("size").alias("n")).collect()
