"""Fingerprints and components against brute force."""

import re

import numpy as np
import pytest
import xxhash

from tierlake.llm import simhash
from tierlake.llm.components import stars


def brute_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(items, distance=3):
    """items: (doc_id, fingerprint) -> smallest doc_id reachable per item."""
    n, root = len(items), list(range(len(items)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for i in range(n):
        for j in range(i):
            if (items[i][1] ^ items[j][1]).bit_count() <= distance:
                root[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(items):
        if d is not None:
            best[find(i)] = min(d, best.get(find(i), d))
    return [best.get(find(i)) for i in range(n)]


def test_documents_equal_brute_force(small_docs, edge_docs):
    for docs in (small_docs, edge_docs):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        items = [(d, brute_fingerprint(t)) for d, t in rows]
        want = sorted(((d, f"{f:016x}", c) for (d, f), c in zip(items, brute_components(items))), key=repr)
        got = sorted((tuple(r) for r in simhash.near_duplicates(docs).collect()), key=repr)
        assert got == want


def clustered(rng, centres=6, members=60, noise=200):
    out = list(rng.integers(0, 1 << 63, noise, dtype="u8") * 2)
    for c in rng.integers(0, 1 << 63, centres, dtype="u8"):
        for _ in range(members):
            x = int(c)
            for b in rng.choice(64, rng.integers(0, 6), replace=False):
                x ^= 1 << int(b)
            out.append(np.uint64(x))
    return np.unique(np.array(out, "u8"))


@pytest.mark.parametrize("block_rows", [4096, 7])
def test_links_reach_everything_within_the_distance(spark, block_rows):
    x = clustered(np.random.default_rng(5))
    want = brute_components([(int(v), int(v)) for v in x])
    fps = spark.createDataFrame([(int(v),) for v in x.view("i8")], "fp long")
    plan = simhash.make_plan(fps, len(x))
    assert sum(t + 1 for _, t in plan) == 4 and sum(t for _, t in plan) <= 3      # thresholds sum to tau - m + 1
    found = stars(simhash.links(fps, plan, 3, block_rows))
    root = {int(v): int(v) for v in x.view("i8")} | {r.u: r.v for r in found.collect()}
    groups = {}
    for v, s in zip(x, x.view("i8")):
        groups.setdefault(root[int(s)], []).append(int(v))
    label = {v: min(g) for g in groups.values() for v in g}
    assert [label[int(v)] for v in x] == want


def test_plan_covers_every_near_pair():
    rng = np.random.default_rng(8)
    for skew in (0.5, 0.03):
        bits = (rng.random((4000, 64)) < skew)
        bits[:, 8:16] = bits[:, :8]                                   # correlated bits
        x = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
        b = simhash._bits(x.view("i8")).astype("f4")
        groups = simhash.bit_groups((b.T @ b).astype("i8"), len(x))
        assert sorted(sum(groups, [])) == list(range(64))
        order = sum(groups, [])
        atoms = np.packbits(simhash._bits(x.view("i8"))[:, order], axis=1, bitorder="little")
        hist = np.array([np.bincount(atoms[:, k], minlength=256) for k in range(8)])
        plan = simhash.plan_parts(groups, hist, len(x), 3)
        masks = [m & (1 << 64) - 1 for m in simhash.signature_masks(plan)]
        for _ in range(500):
            a = int(rng.integers(0, 1 << 63))
            z = a
            for k in rng.choice(64, rng.integers(0, 4), replace=False):
                z ^= 1 << int(k)
            assert any(a & m == z & m for m in masks)


def test_distance_shares_and_thresholds():
    h = np.zeros(256, "i8")
    h[[0, 1, 3]] = 2, 1, 1
    values = [0, 0, 1, 3]
    want = np.bincount([(a ^ b).bit_count() for a in values for b in values], minlength=9) / 16
    assert np.allclose(simhash.distance_shares(h), want)
    cost, chosen = simhash.allot_thresholds([[0, 5, 9], [0, 1, 2], [0, 4, 50]], 0)
    assert (cost, sum(chosen)) == (7, 0) or cost <= 7 and sum(chosen) == 0


def test_one_document_of_each_group_stays(edge_docs, small_docs, empty_docs):
    for docs in (edge_docs, small_docs):
        out = simhash.drop_near_duplicates(docs)
        assert out.columns == docs.columns
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        items = [(d, brute_fingerprint(t)) for d, t in rows]
        positions = brute_components([(i, f) for i, (_, f) in enumerate(items)])
        kept = [(r.doc_id, r.text) for r in out.select("doc_id", "text").collect()]
        group = {}
        for (d, t), p in zip(rows, positions):
            group.setdefault(p, []).append((d, t))
        assert len(kept) == len(group)
        for g in group.values():
            ids = [d for d, _ in g if d is not None]
            assert sum((min(ids) if ids else None, t) in kept for t in {t for _, t in g}) >= 1
    assert simhash.drop_near_duplicates(empty_docs).collect() == []
