"""SimHash near-dedup by the generalised pigeonhole principle.

Fingerprint: one bit per position of the 64-bit hashes of a text's word
shingles, set where more than half of the hashes have it.  Texts link when their
fingerprints differ in at most ``distance`` bits; components of links are found
over distinct fingerprints, so exact fingerprint copies cost one row.

If the bits are dealt to m parts with thresholds t_i that sum to
``distance`` - m + 1 (a threshold of -1 leaves a part out), then two
fingerprints within ``distance`` are within t_i in at least one part i.  The plan
is chosen from statistics of all fingerprints:

1. bits are grouped greedily by absolute correlation into eight atoms of eight
   bits; the exact distribution of pairwise distances inside an atom comes from
   its 256-value histogram (a Walsh-Hadamard autocorrelation);
2. parts are runs of atoms, whose distance distributions are convolved; for
   every way to cut the atoms into parts, a dynamic programme allots the
   thresholds with the least estimated cost of signatures and candidates;
3. probing: within t bits in a part of w bits means agreeing on the part with
   some t bits masked, so each fingerprint is filed under one key per mask.
   Fingerprints of a key are verified on all 64 bits.

A key's fingerprints are never paired off as rows.  A breadth-first search that
only compares with fingerprints not yet reached emits one link per fingerprint
it reaches.  Keys with more than ``BLOCK_ROWS`` fingerprints are split into
blocks and every pair of blocks is searched, so a task's group is bounded and no
candidate is dropped.

Texts without words have fingerprint 0 and link like any other; NULL text counts
as empty.  Rows with a NULL ``doc_id`` are fingerprinted and linked too but never
name a component that has another id; a component of such rows alone has a NULL
id.  A very long text is shingled whole, one row at a time.  Repeated rows fall into one
component.  An empty table gives an empty result.  Other columns are ignored, or
returned unchanged by ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.llm.common import map_batches
from tierlake.llm.components import stars
from tierlake.session import materialize

SHINGLE_WORDS = 3
DISTANCE = 3
SEED = 42
ATOMS = 8
BLOCK_ROWS = 4096
SHORT_RUN = 16
# Estimated cost of filing one signature, in comparisons of two fingerprints.
SIGNATURE_COST = 100.0
MAX_MASKS = 64


def fingerprint(raw: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint as an unsigned integer."""
    from xxhash import xxh64_intdigest
    words = raw.lower().split()          # both ASCII only, on bytes
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    shingles = [b" ".join(words)] if n == 1 else map(b" ".join, zip(*(words[k:] for k in range(shingle_words))))
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), "<u8", n)
    ones = np.zeros(64, "i8")
    for lo in range(0, n, 1 << 16):
        part = hashes[lo:lo + (1 << 16)].view("u1").reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype="i8")
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, out: str = "__fp", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Add the fingerprint of ``text`` as a signed long."""
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.LongType())])
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py() or b"", shingle_words) for t in texts), "u8", b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fps.view("i8"))], [*b.schema.names, "fp"])

    return map_batches(docs, run, schema)


# --- statistics and plan ------------------------------------------------------------

def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(fps, "<i8").view("u1").reshape(-1, 8), axis=1, bitorder="little")


def _summed(fps: DataFrame, width: int, count) -> np.ndarray:
    """Sum of ``count(fingerprints)`` (a vector of ``width``) over all rows of ``fps``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, "i8")
        for b in batches:
            values = b.column(0).to_numpy()
            for lo in range(0, len(values), 8192):
                total += count(values[lo:lo + 8192])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], ["k", "n"])

    rows = fps.select("fp").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(width, "i8")
    for r in rows:
        out[r["k"]] = r["n"]
    return out


def bit_groups(together: np.ndarray, n: int) -> list[list[int]]:
    """Eight groups of eight bits, each grown by the bit most correlated with it.

    ``together[a, b]``: fingerprints with both bits set.
    """
    p = together / max(n, 1)
    mean = np.diag(p)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    corr = np.abs((p - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    free, groups = list(range(64)), []
    while free:
        sub = corr[np.ix_(free, free)]
        first = free[int(sub.max(axis=1).argmax())]
        group = [first]
        free.remove(first)
        while len(group) < 64 // ATOMS:
            best = max(free, key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        groups.append(group)
    return groups


def distance_shares(histogram: np.ndarray) -> np.ndarray:
    """Share of all pairs of values at distance 0, 1, ... (values with replacement)."""
    h = histogram.astype("f8")
    size = len(h)
    step = 1
    while step < size:                                # Walsh-Hadamard transform
        h = h.reshape(-1, 2, step)
        h = np.stack([h[:, 0] + h[:, 1], h[:, 0] - h[:, 1]], axis=1).reshape(-1)
        step *= 2
    h = h * h
    step = 1
    while step < size:
        h = h.reshape(-1, 2, step)
        h = np.stack([h[:, 0] + h[:, 1], h[:, 0] - h[:, 1]], axis=1).reshape(-1)
        step *= 2
    pairs = np.maximum(h / size, 0)
    weight = np.bitwise_count(np.arange(size, dtype="u4"))
    return np.bincount(weight, pairs) / max(pairs.sum(), 1)


def allot_thresholds(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds from -1 up with the given sum and the least cost.

    ``costs[i][t + 1]`` is the cost of threshold t in part i.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        new: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for k, c in enumerate(part):
                s = used + k - 1
                if s not in new or cost + c < new[s][0]:
                    new[s] = (cost + c, [*chosen, k - 1])
        best = new
    return best.get(total, (float("inf"), []))


def plan_parts(groups: list[list[int]], histograms: np.ndarray, n: int, distance: int) -> list[tuple[list[int], int]]:
    """The cheapest (bits, threshold) parts over all cuts of the atoms into runs."""
    shares = [distance_shares(h) for h in histograms]
    best = (float("inf"), [])
    for cut in range(1 << (ATOMS - 1)):
        runs, at = [], 0
        for k in range(ATOMS):
            if k == ATOMS - 1 or cut >> k & 1:
                runs.append(range(at, k + 1))
                at = k + 1
        costs, parts = [], []
        for r in runs:
            bits = [b for k in r for b in groups[k]]
            spread = np.ones(1)
            for k in r:
                spread = np.convolve(spread, shares[k])
            cost = [0.0]
            for t in range(distance + 1):
                masks = comb(len(bits), t)
                # a pair at distance j meets under comb(w - j, t - j) of the masks
                met = sum(spread[j] * comb(len(bits) - j, t - j) for j in range(t + 1))
                cost.append(n * masks * SIGNATURE_COST + n * n / 2 * met if masks <= MAX_MASKS else float("inf"))
            costs.append(cost)
            parts.append(bits)
        cost, thresholds = allot_thresholds(costs, distance - len(runs) + 1)
        if cost < best[0]:
            best = (cost, [(b, t) for b, t in zip(parts, thresholds) if t >= 0])
    return best[1]


def make_plan(fps: DataFrame, n: int, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """Plan from all fingerprints: 64 x 64 and 8 x 256 counts reach the driver."""

    def together(values: np.ndarray) -> np.ndarray:
        b = _bits(values).astype("f4")
        return (b.T @ b).astype("i8").reshape(-1)

    groups = bit_groups(_summed(fps, 64 * 64, together).reshape(64, 64), n)
    order = [b for g in groups for b in g]

    def histograms(values: np.ndarray) -> np.ndarray:
        atoms = np.packbits(_bits(values)[:, order], axis=1, bitorder="little")
        return np.concatenate([np.bincount(atoms[:, k], minlength=256) for k in range(ATOMS)])

    return plan_parts(groups, _summed(fps, ATOMS * 256, histograms).reshape(ATOMS, 256), n, distance)


# --- probing and verification ---------------------------------------------------------

def signature_masks(plan: list[tuple[list[int], int]]) -> list[int]:
    """The 64-bit masks under which fingerprints are filed, as signed longs."""
    masks = []
    for bits, t in plan:
        for left_out in combinations(bits, t):
            m = sum(1 << b for b in bits if b not in left_out)
            masks.append(m - (1 << 64) if m >> 63 else m)
    return masks


def _keyed(fps: DataFrame, masks: list[int], block_rows: int) -> DataFrame:
    """fp under each of its keys; rows of large keys once per pair of blocks."""
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                               for i, m in enumerate(masks)]))
    filed = fps.select("fp", keys.alias("k")).select("fp", "k.mask", "k.key")
    large = filed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block_rows)
    blocks = F.ceil(F.col("n") / F.lit(block_rows)).cast("int")
    filed = filed.join(large.select("mask", "key", blocks.alias("blocks")), ["mask", "key"], "left")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    filed = filed.withColumn("own", F.coalesce(own, F.lit(0)))
    filed = filed.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks") - 1, F.lit(0)))))
    return filed.select("mask", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")


def reachable_links(x: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (root, member) that join what is connected within ``x``.

    Each fingerprint taken from the queue is compared only with those that have
    not been reached yet.
    """
    roots, members = [], []
    rest = x
    while rest.size > 1:
        root, rest = rest[0], rest[1:]
        queue = [root]
        while queue and rest.size:
            near = np.bitwise_count(rest ^ queue.pop()) <= distance
            if near.any():
                found = rest[near]
                roots.append(np.full(found.size, root))
                members.append(found)
                queue.extend(found)
                rest = rest[~near]
    if not roots:
        return x[:0], x[:0]
    return np.concatenate(roots), np.concatenate(members)


def _run_links(run: np.ndarray, x: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of consecutive runs (``run``: run number per row) of fingerprints."""
    starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(run)]]))
    a, b = [], []
    short = np.repeat(sizes <= SHORT_RUN, sizes)
    for d in range(1, int(min(SHORT_RUN, sizes.max()))):
        hit = np.flatnonzero((run[d:] == run[:-d]) & short[d:] & (np.bitwise_count(x[d:] ^ x[:-d]) <= distance))
        a.append(x[hit])
        b.append(x[hit + d])
    for s, n in zip(starts[sizes > SHORT_RUN].tolist(), sizes[sizes > SHORT_RUN].tolist()):
        root, member = reachable_links(x[s:s + n], distance)
        a.append(root)
        b.append(member)
    return (np.concatenate(a), np.concatenate(b)) if a else (x[:0], x[:0])


def links(fps: DataFrame, plan: list[tuple[list[int], int]], distance: int = DISTANCE,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b): verified links that connect the same fingerprints as all links do."""
    key = ["mask", "key", "lo", "hi"]
    filed = _keyed(fps, signature_masks(plan), block_rows).repartition(*key).sortWithinPartitions(*key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(cols: list[np.ndarray], fp: np.ndarray) -> pa.RecordBatch:
            new = np.zeros(len(fp), bool)
            for c in cols:
                new[1:] |= c[1:] != c[:-1]
            a, b = _run_links(np.cumsum(new), fp.view("u8"), distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view("i8")), pa.array(b.view("i8"))], ["a", "b"])

        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
            last = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0))
            cut = int(last[-1]) + 1 if last.size else 0       # the last run may go on
            if cut:
                yield out([c[:cut] for c in cols[:4]], np.ascontiguousarray(cols[4][:cut]))
            held = [c[cut:] for c in cols]
        if held is not None:
            yield out(held[:4], np.ascontiguousarray(held[4]))

    return filed.mapInArrow(run, "a long, b long")


def fingerprint_components(tagged: DataFrame, distance: int = DISTANCE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per distinct ``__fp`` of ``tagged``: fp, root (smallest fingerprint of its
    component) and component_id (smallest ``doc_id`` of the component)."""
    fps = materialize(tagged.groupBy(F.col("__fp").alias("fp")).agg(F.min("doc_id").alias("first_doc")), "simhash-fps")
    n = fps.count()
    plan = make_plan(fps, n, distance)
    found = stars(links(fps, plan, distance, block_rows), "simhash-links")
    fps = fps.join(found.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    ids = fps.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    return fps.select("fp", "root").join(ids, "root")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id: one row per input row."""
    tagged = materialize(with_fingerprint(docs.select("doc_id", "text"), shingle_words=shingle_words).drop("text"),
                         "simhash-docs")
    comps = fingerprint_components(tagged, distance)
    return tagged.join(comps, F.col("__fp") == F.col("fp")).select(
        "doc_id", F.lpad(F.lower(F.hex("__fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, distance: int = DISTANCE, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """One row of each component: its smallest ``doc_id`` (then fingerprint, then text)."""
    tagged = materialize(with_fingerprint(docs, shingle_words=shingle_words), "simhash-docs")
    comps = fingerprint_components(tagged, distance)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("fp").alias("fp")))
    narrow = tagged.select("doc_id", F.col("__fp").alias("fp")).distinct().join(comps, "fp")
    chosen = narrow.groupBy("root").agg(best.alias("best")).select(
        F.col("best.id").alias("__id"), F.col("best.fp").alias("__best"))
    kept = tagged.join(chosen, (F.col("__fp") == F.col("__best")) & F.col("doc_id").eqNullSafe(F.col("__id")))
    one = Window.partitionBy("__best", "__id").orderBy(F.asc_nulls_last("text"))
    return kept.withColumn("__row", F.row_number().over(one)).filter("__row = 1").select(
        *[F.col(f"`{c}`") for c in docs.columns])
