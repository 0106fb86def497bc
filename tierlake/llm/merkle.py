"""Merkle manifest of a dataset with incremental witnesses.

Every row is a leaf: SHA-256 over its five columns (``LEAF_COLUMNS``), each ``-`` if
NULL, else its UTF-8 byte count, ``:`` and its value.  Per source the leaves ascend by
``doc_id``; while several nodes remain, every ``ARITY`` consecutive ones become the
SHA-256 of their hex digests (the last run may hold fewer, even one).  The sources'
subroots, ordered by source, give the root in the same way.

A witness is what a leaf needs to recompute the root: for every level a byte with the
number of left and right siblings, then their digests.  Witnesses grow incrementally:

1. Leaf digests are written once; the text is read once and never shuffled.
2. A range partitioning by (source, doc_id, digest, row) and the exact counts per
   partition and source give every leaf its position, however many rows a source holds.
3. Leaves are dealt by (source, aligned block of ``ARITY ** BLOCK_LEVELS`` positions)
   and streamed in order.  A leaf is appended to the open subtrees of its block; when a
   run is complete, the partial witnesses of all leaves under each of its nodes are
   extended by the other nodes.  Memory is one block, whatever the source's size.
4. The block roots are appended to the next round's blocks in the same way, until every
   source has one root, and the subroots once more.  A round is ``ARITY ** BLOCK_LEVELS``
   times smaller than the one before it, and is written under the checkpoint folder.
5. Going down again, each block's own witness extends those of its members.

NULL columns count as above; NULL sources and NULL ids come first.  Rows with the same
id are ordered by their digest, fully equal rows have equal leaves and arbitrary
neighbouring places.  A very long text is hashed where it is read.  An empty table gives
an empty result.  Columns other than the five are not part of the leaf and not returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierlake.session import materialize

LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
ARITY = 3
BLOCK_LEVELS = 5
LEAF, ROOT = 0, 1


def leaf_digest(columns: list[Column]) -> Column:
    """Hex SHA-256 of the columns' written forms."""
    def written(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))

    return F.sha2(F.concat(*[written(c) for c in columns]), 256)


def join_digests(nodes: Iterable[bytes]) -> bytes:
    return hashlib.sha256("".join([n.hex() for n in nodes]).encode()).digest()


class OpenSubtrees:
    """The open runs of one block, by level, and the witnesses of its leaves so far."""

    def __init__(self):
        self.runs: list[list[tuple[bytes, int, int]]] = [[]]    # (digest, first leaf, end) of each open node
        self.witness: list[list[bytes]] = []

    def append(self, digest: bytes) -> None:
        n = len(self.witness)
        self.witness.append([])
        self._place(0, (digest, n, n + 1))

    def _place(self, level: int, node: tuple[bytes, int, int]) -> None:
        if level == len(self.runs):
            self.runs.append([])
        self.runs[level].append(node)
        if len(self.runs[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        """Close the run: its nodes' leaves get their siblings, the parent is appended above."""
        run, self.runs[level] = self.runs[level], []
        digests = [d for d, _, _ in run]
        for k, (_, first, end) in enumerate(run):
            step = bytes([k << 4 | len(run) - 1 - k]) + b"".join(digests[:k] + digests[k + 1:])
            for w in self.witness[first:end]:
                w.append(step)
        self._place(level + 1, (join_digests(digests), run[0][1], run[-1][2]))

    def close(self, levels: int | None) -> bytes:
        """The block's root: ``levels`` above its leaves, or (None) where one node is left."""
        level = 0
        while True:
            alone = len(self.runs[level]) == 1 and not any(self.runs[level + 1:])
            if alone if levels is None else level == levels:
                return self.runs[level][0][0]
            if self.runs[level]:
                self._complete(level)
            level += 1


def witness_steps(witness: bytes) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """(left, right) siblings of each level, from the leaf to the root."""
    at = 0
    while at < len(witness):
        left, right = witness[at] >> 4, witness[at] & 15
        digests = [witness[at + 1 + 32 * k:at + 33 + 32 * k] for k in range(left + right)]
        yield digests[:left], digests[left:]
        at += 1 + 32 * (left + right)


def fold(leaf: bytes, witness: bytes) -> bytes:
    """The root that a leaf and its witness give."""
    for left, right in witness_steps(witness):
        leaf = join_digests([*left, leaf, *right])
    return leaf


def siblings_digest(witness: bytes) -> str:
    """Hex SHA-256 of all siblings of a witness, level by level, left to right."""
    return join_digests([d for left, right in witness_steps(witness) for d in left + right]).hex()


def with_positions(nodes: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """``nodes`` with ``pos`` (from 0 within the group, NULL group first) and ``n`` (the group's size).

    ``order`` must be total.  Spark's range bounds decide only which task counts which
    rows, never a position.
    """
    keys = [F.asc_nulls_first(group), *order]
    placed = nodes.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = materialize(placed.withColumn("__at", F.monotonically_increasing_id()), name)
    part = F.shiftright("__at", 33)
    stretches = rows.groupBy(F.col(group).alias("__g"), part.alias("__part")).agg(
        F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    by = Window.partitionBy("__g")
    before = by.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    stretches = stretches.select("__g", "__part", "__first",
                                 F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
                                 F.sum("__rows").over(by).alias("n"))
    same = F.col(group).eqNullSafe(F.col("__g")) & (part == F.col("__part"))
    return rows.join(stretches, same).withColumn("pos", F.col("__before") + F.col("__at") - F.col("__first")).drop(
        "__at", "__g", "__part", "__first", "__before")


def append_blocks(nodes: DataFrame, name: str) -> DataFrame:
    """One round of appends: rows of kind LEAF (the nodes with their witness inside the block)
    and ROOT (one per group and block).

    ``nodes``: g, pos, n, digest and two carried columns doc_id and tampered.
    """
    size = ARITY ** BLOCK_LEVELS
    schema = ("kind int, g string, block long, pos long, n long, digest binary, witness binary, doc_id long, "
              "tampered binary")
    fields = [f.split()[0] for f in schema.split(", ")]
    types = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]
    dealt = nodes.select("g", F.expr(f"pos div {size}").alias("block"), "pos", "n", "digest", "doc_id", "tampered")
    dealt = dealt.repartition("g", "block").sortWithinPartitions("g", "block", "pos")

    def finish(rows: list[tuple]) -> Iterator[tuple]:
        tree = OpenSubtrees()
        for r in rows:
            tree.append(r[4])
        g, block, _, n = rows[0][:4]
        root = tree.close(BLOCK_LEVELS if n > size else None)
        for (g, block, pos, n, digest, doc_id, tampered), w in zip(rows, tree.witness):
            yield LEAF, g, block, pos, n, digest, b"".join(w), doc_id, tampered
        yield ROOT, g, block, block, -(-n // size), root, None, None, None

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: list[tuple] = []       # the rows of the block being read
        out: list[tuple] = []
        for b in batches:
            for r in zip(*[c.to_pylist() for c in b.columns]):
                if own and own[-1][:2] != r[:2]:
                    out += finish(own)
                    own = []
                own.append(r)
            if len(out) >= 4 * size:
                yield batch(out)
                out = []
        if own:
            out += finish(own)
        if out:
            yield batch(out)

    return materialize(dealt.mapInArrow(run, schema), name)


def _rounds(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The LEAF rows of every round, bottom first, and (g, digest), the root of each group."""
    rounds = []
    while True:
        appended = append_blocks(nodes, f"{name}-{len(rounds)}")
        rounds.append(appended.filter(F.col("kind") == LEAF).drop("kind"))
        nodes = appended.filter(F.col("kind") == ROOT).select("g", "pos", "n", "digest", "doc_id", "tampered")
        if (nodes.agg(F.max("n")).first()[0] or 1) == 1:
            return rounds, nodes.select("g", "digest")


def _extended(rounds: list[DataFrame], above: DataFrame | None) -> DataFrame:
    """The lowest round's rows with ``witness`` extended up to the groups' roots, then by
    ``above`` (g, upper, and what it carries for every group)."""
    carried = [c for c in above.columns if c not in ("g", "upper")] if above is not None else []
    for k in reversed(range(len(rounds))):
        rows = rounds[k]
        if above is not None:
            same = F.col("g").eqNullSafe(F.col("__g"))
            if k < len(rounds) - 1:
                same = same & (F.col("block") == F.col("__block"))
            rows = rows.join(above.withColumnRenamed("g", "__g"), same).drop("__g", "__block").withColumn(
                "witness", F.concat("witness", "upper")).drop("upper")
        if k:
            above = rows.select("g", F.col("pos").alias("__block"), F.col("witness").alias("upper"), *carried)
    return rows


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf, tampered, subroot, root, witness: one row per row of ``docs``.

    ``leaf``, ``subroot`` and ``root`` are digests as bytes.  ``tampered`` is the leaf of
    the row with the line feeds of its text deleted, for rows whose decimal id has an even
    CRC-32 and whose text holds one; else NULL.
    """
    *head, text = [F.col(c) for c in LEAF_COLUMNS]
    flat = F.replace(text, F.lit("\n"), F.lit(""))
    chosen = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.contains(text, F.lit("\n"))
    leaves = docs.select(
        F.col("source").cast("string").alias("g"), F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(leaf_digest([*head, text])).alias("digest"),
        F.when(chosen, F.unhex(leaf_digest([*head, flat]))).alias("tampered"),
        F.monotonically_increasing_id().alias("rid"))
    leaves = materialize(leaves, "merkle-leaves")
    placed = with_positions(leaves, "g", [F.asc_nulls_first("doc_id"), F.col("digest"), F.col("rid")], "merkle-placed")
    rounds, subroots = _rounds(placed, "merkle-block")

    tops = subroots.select(F.lit("").alias("g"), F.col("g").alias("source"), "digest", F.lit(None).cast("long").alias("doc_id"),
                           F.lit(None).cast("binary").alias("tampered"))
    tops = materialize(with_positions(tops, "g", [F.asc_nulls_first("source")], "merkle-sources"), "merkle-subroots")
    top_rounds, root = _rounds(tops.drop("source"), "merkle-top")
    root = F.broadcast(root.select("g", F.col("digest").alias("root")))      # one row
    upper = _extended(top_rounds, None).join(root, "g").select("pos", "witness", "root")
    above = tops.select("pos", F.col("source").alias("g"), F.col("digest").alias("subroot")).join(upper, "pos").select(
        "g", F.col("witness").alias("upper"), "subroot", "root")
    return _extended(rounds, above).select(
        "doc_id", F.col("g").alias("source"), F.col("digest").alias("leaf"), "tampered", "subroot", "root", "witness")


REPORT_SCHEMA = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
                 "verified boolean")


def report(proofs: DataFrame) -> DataFrame:
    """The rows of ``manifest`` in hex, with the digest of their siblings and the check of
    the tampered (else the original) leaf against the root."""
    fields = [f.split()[0] for f in REPORT_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, *columns = b.columns
            leaf, tampered, subroot, root, witness = (c.to_pylist() for c in columns)
            folded = [fold(t or x, w) for x, t, w in zip(leaf, tampered, witness)]

            def hexed(values):
                return pa.array([v.hex() for v in values], pa.string())

            yield pa.RecordBatch.from_arrays(
                [ids, hexed(leaf), hexed(subroot), hexed(root), pa.array(map(siblings_digest, witness), pa.string()),
                 hexed(folded), pa.array([a == b for a, b in zip(folded, root)], pa.bool_())], fields)

    return proofs.select("doc_id", "leaf", "tampered", "subroot", "root", "witness").mapInArrow(run, REPORT_SCHEMA)
