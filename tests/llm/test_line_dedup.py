"""Line dedup against brute force, on tables where runs span partitions."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tierlake.llm import line_dedup as ld

SPACES = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACES))


def brute(rows, least=ld.MIN_POINTS):
    """(doc_id, n_lines, n_dropped, kept text) of (doc_id, text) rows."""
    def rank(d):
        return (d is None, d or 0)

    owner = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            if len(k) >= least:
                owner[k] = min(owner.get(k, rank(d)), rank(d))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or owner[key(x)] == rank(d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in df.collect()), key=repr)


def rows_with_common_lines(n, seed=5):
    rng = random.Random(seed)
    lines = ["a common line of the table", "  A COMMON line of the table\t", "short", "", "naïve línes of the tablé",
             "ninechars", "tencharss!", "日本語テキストの長い行です", "ſpecial K line here", "x" * 5000]
    rows = []
    for d in range(n):
        own = [f"line {rng.randrange(40)} of a small pool" for _ in range(rng.randrange(6))]
        rows.append((None if d % 23 == 0 else rng.randrange(n), "\n".join(rng.choice(lines) for _ in range(rng.randrange(4)))
                     + "\n" + "\n".join(own)))
    return rows + rows[:9] + [(3, None), (4, ""), (None, None), (n + 1, "\n\n"), (n + 2, "lines\r\nwith\r\nreturns and more\r")]


@pytest.mark.parametrize("partitions", [1, 8, 97])
def test_equals_brute_force_whatever_the_partitions(spark, partitions):
    rows = rows_with_common_lines(220)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    conf = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert got(ld.drop_repeated_lines(docs)) == brute(rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_one_line_in_every_document_spreads_over_partitions(spark):
    rows = [(d, "the very same line in all documents\nline of %d alone" % d) for d in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = ld.first_occurrences(ld.line_rows(docs)).cache()
    claims = found.filter(F.col("kind") == ld.CLAIM)
    assert claims.count() > 1 and claims.count() <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = claims.groupBy("h1", "h2").count().agg(F.max("count")).first()[0]
    assert hot > 1                                        # several partitions end inside the same run
    assert got(ld.drop_repeated_lines(docs)) == brute(rows)
    found.unpersist()


def test_runs_over_batches():
    """Any cut of the sorted rows into batches gives the same decisions."""
    rng = random.Random(9)
    rows = sorted({(rng.randrange(4), 0, rng.randrange(5), rng.randrange(2), rng.randrange(3)) for _ in range(80)})
    rows += [(9, 0, None, 1, 1), (9, 0, None, 1, 2)]
    rows = [r for r in rows for _ in range(1 + (r[0] == 2))]            # repeats in one run
    types = [pa.int64()] * 4 + [pa.int32()]

    def batch(part):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in part], t) for k, t in enumerate(types)], ld.LINE)

    def decide(cuts):
        runs, dropped, undecided = ld._Runs(), [], []
        for a, b in zip([0, *cuts], [*cuts, len(rows)]):
            if a < b:
                d, o = runs.split(batch(rows[a:b]))
                dropped += d.tolist()
                undecided += o.tolist()
        return dropped, undecided, runs.first, runs.hashes

    whole = decide([])
    first = {}
    for r in rows:
        first.setdefault(r[0], r[2])
    want = [r[2] != first[r[0]] and (k == 0 or rows[k - 1] != r) for k, r in enumerate(rows)]
    assert whole[0] == want
    assert {rows[k][0] for k, o in enumerate(whole[1]) if o} == {rows[0][0]}
    for _ in range(60):
        assert decide(sorted(rng.sample(range(len(rows)), 7))) == whole


def test_bitmaps_and_columns(spark, edge_docs):
    bitmaps = ld.keep_bitmaps(edge_docs).collect()
    assert len({(b.doc_id, b.text_key) for b in bitmaps}) == len(bitmaps)
    for b in bitmaps:
        keep = ld.unpack(b.n_lines, b.keep)
        assert len(keep) == b.n_lines and int((~keep).sum()) == b.n_dropped
    kept = ld.drop_repeated_lines(edge_docs.withColumn("n_lines", F.lit("clash")))
    assert kept.columns == [*edge_docs.columns, "n_lines", "n_dropped"]
    assert got(kept) == brute([(r.doc_id, r.text) for r in edge_docs.collect()])
    untouched = [c for c in edge_docs.columns if c not in ("text", "k.x")]
    assert sorted(map(repr, kept.select(*untouched).collect())) == sorted(map(repr, edge_docs.select(*untouched).collect()))


def test_pack_round_trip():
    for n, gone in ((1, []), (1, [0]), (9, [8]), (1000, list(range(0, 1000, 3)))):
        keep = ld.unpack(n, ld.pack(n, np.array(gone, "int64")))
        assert np.flatnonzero(~keep).tolist() == gone and len(keep) == n
