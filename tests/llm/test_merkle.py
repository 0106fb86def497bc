"""The manifest against a tree built level by level in plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tierlake.llm import merkle


def h(*digests):
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def leaf(row):
    def written(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*map(written, row))


def tree(nodes):
    """(root, [(left, right) of every level] per node) of a list of hex digests."""
    paths, under = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(k, min(k + 3, len(nodes))) for k in range(0, len(nodes), 3)]
        for run in runs:
            for k in run:
                for m in under[k]:
                    paths[m].append(([nodes[j] for j in run if j < k], [nodes[j] for j in run if j > k]))
        nodes = [h(*[nodes[k] for k in run]) for run in runs]
        under = [sum([under[k] for k in run], []) for run in runs]
    return nodes[0], paths


def brute(rows):
    """Rows (doc_id, source, lang, n_chars, text) -> sorted report rows."""
    sources = defaultdict(list)
    for r in rows:
        sources[r[1]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        sources[s].sort(key=lambda x: x[:3])
        trees.append(tree([x[2] for x in sources[s]]))
    root, tops = tree([t[0] for t in trees])
    out = []
    for s, (subroot, paths), top in zip(names, trees, tops):
        for (_, _, own, r), path in zip(sources[s], paths):
            steps = path + top
            text = r[4]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf((*r[:4], text))
            for left, right in steps:
                folded = h(*left, folded, *right)
            proof = h(*[d for left, right in steps for d in left + right])
            out.append((r[0], own, subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


def reported(df):
    return sorted(map(tuple, merkle.report(merkle.manifest(df)).collect()), key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 242, 243, 244, 250, 800])
def test_equals_brute_force(spark, n):
    rng = random.Random(n)
    rows = [(d, "hot" if d % 3 else rng.choice(["a", "b", None, "é", "z" * 40, ""]), rng.choice(["en", None]), d % 7,
             "text %d\nsecond line" % d if d % 2 else "one line") for d in range(n)]
    rng.shuffle(rows)
    assert reported(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_edge_rows_and_clashing_columns(spark, edge_docs):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in edge_docs.collect()]
    assert reported(edge_docs) == brute(rows)


def test_many_blocks_and_rounds(spark, monkeypatch):
    """Blocks of nine leaves: several rounds, with lone nodes at the end of a source."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 2)
    for n in (81, 82, 91, 730):
        rows = [(d, "s" if d < n - 5 else "t%d" % d, "en", 1, "x\n%d" % d) for d in range(n)]
        assert reported(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_open_subtrees_equal_the_plain_tree():
    for n in [*range(1, 30), 81, 100]:
        nodes = [h(str(k)) for k in range(n)]
        block = merkle.OpenSubtrees()
        for d in nodes:
            block.append(bytes.fromhex(d))
        root, paths = tree(nodes)
        assert block.close(None).hex() == root
        for d, w, path in zip(nodes, block.witness, paths):
            steps = [([x.hex() for x in a], [x.hex() for x in b]) for a, b in merkle.witness_steps(b"".join(w))]
            assert steps == path and merkle.fold(bytes.fromhex(d), b"".join(w)).hex() == root


def test_tampering_is_found_where_it_changes_the_text(spark, small_docs):
    out = merkle.report(merkle.manifest(small_docs)).collect()
    texts = {r.doc_id: r.text for r in small_docs.collect()}
    for r in out:
        changed = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (texts[r.doc_id] or "")
        assert r.verified == (not changed)
    assert len({r.root for r in out}) == 1 and {r.verified for r in out} == {True, False}
