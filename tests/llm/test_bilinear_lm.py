"""Base counts against brute force; the model is a distribution and beats the base held out."""

import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierlake.llm import bilinear_lm as lm


@pytest.fixture(autouse=True)
def short_training(monkeypatch):
    monkeypatch.setattr(lm, "LEAST_STEPS", 60)


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + ["\n"]


def is_held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 1


def check_base(docs, out):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    c = Counter(w for d, t in rows if not is_held_out(d) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    want = Counter()
    for d, t in rows:
        w = tokens(t)
        base = sum(log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        want[d, is_held_out(d), len(w), sum(c[x] > 0 for x in w), n, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want


def test_edge_rows_and_small_head(edge_docs, monkeypatch):
    check_base(edge_docs, lm.score_documents(edge_docs).collect())
    monkeypatch.setattr(lm.head_words, "__defaults__", (40,))         # most words go through the join
    out = lm.score_documents(edge_docs).collect()
    check_base(edge_docs, out)
    assert all(np.isfinite(r.score) and r.score < 0 for r in out)


def test_model_beats_unigrams_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = lm.score_documents(docs).collect()
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_sum_to_one():
    head = [("a", 50), ("b", 30), ("c", 4), ("d", 2)]
    classes = lm.Classes(head, n_all=100, v_all=7, n_end=8, classes=2)
    model = lm.Model(classes.counts)
    events = classes.events([b"a", b"b", b"c", b"a"])
    model.fit_shard(np.unique(events), np.ones(len(np.unique(events))), 1, least_steps=30)
    scorer = lm.Scorer(model, classes, head)
    m = scorer.m
    for context in range(m * m):
        logs = scorer.event_logs(context * m + np.arange(classes.n_out))
        assert abs(np.exp(logs).sum() - 1) < 1e-4
    # within OTHER: c, d, two more words with count 3 each are 12 tokens of 4 words, and the unseen one
    assert classes.other_tokens == 12 and classes.other_words == 4
    total = classes.other_tokens + 0.5 * (classes.other_words + 1)
    assert abs(sum((c + 0.5) / total for c in (4, 2, 3, 3, 0)) - 1) < 1e-9


def test_result_does_not_depend_on_partitions(small_docs):
    one = {r.doc_id: r.score for r in lm.score_documents(small_docs.coalesce(1)).collect()}
    four = {r.doc_id: r.score for r in lm.score_documents(small_docs.repartition(4)).collect()}
    assert one.keys() == four.keys() and all(abs(one[d] - four[d]) < 1e-6 * abs(one[d]) for d in one)


def test_no_training_documents(spark):
    ids = [i for i in range(40) if is_held_out(i)]
    docs = spark.createDataFrame([(i, "some words") for i in ids], "doc_id long, text string")
    out = lm.score_documents(docs).collect()
    assert len(out) == len(ids) and all(r.train_tokens == 0 and r.base_score == 0 and r.n_known == 0 for r in out)


def test_equally_frequent_words_still_fill_the_head(spark):
    """More words of one count than fit: whole hash bins of them, and all more frequent ones."""
    flat = spark.range(50_000).select(F.concat(F.lit("w"), "id").alias("word"), F.lit(3).cast("long").alias("c"))
    some = spark.createDataFrame([("top", 900), ("next", 40), ("\n", 5000)], "word string, c long")
    counts = flat.unionByName(some).cache()
    head = lm.head_words(counts, 1000)
    assert head[:2] == [("top", 900), ("next", 40)] and 900 <= len(head) <= 1000
    assert head == sorted(head, key=lambda r: (-r[1], r[0])) == lm.head_words(counts.repartition(5), 1000)
    assert len(lm.head_words(counts, 60_000)) == 50_002
    assert lm.head_words(counts.limit(0), 10) == []
    counts.unpersist()
