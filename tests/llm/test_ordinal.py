"""The ordinal fit, its held-out accuracy, and its behaviour without ratings."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tierlake.llm import ordinal


def test_thresholds_are_ordered_and_tails_nested():
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(400):
        x = rng.normal()
        y = int(x + 0.3 * rng.normal() > -0.5) + int(x + 0.3 * rng.normal() > 0.8)
        rows.append(([3], [x], [0.0] * 4, y))
    model = ordinal.fit(rows, 3)
    assert model.thresholds[0] < model.thresholds[1] and model.hashed[3] > 0
    tails = model.tails(np.linspace(-5, 5, 11) * model.hashed[3])
    assert (tails[:, 0] >= tails[:, 1]).all() and (np.diff(tails, axis=0) >= 0).all()


def test_gradient_is_the_likelihoods():
    """One step from the start moves every parameter with the numerical gradient's sign."""
    rows = [([1, 2], [0.5, 0.5], [0.1, 0, 0, 0.2], 0), ([2, 5], [0.7, 0.3], [0, 0, 0, 0.1], 2), ([1], [1.0], [0] * 4, 1)]

    def loss(model):
        s = np.array([sum(v * model.hashed[i] for i, v in zip(r[0], r[1])) + model.dense @ np.array(r[2]) for r in rows])
        t = np.hstack([np.ones((3, 1)), model.tails(s), np.zeros((3, 1))])
        return np.log([t[k, r[3]] - t[k, r[3] + 1] for k, r in enumerate(rows)]).sum()
    start, better = ordinal.fit(rows, 3, steps=0), ordinal.fit(rows, 3, steps=1, rate=1e-3)
    assert loss(better) > loss(start)
    assert loss(ordinal.fit(rows, 3, steps=60)) > loss(better)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    fold = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(2))
    model = ordinal.train(docs, labels.filter(fold == 0), ordinal.label_grade(), ordinal.GRADES, max_labelled=1500)
    rated = labels.filter(fold == 1).join(ordinal.score_documents(docs, model), "doc_id")
    rows = rated.groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in rows}
    kept_clean = n[1, True] / (n[1, True] + n.get((1, False), 0))
    caught = n[0, False] / (n[0, False] + n.get((0, True), 0))
    assert kept_clean > 0.98 and caught > 0.9, n


def test_selection_is_the_score_and_keeps_columns(spark, edge_docs, empty_docs):
    labels = spark.createDataFrame([(100 + i, 1, 0) for i in range(60)] + [(200 + i, 0, 0) for i in range(40)] +
                                   [(None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int")
    model = ordinal.train(edge_docs, labels, ordinal.label_grade(), ordinal.GRADES)
    scored = ordinal.score_documents(edge_docs, model)
    out = ordinal.select_documents(edge_docs, model)
    assert out.columns == edge_docs.columns
    assert out.count() == scored.filter("kept").count()
    grades = {r.doc_id: r for r in scored.collect()}
    assert not grades[210].kept and grades[110].kept
    assert abs(grades[110].expected_grade - grades[110].tail_1 - grades[110].tail_2) < 1e-9
    assert ordinal.select_documents(empty_docs, model).collect() == []


def test_sample_holds_distinct_documents(spark, monkeypatch):
    texts = [(i, "good words here %d" % i if i % 2 else "bad BAD bad %d" % i) for i in range(30)]
    docs = spark.createDataFrame(texts + [texts[1]] * 50 + [(3, "another text"), (None, "x")], "doc_id long, text string")
    ratings = [(i, i % 2, 0) for i in range(30)] + [(1, 1, 0)] * 200            # one rated over and over
    ratings += [(2, 1, 0)] + [(1_000 + i, 1, 0) for i in range(500)]            # undecided; without a document
    labels = spark.createDataFrame(ratings, "doc_id long, quality int, toxic int")
    given = []
    monkeypatch.setattr(ordinal, "fit", lambda rows, grades: given.append(rows))
    for most, n in ((20, 20), (100, 30)):
        ordinal.train(docs.repartition(4), labels, ordinal.label_grade(), ordinal.GRADES, max_labelled=most)
        sample = ordinal.rated_sample(docs, labels, ordinal.label_grade(), most).collect()
        assert len(given[-1]) == len(sample) == len({r["__id"] for r in sample}) == n
        assert all(r["__grade"] == (2 if r["__id"] % 2 else 0) for r in sample)


def test_without_ratings_everything_stays(spark, edge_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = ordinal.train(edge_docs, none, ordinal.label_grade(), ordinal.GRADES)
    assert ordinal.select_documents(edge_docs, model).count() == edge_docs.count()


def test_scores_use_the_whole_text():
    model = ordinal.OrdinalModel(np.zeros(ordinal.N_HASHED), np.zeros(4), np.zeros(2))
    model.hashed[ordinal.word_features(b"mark")[0]] = 1.0
    a, b = ordinal.Scorer(model).scores([b"plain " * 50_000, b"plain " * 50_000 + b"mark"])
    assert a == 0 and b > 0


def test_a_scorer_keeps_few_words():
    """What a worker holds of a stream of ever new words is a few MB, and scores do not depend on it."""
    rng = np.random.default_rng(1)
    model = ordinal.OrdinalModel(rng.normal(size=ordinal.N_HASHED), rng.normal(size=ordinal.N_SHARES), np.zeros(2))
    scorer = ordinal.Scorer(model)
    tracemalloc.start()
    for at in range(0, 300_000, 1000):
        last = b" ".join(b"word%d" % k for k in range(at, at + 1000))
        got = scorer.scores([last])
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 25e6
    assert got[0] == ordinal.Scorer(model).scores([last])[0]


def test_texts_are_scored_in_slices(spark, monkeypatch):
    """A large batch is not turned into Python objects at once."""
    asked, seen = [], {}

    def watched(self, texts, scores=ordinal.Scorer.scores):
        asked.append(len(texts))
        return scores(self, texts)

    batch = pa.RecordBatch.from_arrays([pa.array(range(2500)), pa.array([f"text {k}" for k in range(2500)])], ["c0", "c1"])
    monkeypatch.setattr(ordinal.Scorer, "scores", watched)
    monkeypatch.setattr(ordinal, "map_batches", lambda df, run, schema: seen.update(run=run))
    model = ordinal.fit([], 3)
    ordinal.select_documents(spark.createDataFrame([(1, "a")], "doc_id long, text string"), model)
    kept = pa.Table.from_batches(seen["run"](iter([batch.slice(0, 0), batch])), batch.schema)
    assert kept.column(0).to_pylist() == list(range(2500)) and sum(asked) == 2500 and max(asked) <= 1000
