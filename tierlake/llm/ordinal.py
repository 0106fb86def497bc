"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades are ordered, 0 to G - 1.  One weight vector over hashed text features gives
a text a score s; ordered thresholds b_1 < b_2 < ... cut it into grades:
P(grade >= k) = logistic(s - b_k).  The expected grade is the sum of these tail
probabilities, and a tail probability is what documents are selected by.

Features: the mean over a text's words of two hashed indicators (the lower-cased
word, and its shape - letter case, digits and punctuation with runs collapsed),
and four shares that single words cannot show: immediate repeats, repeated
three-word windows, repeated lines, and 1 / (1 + words).  All come from the whole
text.

The fit uses at most ``MAX_LABELLED`` distinct rated documents, those with the smallest
hashes of ``doc_id``; only their sparse features are gathered, at most that many rows.
Scoring is a map over all documents; a worker holds ``SLICE_ROWS`` texts and
``CACHE_ENTRIES`` words' weights, plus the words of the longest text, as Python objects.

Ratings that are NULL are not used.  Without any rated row every document gets
even tail probabilities and is kept.  NULL text counts as empty; repeated rows
repeat their scores; an empty table gives an empty result.  ``select_documents``
returns the input's columns, whatever they are called.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import map_batches, slices
from tierlake.session import materialize

HASH_BITS = 16
N_HASHED = 1 << HASH_BITS
N_SHARES = 4
MAX_LABELLED = 8192
MIN_TAIL = 0.5
STEPS, RATE, RIDGE = 120, 0.5, 1e-6
CACHE_ENTRIES = 100_000

_SHAPE = bytes(65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b > 127 else 48 if 48 <= b <= 57 else b
               for b in range(256))
_RUN = re.compile(rb"(.)\1+", re.S)


def word_features(word: bytes) -> tuple[int, int]:
    """The hashed word and the hashed shape of a word."""
    shape = _RUN.sub(rb"\1+", word.translate(_SHAPE))
    mask = N_HASHED - 1
    return zlib.crc32(word.lower()) & mask, zlib.crc32(b"\x00" + shape) & mask


def shares(raw: bytes, words: list[bytes]) -> list[float]:
    n = len(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    windows = max(n - 2, 0)
    return [
        sum(a == b for a, b in pairwise(words)) / max(n, 1),
        1 - len(set(zip(words, words[1:], words[2:]))) / windows if windows else 0.0,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        1 / (1 + n),
    ]


def features(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse hashed means (index, value) and the dense shares of a text."""
    words = raw.split()
    hashed = [k for w in words for k in word_features(w)]
    index, count = np.unique(np.array(hashed, "i8"), return_counts=True)
    return index.astype("<u4"), count / max(len(words), 1), np.array(shares(raw, words))


@dataclass
class OrdinalModel:
    """Weights of the hashed features and the shares, and the ordered thresholds."""

    hashed: np.ndarray
    dense: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. G - 1, one row per score."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - np.asarray(score)[:, None], -500, 500)))


def fit(rows: list[tuple], grades: int,
        steps: int = STEPS, rate: float = RATE, ridge: float = RIDGE) -> OrdinalModel:
    """Maximum likelihood by full-batch Adam over rows (index, value, shares, grade);
    thresholds stay ordered because their gaps are exponentials."""
    if not rows:
        return OrdinalModel(np.zeros(N_HASHED), np.zeros(N_SHARES), np.zeros(grades - 1))
    sizes = np.array([len(r[0]) for r in rows])
    row = np.repeat(np.arange(len(rows)), sizes)
    index = np.concatenate([np.asarray(r[0], "i8") for r in rows])
    value = np.concatenate([np.asarray(r[1]) for r in rows])
    dense = np.array([r[2] for r in rows])
    y = np.array([r[3] for r in rows])
    n = len(rows)
    # start at the thresholds of the grades' own shares
    at_least = np.array([(np.sum(y >= k) + 0.5) / (n + 1) for k in range(1, grades)])
    base = -np.log(at_least / (1 - at_least))
    gaps = np.maximum(np.diff(base), 1e-3)
    params = [np.zeros(N_HASHED), np.zeros(N_SHARES), np.concatenate([base[:1], np.log(gaps)])]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]

    def thresholds(t: np.ndarray) -> np.ndarray:
        return np.concatenate([t[:1], t[0] + np.cumsum(np.exp(t[1:]))])

    for step in range(1, steps + 1):
        w, u, t = params
        s = np.bincount(row, value * w[index], minlength=n) + dense @ u
        limits = thresholds(t)
        bounds = np.concatenate([[-np.inf], limits, [np.inf]])
        with np.errstate(over="ignore"):
            low = 1 / (1 + np.exp(s - bounds[y]))              # P(grade < y)
            high = 1 / (1 + np.exp(s - bounds[y + 1]))         # P(grade <= y)
        p = np.maximum(high - low, 1e-12)
        d_low, d_high = low * (1 - low) / p, high * (1 - high) / p
        g_score = (d_low - d_high) / n                         # of the mean log likelihood
        g_limit = np.zeros(grades - 1)
        np.add.at(g_limit, y[y < grades - 1], d_high[y < grades - 1] / n)
        np.add.at(g_limit, y[y > 0] - 1, -d_low[y > 0] / n)
        g_t = np.concatenate([[g_limit.sum()], np.exp(t[1:]) * g_limit[::-1].cumsum()[::-1][1:]])
        grads = [np.bincount(index, value * g_score[row], minlength=N_HASHED) - ridge * w,
                 dense.T @ g_score - ridge * u, g_t]
        for k, g in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            params[k] = params[k] + rate * (first[k] / (1 - 0.9 ** step)) / (
                np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
    return OrdinalModel(params[0], params[1], thresholds(params[2]))


def rated_sample(docs: DataFrame, labels: DataFrame, grade: Column, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(__id, __grade, __digest) of at most ``max_labelled`` distinct rated documents.

    A ``doc_id`` that is rated repeatedly has its most frequent grade, the lowest of
    equally frequent ones.  Ratings without a document do not count.  Of the texts
    of a repeated ``doc_id`` the one with the smallest digest is meant.
    """
    rated = labels.select(F.col("doc_id").alias("__id"), grade.cast("int").alias("__grade")).filter(
        F.col("__grade").isNotNull() & F.col("__id").isNotNull())
    rated = rated.groupBy("__id").agg(F.mode("__grade", True).alias("__grade"))
    rated = rated.join(docs.select(F.col("doc_id").alias("__id")).distinct(), "__id", "left_semi")
    sample = materialize(rated.orderBy(F.xxhash64("__id"), "__id").limit(max_labelled), "rated-sample")
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("__id"))
    return texts.groupBy("__id", "__grade").agg(F.min(F.xxhash64("text")).alias("__digest"))


def train(docs: DataFrame, labels: DataFrame, grade: Column, grades: int,
          max_labelled: int = MAX_LABELLED) -> OrdinalModel:
    """Fit on at most ``max_labelled`` distinct rated documents."""
    sample = materialize(rated_sample(docs, labels, grade, max_labelled), "rated-texts")
    texts = docs.select("doc_id", "text").join(
        F.broadcast(sample), (F.col("doc_id") == F.col("__id")) & (F.xxhash64("text") == F.col("__digest"))).select(
        "doc_id", "__grade", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()                                      # copies have one text
        for b in slices(batches):
            first = []
            for k, d in enumerate(b.column(0).to_pylist()):
                if d not in seen:
                    seen.add(d)
                    first.append(k)
            b = b.take(pa.array(first, pa.int64()))
            got = [features(t.as_py() or b"") for t in b.column(2).cast(pa.binary())]
            packed = [pa.array([g[k].tobytes() for g in got], pa.binary()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *packed], ["doc_id", "grade", "i", "v", "d"])

    # packed arrays: the driver holds 12 bytes per feature, not Python lists
    rows = texts.mapInArrow(run, "doc_id long, grade int, i binary, v binary, d binary").groupBy("doc_id", "grade").agg(
        F.min(F.struct("i", "v", "d")).alias("f")).select("doc_id", "grade", "f.*").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["grade"], bytes(r["i"]), bytes(r["v"]), bytes(r["d"])))
    return fit([(np.frombuffer(r["i"], "<u4"), np.frombuffer(r["v"]), np.frombuffer(r["d"]), r["grade"]) for r in rows],
               grades)


class Scorer:
    """Scores of texts.  It is broadcast; a worker's copy keeps the words' weights."""

    def __init__(self, model: OrdinalModel):
        self.model = model
        self.known: dict[bytes, float] = {}

    def scores(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros(len(texts))
        weight, dense = self.model.hashed, self.model.dense
        for k, raw in enumerate(texts):
            words = raw.split()
            if len(self.known) > CACHE_ENTRIES:
                self.known.clear()
            for w in set(words).difference(self.known):
                a, b = word_features(w)
                self.known[w] = float(weight[a] + weight[b])
            out[k] = sum(map(self.known.__getitem__, words)) / max(len(words), 1) + dense @ shares(raw, words)
        return out


def score_documents(docs: DataFrame, model: OrdinalModel, min_tail: float = MIN_TAIL, min_grade: int = 1) -> DataFrame:
    """doc_id, expected_grade, tail_k for every grade k >= 1, and kept: whether
    P(grade >= min_grade) reaches ``min_tail``."""
    shared = docs.sparkSession.sparkContext.broadcast(Scorer(model))
    n = len(model.thresholds)
    schema = "doc_id long, expected_grade double, " + "".join(f"tail_{k} double, " for k in range(1, n + 1)) + "kept boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value
        for b in slices(batches):
            tails = scorer.model.tails(scorer.scores([t.as_py() or b"" for t in b.column(1).cast(pa.binary())]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array(tails.sum(axis=1)), *[pa.array(tails[:, k]) for k in range(n)],
                 pa.array(tails[:, min_grade - 1] >= min_tail)],
                ["doc_id", "expected_grade", *[f"tail_{k}" for k in range(1, n + 1)], "kept"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def select_documents(docs: DataFrame, model: OrdinalModel, min_tail: float = MIN_TAIL, min_grade: int = 1) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged."""
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(Scorer(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value
        for b in slices(batches):
            texts = b.column(at).cast(pa.binary())
            tails = scorer.model.tails(scorer.scores([t.as_py() or b"" for t in texts]))
            yield b.filter(pa.array(tails[:, min_grade - 1] >= min_tail))

    return map_batches(docs, run, docs.schema)


def label_grade() -> Column:
    """Grades of the labels table: 0 poor, 1 sound but toxic, 2 sound."""
    return F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)


GRADES = 3
