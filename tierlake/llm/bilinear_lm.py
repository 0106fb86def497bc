"""LM scoring with a log-bilinear model trained by noise-contrastive estimation.

Vocabulary: the ``CLASSES`` most frequent training words and the end of a text are
outputs of their own; every other word is the output OTHER followed by a choice
within OTHER with probability (c + 0.5) / (N_o + 0.5 (V_o + 1)) from its training
count, where one unseen word stands for all.  So the probabilities of all words
sum to one in every context.

Model: s(w | u, v) = (A * R[u] + B * R[v]) . Q[w] + bias[w] over the classes u, v
of the two words before (elementwise products, a start mark before the text), and
P(w | u, v) = exp(s) / Z(u, v).  Z comes from a matrix product of all new contexts
of a batch with all outputs.

Training gathers, from all training documents, the counts of all words and the
counts of all (u, v, w) class events - sufficient statistics of the model that
grow with the corpus up to the cube of the class number.  Events are dealt to
``TRAIN_SHARDS`` tasks by hash, each runs minibatch noise-contrastive estimation
(noise: unigram counts, their expectation taken exactly) from common parameters, and the parameters are averaged
by event weight, ``ROUNDS`` times.  Shards are sorted and shuffled with a fixed
seed, so the model does not depend on the files' layout.

Counts of the ``HEAD_WORDS`` most frequent words at most are broadcast; words
beyond them are joined by word with the full count table.  A document's id is
never a group key, so rows that repeat a ``doc_id`` are scored one by one.  NULL
text counts as empty (one end token), a NULL ``doc_id`` has the empty string as its
text.  An empty table gives an empty result.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.session import materialize

CLASSES = 510
HEAD_WORDS = 65_536
HASH_BINS = 4096
WIDTH = 24
TRAIN_SHARDS = 8
ROUNDS = 2
EPOCHS = 2
LEAST_STEPS = 300        # a small shard is gone through more often
BATCH = 2048
NOISE = 32
RATE = 0.3
LONGEST_STEP = 0.2       # of one row of parameters
LEAST_SHARE = 0.002      # floor of a word's share when its step is scaled
END = "\n"               # no word contains white space
GROUP_BYTES = 2_000_000
OTHER = 0


def held_out() -> Column:
    """crc32(doc_id as text) mod 5 is 1."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1


def text_words(raw: bytes | None) -> list[bytes]:
    return (raw or b"").lower().split()          # ASCII only, on bytes


def _groups(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Slices of the batches with the words of their texts, about GROUP_BYTES each."""
    for b in batches:
        raw = b.column(text).cast(pa.binary())
        lo, size, words = 0, 0, []
        for k, t in enumerate(raw):
            value = t.as_py()
            words.append(text_words(value))
            size += len(value or b"")
            if size >= GROUP_BYTES or k == b.num_rows - 1:
                yield b.slice(lo, k + 1 - lo), words
                lo, size, words = k + 1, 0, []


# --- counts ---------------------------------------------------------------------------

def word_counts(train: DataFrame) -> DataFrame:
    """(word, c) over all training texts, the end token included; counted per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()).cast(pa.string()),
                                               pa.array(list(held.values()), pa.int64())], ["word", "c"])

        for _, group in _groups(batches, 0):
            for words in group:
                held.update(words)
            held[END.encode()] += len(group)
            if len(held) > 300_000:
                yield out()
                held.clear()
        if held:
            yield out()

    return train.select("text").mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def head_words(counts: DataFrame, most: int = HEAD_WORDS) -> list[tuple[str, int]]:
    """The most frequent words (never the end), at most ``most``, by count then word.

    A histogram of counts gives the least count that still fits, so nothing is
    sorted as a whole.  Of the words of the next lower counts, which do not all fit,
    as many are taken as whole bins of a word hash allow: a table in which most words
    are equally frequent has its classes too.
    """
    words = counts.filter(F.col("word") != END)
    bucket = F.floor(F.log2("c") * 16)
    sizes = sorted(((r["b"], r["n"]) for r in words.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()),
                   reverse=True)
    total, wanted = 0, F.lit(False)
    for b, n in sizes:
        if total + n > most:
            bin_no = F.pmod(F.xxhash64("word"), F.lit(HASH_BINS))
            bins = words.filter(bucket == b).groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
            end = 0
            for k, n_bin in sorted((r["bin"], r["n"]) for r in bins):
                if total + n_bin > most:
                    break
                total, end = total + n_bin, k + 1
            wanted = wanted | ((bucket == b) & (bin_no < end))
            break
        total, wanted = total + n, bucket >= b
    rows = words.filter(wanted).collect()
    return sorted(((r["word"], r["c"]) for r in rows), key=lambda r: (-r[1], r[0]))


class Classes:
    """Word -> output class, and the class counts.  Class 0 is OTHER, then the words,
    then the end; the start mark comes last and is only a context."""

    def __init__(self, head: list[tuple[str, int]], n_all: int, v_all: int, n_end: int, classes: int = CLASSES):
        own = head[:classes]
        self.of = {w.encode(): k + 1 for k, (w, _) in enumerate(own)}
        self.end = len(own) + 1
        self.start = self.end + 1
        self.n_out = self.end + 1
        seen = sum(c for _, c in own)
        self.counts = np.array([n_all - n_end - seen, *[c for _, c in own], n_end], "f8")
        self.other_tokens = n_all - n_end - seen
        self.other_words = v_all - len(own) - (n_end > 0)

    def sequence(self, words: list[bytes]) -> np.ndarray:
        """start, start, the classes of the words, end."""
        out = np.empty(len(words) + 3, "i8")
        out[:2] = self.start
        out[2:-1] = np.fromiter(map(self.of.get, words, repeat(OTHER)), "i8", len(words))
        out[-1] = self.end
        return out

    def events(self, words: list[bytes]) -> np.ndarray:
        s, m = self.sequence(words), self.start + 1
        return (s[:-2] * m + s[1:-1]) * m + s[2:]


def event_counts(train: DataFrame, classes: Classes) -> DataFrame:
    """(event, n): counts of (u, v, w) class triples over all training texts."""
    shared = train.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            codes, where = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
            return codes, np.bincount(where, np.concatenate([n for _, n in held])).astype("i8")

        def out(codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], ["event", "n"])

        for _, group in _groups(batches, 0):
            held.append(np.unique(np.concatenate([shared.value.events(w) for w in group]), return_counts=True))
            if sum(len(c) for c, _ in held) > 2_000_000:
                held = [merged()]
                if len(held[0][0]) > 1_000_000:
                    yield out(*held[0])
                    held = []
        if held:
            yield out(*merged())

    return train.select("text").mapInArrow(run, "event long, n long").groupBy("event").agg(F.sum("n").alias("n"))


# --- the model --------------------------------------------------------------------------

class Model:
    """Parameters and numpy training of the log-bilinear model."""

    def __init__(self, class_counts: np.ndarray, width: int = WIDTH, seed: int = 7):
        rng = np.random.default_rng(seed)
        n = len(class_counts)
        share = (class_counts + 0.5) / (class_counts + 0.5).sum()
        self.noise = share
        self.p = {"R": rng.normal(0, 0.1, (n + 1, width)), "Q": rng.normal(0, 0.1, (n, width)),
                  "A": np.ones(width), "B": np.ones(width), "bias": np.log(share)}

    def vector(self) -> np.ndarray:
        return np.concatenate([v.reshape(-1) for v in self.p.values()])

    def load(self, vector: np.ndarray) -> None:
        at = 0
        for k, v in self.p.items():
            self.p[k] = vector[at:at + v.size].reshape(v.shape).copy()
            at += v.size

    def fit_shard(self, events: np.ndarray, counts: np.ndarray, seed: int, least_steps: int = LEAST_STEPS) -> None:
        """Minibatch gradient ascent on the NCE objective over events weighted by counts.

        The outputs are few enough to take the expectation over the noise
        distribution exactly, with ``NOISE`` noise words per word.  Frequent events
        are split into equal parts so that no batch hangs on one of them.  A
        row's step is divided by the word's share, which makes rare and frequent
        words learn at one pace.
        """
        rng = np.random.default_rng(seed)
        n, m = len(self.noise), len(self.noise) + 1
        parts = np.ceil(counts / (4 * counts.mean())).astype("i8")
        unit = np.repeat(np.arange(len(events)), parts)
        weight, e = (counts / parts)[unit].astype("f4"), events[unit]
        u, v, w = (x.astype("i4") for x in (e // (m * m), e // m % m, e % m))
        R, Q, A, B, bias = (self.p[k].astype("f4") for k in ("R", "Q", "A", "B", "bias"))
        drawn = (NOISE * self.noise).astype("f4")
        log_drawn = np.log(drawn)
        share = (self.noise + LEAST_SHARE).astype("f4")
        share_u = np.append(share, share[-1])         # the start mark is as frequent as the end

        def scattered(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
            order = np.argsort(rows, kind="stable")
            rows = rows[order]
            first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
            out = np.zeros((size, values.shape[1]), "f4")
            out[rows[first]] = np.add.reduceat(values[order], first, axis=0)
            return out

        def sigmoid(x: np.ndarray) -> np.ndarray:
            return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

        def limited(step: np.ndarray) -> np.ndarray:
            length = np.sqrt((step * step).sum(axis=1, keepdims=True))
            return step * np.minimum(1, LONGEST_STEP / np.maximum(length, 1e-9))

        per_epoch = -(-len(e) // BATCH)
        steps = max(EPOCHS * per_epoch, least_steps)
        for step in range(steps):
            if step % per_epoch == 0:
                order = rng.permutation(len(e))
            at = order[step % per_epoch * BATCH:][:BATCH]
            cu, cv, cw, a = u[at], v[at], w[at], weight[at] / weight[at].sum()
            ru, rv = R[cu], R[cv]
            q = A * ru + B * rv
            up = a * (1 - sigmoid((q * Q[cw]).sum(axis=1) + bias[cw] - log_drawn[cw]))
            down = -a[:, None] * sigmoid(q @ Q.T + bias - log_drawn) * drawn
            g_q = up[:, None] * Q[cw] + down @ Q
            rate = np.float32(RATE * (1 - step / steps))
            g_Q = scattered(cw, up[:, None] * q, n) + down.T @ q
            g_bias = np.bincount(cw, up, minlength=n) + down.sum(axis=0)
            g_R = scattered(np.concatenate([cu, cv]), np.concatenate([g_q * A, g_q * B]), n + 1)
            Q += limited(rate * g_Q / share[:, None])
            R += limited(rate * g_R / share_u[:, None])
            bias += limited((rate * g_bias / share).astype("f4")[:, None])[:, 0]
            A += limited(rate * (g_q * ru).sum(axis=0)[None, :])[0]
            B += limited(rate * (g_q * rv).sum(axis=0)[None, :])[0]
        for k, x in zip(("R", "Q", "A", "B", "bias"), (R, Q, A, B, bias)):
            self.p[k] = x.astype("f8")


def train_model(events: DataFrame, class_counts: np.ndarray, rounds: int = ROUNDS, shards: int = TRAIN_SHARDS) -> Model:
    """Rounds of parallel NCE on hashed shards of the events; parameters are averaged
    by weight.  ``shards`` parameter vectors reach the driver per round."""
    model = Model(class_counts)
    dealt = materialize(events.withColumn("shard", F.pmod(F.xxhash64("event"), F.lit(shards)).cast("int")), "lm-events")
    for number in range(rounds):
        now = model

        def run(batches: Iterator[pa.RecordBatch], now=now, number=number) -> Iterator[pa.RecordBatch]:
            tables = [b for b in batches if b.num_rows]
            if not tables:
                return
            cols = [np.concatenate([b.column(k).to_numpy() for b in tables]) for k in range(3)]
            for s in np.unique(cols[2]).tolist():
                mine = cols[2] == s
                order = np.argsort(cols[0][mine])
                local = Model(now.noise)
                local.noise = now.noise
                local.load(now.vector())
                local.fit_shard(cols[0][mine][order], cols[1][mine][order].astype("f8"), 1000 * number + s)
                yield pa.RecordBatch.from_arrays([
                    pa.array([s], pa.int32()), pa.array([int(cols[1][mine].sum())], pa.int64()),
                    pa.array([local.vector().tobytes()], pa.binary())], ["shard", "n", "vector"])

        rows = dealt.select("event", "n", "shard").repartition(shards, "shard").mapInArrow(
            run, "shard int, n long, vector binary").collect()
        if rows:
            rows.sort(key=lambda r: r["shard"])
            model.load(np.average([np.frombuffer(r["vector"]) for r in rows], axis=0, weights=[r["n"] for r in rows]))
    return model


class Scorer:
    """Per worker: class scores with the normalisers of all contexts met so far."""

    def __init__(self, model: Model, classes: Classes, head: list[tuple[str, int]]):
        p = model.p
        self.first, self.second = (p["A"] * p["R"]).astype("f4"), (p["B"] * p["R"]).astype("f4")
        self.out, self.bias = p["Q"].astype("f4"), p["bias"].astype("f4")
        self.classes = classes
        self.m = classes.start + 1
        self.log_z = np.full(self.m * self.m, np.nan)
        self.count = {w.encode(): c for w, c in head}

    def event_logs(self, events: np.ndarray) -> np.ndarray:
        """Natural log P(w | u, v) of each event."""
        context = events // self.m
        new = np.unique(context)
        new = new[np.isnan(self.log_z[new])]
        for lo in range(0, len(new), 4096):
            c = new[lo:lo + 4096]
            s = (self.first[c // self.m] + self.second[c % self.m]) @ self.out.T + self.bias
            top = s.max(axis=1)
            self.log_z[c] = top + np.log(np.exp(s - top[:, None]).sum(axis=1, dtype="f8"))
        out = np.empty(len(events))
        for lo in range(0, len(events), 65_536):
            e = events[lo:lo + 65_536]
            c, w = e // self.m, e % self.m
            q = self.first[c // self.m] + self.second[c % self.m]
            out[lo:lo + 65_536] = np.einsum("ij,ij->i", q, self.out[w]) + self.bias[w] - self.log_z[c]
        return out


ROW_SCHEMA = ("rid long, word string, tf long, doc_id long, n_tokens long, n_known long, base double, score double, "
              "n_other long")


def _scored_rows(docs: DataFrame, shared) -> DataFrame:
    """One row per document with everything that the broadcast head settles, and one row
    per document and word beyond the head (``word``, ``tf``).

    A document's own row carries a key that no word can equal.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value
        classes, count = scorer.classes, scorer.count
        own_class = classes.of
        value = {w: float(np.log10(c + 0.5)) for w, c in count.items()}
        end = float(np.log10(classes.counts[-1] + 0.5))
        for b, group in _groups(batches, 2):
            events = [classes.events(w) for w in group]
            logs = scorer.event_logs(np.concatenate(events)) / np.log(10)
            sums = np.add.reduceat(logs, np.cumsum([0, *[len(e) for e in events[:-1]]])) if events else []
            rids, ids = b.column(0).to_pylist(), b.column(1).to_pylist()
            rows: list[list] = [[], [], [], [], [], [], [], [], []]
            for rid, doc_id, words, total in zip(rids, ids, group, sums):
                tally = Counter(words)
                tail = [(w, n) for w, n in tally.items() if w not in value]
                known = [(w, n) for w, n in tally.items() if w in value]
                base = end + sum(value[w] * n for w, n in known)
                other = sum(value[w] * n for w, n in known if w not in own_class)
                n_other = sum(n for w, n in tally.items() if w not in own_class)
                has_end = classes.counts[-1] > 0
                for col, x in zip(rows, (rid, f"{END}{rid}", 0, doc_id, len(words) + 1,
                                         sum(n for _, n in known) + int(has_end), base, float(total) + other, n_other)):
                    col.append(x)
                k = len(tail)
                rows[0] += [rid] * k
                rows[1] += [w.decode() for w, _ in tail]
                rows[2] += [n for _, n in tail]
                for col in rows[3:]:
                    col += [None] * k
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(),
                     pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, kinds)],
                                             ["rid", "word", "tf", "doc_id", "n_tokens", "n_known", "base", "score", "n_other"])

    numbered = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    return numbered.mapInArrow(run, ROW_SCHEMA)


def score_documents(docs: DataFrame) -> DataFrame:
    """Train on the documents that are not held out and score all:
    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    train = docs.filter(~held_out())
    counts = materialize(word_counts(train), "lm-counts")
    total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"),
                       F.sum(F.when(F.col("word") == END, F.col("c"))).alias("ends")).first()
    n_all, v_all, n_end = int(total["n"] or 0), int(total["v"]), int(total["ends"] or 0)
    head = head_words(counts)
    classes = Classes(head, n_all, v_all, n_end)
    model = train_model(event_counts(train, classes), classes.counts)
    rows = _scored_rows(docs, spark.sparkContext.broadcast(Scorer(model, classes, head)))

    joined = rows.join(counts, "word", "left")
    tail = F.col("tf") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    per = joined.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.max("n_other").alias("n_other"),
        F.max("base").alias("base"), F.max("score").alias("score"),
        F.sum(F.coalesce("n_known", F.when(F.col("c").isNotNull(), F.col("tf")), F.lit(0))).alias("n_known"),
        F.sum(tail).alias("tail"))
    all_log = float(np.log10(n_all + 0.5 * (v_all + 1)))
    other_log = float(np.log10(classes.other_tokens + 0.5 * (classes.other_words + 1)))
    return per.select(
        "doc_id", held_out().alias("held_out"), "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("tail") - F.col("n_tokens") * all_log).alias("base_score"),
        (F.col("score") + F.col("tail") - F.col("n_other") * other_log).alias("score"))
