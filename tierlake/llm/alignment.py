"""Cross-tokenizer alignment: groups of tokens between common byte ends, and their links.

Two tokenizers cut the same bytes.  Cumulative token ends go into two end-to-index
dictionaries; the ends that both hold, sorted, slice both id lists into groups, and in
a group every A token is linked with every B token.  A pair's count is the number of
documents that hold it linked.

1. A map encodes and aligns.  Neither tokenizer has a token across a single space or
   line feed between two other characters (``_safe_cuts`` verifies it from the files),
   so a text is the concatenation of such chunks, their last bytes are common ends, and
   a distinct chunk is encoded, aligned and expanded once (many in one call), and known to
   its worker until a fixed number of chunks or bytes is reached.  A text with a chunk whose joined token bytes are not its
   own goes through as a whole, without cuts.  Per document the distinct links and their
   multiplicities are packed as numbers ``a * |B| + b`` and written once.
2. Counts are partial sums of each task's distinct pairs, then one shuffle by pair.  The
   highest count of an A id is joined from at most |A| rows.
3. The most frequent pairs - at most ``HEAD_PAIRS``, chosen by a histogram of the counts -
   are broadcast and looked up where the links are; they are the hot keys.  The links of
   all rarer pairs are shuffled by pair and joined with the rest of the counts.

Texts that are NULL, empty or not reproduced by a tokenizer's token bytes have no tokens:
zeros and an empty groups text.  Special tokens' strings are plain text.  Repeated rows
count as documents of their own, whatever their ids.  A very long text is one row of the
map; a group's links are kept as distinct pairs with multiplicities.  An empty table gives
an empty result.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.bpe import byte_symbols
from tierlake.session import materialize

SPACE_MARK = "▁"
GROUP_CHARS = 1_000_000
CACHE_ENTRIES = 500_000     # chunks known to a worker before it forgets them all
CACHE_BYTES = 1 << 27       # of their texts, likewise
SLICE = 4096
HEAD_PAIRS = 1 << 18        # pairs whose counts are broadcast, at most
COUNT_STEPS = 8             # histogram buckets per doubling of the count
FLUSH_CODES = 1 << 22

# A chunk begins with white space and goes on over any white space that is not one space
# or line feed between two other characters.
CHUNK = re.compile(r"\s+\S*(?:(?![ \n]\S)\s+\S*)*")
# Characters that some definitions count as white space and Python's does not.
ODD_SPACES = re.compile("[" + "".join(map(chr, (0x180E, 0x200B, 0xFEFF))) + "]")


def code_type(size_a: int, size_b: int) -> str:
    """Of a pair's number ``a * size_b + b``."""
    return "<u4" if size_a * size_b <= 1 << 32 else "<u8"


SAFE_CHUNK = re.compile(r"[ \n]\S(?:.*\S)?", re.DOTALL).fullmatch
LARGE_GROUP = 4096          # links of a group beyond which distinct pairs are counted instead


class Known:
    """What the known chunks align to, by number: sizes, groups texts and the links' codes."""

    def __init__(self, dtype: str):
        self.dtype = dtype
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}        # -1: its text goes through as a whole
        self.groups: list[str] = []
        self.sizes = np.zeros((0, 4), "int64")
        self.starts = np.zeros(0, "int64")
        self.codes = np.zeros(0, self.dtype)
        self.used = self.held = 0

    @staticmethod
    def _room(x: np.ndarray, used: int, more: int) -> np.ndarray:
        if used + more <= len(x):
            return x
        return np.concatenate([x[:used], np.zeros((max(used, more) + more, *x.shape[1:]), x.dtype)])

    def add(self, chunks: list[str], sizes: np.ndarray, groups: list[str], codes: np.ndarray) -> None:
        at, end = len(self.groups), len(self.groups) + len(chunks)
        self.sizes, self.starts = self._room(self.sizes, at, len(chunks)), self._room(self.starts, at, len(chunks))
        self.codes = self._room(self.codes, self.used, len(codes))
        self.sizes[at:end] = sizes
        self.starts[at:end] = self.used + np.cumsum(sizes[:, 3]) - sizes[:, 3]
        self.codes[self.used:self.used + len(codes)] = codes
        self.used += len(codes)
        self.groups += groups
        self.number.update(zip(chunks, range(at, end)))
        self.held += sum(map(len, groups)) + sum(map(len, chunks)) + codes.nbytes

    def codes_of(self, numbers: np.ndarray) -> np.ndarray:
        """The codes of the chunks, one after the other."""
        n = self.sizes[numbers, 3]
        ends = np.cumsum(n)
        return self.codes[np.repeat(self.starts[numbers] - ends + n, n) + np.arange(ends[-1])]


class Aligner:
    """Two tokenizer files: a byte-level BPE (A) and a sentencepiece model (B)."""

    def __init__(self, path_a: str, path_b: str, cache_entries: int = CACHE_ENTRIES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        of_symbol = {c: b for b, c in byte_symbols().items()}
        entries = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.bytes_a[i] = bytes(of_symbol[c] for c in entry) if all(c in of_symbol for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
                        for i, p in enumerate(pieces)]
        self.size_b = len(pieces)
        self.dtype = code_type(len(self.bytes_a), self.size_b)
        self.length_a, self.length_b = (list(map(len, x)) for x in (self.bytes_a, self.bytes_b))
        self.written = list(map(str, range(max(len(self.bytes_a), self.size_b))))
        self.mark = self.b.piece_to_id(SPACE_MARK)
        self.cuts = self._safe_cuts(spec, [p for i, p in enumerate(pieces) if not self.b.is_byte(i)])
        self.known, self.most = Known(self.dtype), cache_entries

    @staticmethod
    def _safe_cuts(spec: dict, pieces: list[str]) -> bool:
        """No token of either file can cross the start of " x" or of "\\nx"."""
        pre = spec.get("pre_tokenizer") or {}
        plain = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) \
            and not pre.get("add_prefix_space")
        return plain and not any(SPACE_MARK in p.lstrip(SPACE_MARK) or "\n" in p for p in pieces)

    def _ids(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of a text that begins with white space; None if they do not spell its bytes."""
        ids_a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        ids_b = self.b.encode(text[1:] if text[0] == " " else text)         # B puts a space before any text
        if text[0] != " " and ids_b and ids_b[0] == self.mark:
            ids_b = ids_b[1:]
        own = text.encode()
        if b"".join(map(self.bytes_a.__getitem__, ids_a)) != own or b"".join(map(self.bytes_b.__getitem__, ids_b)) != own:
            return None
        return ids_a, ids_b

    def _group_text(self, a: list[int], b: list[int]) -> str:
        w = self.written
        if len(a) == 1 == len(b):
            return f"{w[a[0]]}|{w[b[0]]}"
        return f"{','.join([w[x] for x in a])}|{','.join([w[x] for x in b])}"

    def _align(self, chunks: list[str]) -> tuple | None:
        """(n_a, n_b, n_groups, n_links) and the groups text of each chunk, and the codes and
        times of all links, cut out of the alignment of the joined chunks.  Times are None
        where every code is one link; a large group has each of its pairs once."""
        ids = self._ids("".join(chunks))
        if ids is None:
            return None
        ids_a, ids_b = ids
        ends_a = dict(zip(accumulate(map(self.length_a.__getitem__, ids_a)), range(1, len(ids_a) + 1)))
        ends_b = dict(zip(accumulate(map(self.length_b.__getitem__, ids_b)), range(1, len(ids_b) + 1)))
        common = sorted(ends_a.keys() & ends_b.keys())
        to_a, to_b = list(map(ends_a.__getitem__, common)), list(map(ends_b.__getitem__, common))
        from_a, from_b = [0, *to_a[:-1]], [0, *to_b[:-1]]
        texts = [self._group_text(ids_a[i:j], ids_b[k:m]) for i, j, k, m in zip(from_a, to_a, from_b, to_b)]
        # chunk ends are common ends: the groups of chunk c are first[c] to first[c + 1]
        stops = np.cumsum([len(c.encode()) for c in chunks])
        first = np.concatenate(([0], np.searchsorted(common, stops) + 1))
        at_a, at_b = np.array([0, *to_a]), np.array([0, *to_b])
        n_a, n_b = np.diff(at_a), np.diff(at_b)
        n = n_a * n_b
        at = np.concatenate(([0], np.cumsum(n)))
        sizes = np.stack([np.diff(x[first]) for x in (at_a, at_b, np.arange(len(common) + 1), at)], axis=1)
        first = first.tolist()
        groups = [";".join(texts[g:h]) for g, h in zip(first, first[1:])]
        if n.max() > LARGE_GROUP:
            return sizes, groups, *self._counted(ids_a, ids_b, at_a.tolist(), at_b.tolist())
        group = np.repeat(np.arange(len(n)), n)
        k = np.arange(at[-1]) - at[group]
        a = np.array(ids_a, "int64")[at_a[group] + k // n_b[group]]
        b = np.array(ids_b, "int64")[at_b[group] + k % n_b[group]]
        return sizes, groups, (a * self.size_b + b).astype(self.dtype), None

    def _counted(self, ids_a: list[int], ids_b: list[int], at_a: list[int], at_b: list[int]) -> tuple:
        """Codes and times, each pair of a group once."""
        codes, times = [], []
        for i, j, k, m in zip(at_a, at_a[1:], at_b, at_b[1:]):
            of_b = Counter(ids_b[k:m])
            for x, n in Counter(ids_a[i:j]).items():
                codes += [x * self.size_b + y for y in of_b]
                times += [n * t for t in of_b.values()]
        return np.array(codes, self.dtype), np.array(times, "int64")

    def _learn(self, chunks: list[str]) -> None:
        """Align new chunks; one that the tokenizers do not give back, or with a large group,
        is found by halving."""
        found = self._align(chunks)
        if found is not None and found[3] is None:
            self.known.add(chunks, *found[:3])
        elif len(chunks) == 1:
            self.known.number[chunks[0]] = -1
        else:
            self._learn(chunks[:len(chunks) // 2])
            self._learn(chunks[len(chunks) // 2:])

    def _result(self, text: str, chunks: list[str]) -> tuple | None:
        """n_a, n_b, n_groups, n_links, groups digest, distinct codes, how often each."""
        numbers = list(map(self.known.number.__getitem__, chunks))
        if min(numbers) >= 0:
            at = np.array(numbers)
            totals = self.known.sizes[at].sum(axis=0)
            groups = ";".join(map(self.known.groups.__getitem__, numbers))
            distinct, times = np.unique(self.known.codes_of(at), return_counts=True)
        else:
            whole = self._align([" " + text])
            if whole is None:
                return None
            (totals,), (groups,), every, weight = whole
            distinct, where = np.unique(every, return_inverse=True)
            times = np.bincount(where, weights=weight, minlength=len(distinct))
        return *totals.tolist(), hashlib.sha256(groups.encode()).hexdigest(), distinct, times.astype("<u4")

    def align_batch(self, texts: Iterable[str | None]) -> Iterator[tuple | None]:
        """One result per text, None without tokens."""
        group: list[tuple[str, list[str]]] = []
        size = 0

        def flush() -> Iterator[tuple | None]:
            if len(self.known.number) > self.most or self.known.held > CACHE_BYTES:
                self.known.clear()
            new = set().union(*[c for _, c in group]).difference(self.known.number)
            joined = sorted(filter(SAFE_CHUNK, new))
            for part in [joined[k:k + SLICE] for k in range(0, len(joined), SLICE)]:
                self._learn(part)
            for c in new.difference(joined):
                self._learn([c])
            for text, chunks in group:
                yield self._result(text, chunks) if chunks else None

        for t in texts:
            text = t or ""
            if not text:
                chunks = []
            elif self.cuts and not ODD_SPACES.search(text):
                chunks = CHUNK.findall(" " + text)
            else:
                chunks = [" " + text]
            group.append((text, chunks))
            size += len(text)
            if size >= GROUP_CHARS:
                yield from flush()
                group, size = [], 0
        yield from flush()


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


LINK_FIELDS = ["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "times"]
LINK_SCHEMA = ("rid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
               "codes binary, times binary")
SLICE_ROWS = 256


def document_links(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per row of ``docs``: sizes, groups digest and packed distinct links."""
    nothing = (0, 0, 0, 0, "", np.zeros(0, "<u4"), np.zeros(0, "<u4"))
    types = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        for b in (b.slice(k, SLICE_ROWS) for b in batches for k in range(0, b.num_rows, SLICE_ROWS)):
            rows = [r or nothing for r in both.align_batch(b.column(2).to_pylist())]
            packed = [(*r[:5], r[5].tobytes(), r[6].tobytes()) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *[pa.array(c, t) for c, t in zip(zip(*packed), types)]], LINK_FIELDS)

    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, LINK_SCHEMA)


def pair_counts(links: DataFrame, size_b: int, dtype: str) -> DataFrame:
    """code, n (documents that hold the pair linked), best (n is the A id's highest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            codes, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(codes.astype("int64")), pa.array(n.astype("int64"))], ["code", "n"])

        for b in batches:
            for packed in b.column(0):
                codes = np.frombuffer(packed.as_py(), dtype)
                held.append(codes)
                size += len(codes)
                if size >= FLUSH_CODES:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    counts = links.select("codes").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "alignment-counts")
    a = F.expr(f"code div {size_b}")
    highest = counts.groupBy(a.alias("a")).agg(F.max("n").alias("highest"))         # at most |A| rows
    return counts.withColumn("a", a).join(F.broadcast(highest), "a").select(
        "code", "n", (F.col("n") == F.col("highest")).alias("best"))


def _bucket():
    """Monotone in n, 0 for n = 1."""
    return F.floor(F.log2(F.col("n").cast("double")) * COUNT_STEPS).cast("int")


def head_bucket(counts: DataFrame, most: int) -> int:
    """The lowest count bucket from which on there are at most ``most`` pairs."""
    sizes = counts.groupBy(_bucket().alias("b")).count().collect()      # at most 64 * COUNT_STEPS rows
    total, lowest = 0, 64 * COUNT_STEPS
    for b, n in sorted(((r["b"], r["count"]) for r in sizes), reverse=True):
        if total + n > most:
            break
        total, lowest = total + n, b
    return lowest


RESULT = ["n_a", "n_b", "n_groups", "n_links"]


def align_documents(docs: DataFrame, path_a: str, path_b: str, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per row of ``docs``."""
    spark = docs.sparkSession
    both = aligner(path_a, path_b)
    size_b, dtype = both.size_b, both.dtype
    links = materialize(document_links(docs, path_a, path_b), "alignment-links")
    counts = materialize(pair_counts(links, size_b, dtype), "alignment-best")
    lowest = head_bucket(counts, head_pairs)
    head = counts.filter(_bucket() >= lowest).orderBy("code").toArrow()         # at most head_pairs rows
    head = spark.sparkContext.broadcast(tuple(head.column(k).to_numpy() for k in ("code", "n", "best")))
    schema = ("rid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "n_best long, count_sum long, codes array<long>, times array<long>")
    fields = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = head.value
        for b in (b.slice(k, SLICE_ROWS) for b in batches for k in range(0, b.num_rows, SLICE_ROWS)):
            sums, rest_codes, rest_times = [], [], []
            for packed, packed_times in zip(b.column(7), b.column(8)):
                codes = np.frombuffer(packed.as_py(), dtype).astype("int64")
                times = np.frombuffer(packed_times.as_py(), "<u4").astype("int64")
                at = np.minimum(np.searchsorted(known, codes), max(len(known) - 1, 0))
                hit = known[at] == codes if len(known) else np.zeros(len(codes), bool)
                at, own = at[hit], times[hit]
                sums.append((int((own * best[at]).sum()), int((own * n[at]).sum())))
                rest_codes.append(codes[~hit])
                rest_times.append(times[~hit])
            ends = pa.array(np.cumsum([0, *map(len, rest_codes)], dtype="int32"))
            yield pa.RecordBatch.from_arrays([
                *b.columns[:7], pa.array([s[0] for s in sums], pa.int64()), pa.array([s[1] for s in sums], pa.int64()),
                *[pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x))) for x in (rest_codes, rest_times)]], fields)

    met = links.mapInArrow(run, schema)
    # Every document has one row of its own with its head sums, under a code that no pair has.
    own = F.struct((-1 - F.col("rid")).alias("codes"), F.lit(0).cast("long").alias("times"))
    rows = met.withColumn("link", F.explode(F.concat(F.arrays_zip("codes", "times"), F.array(own)))).drop("codes", "times")
    is_own = F.col("link.codes") < 0
    once = ["doc_id", *RESULT, "groups_sha256", "n_best", "count_sum"]
    rows = rows.select("rid", F.col("link.codes").alias("code"), F.col("link.times").alias("times"),
                       *[F.when(is_own, F.col(c)).alias(c) for c in once])
    rare = counts.filter(_bucket() < lowest)
    joined = rows.join(rare, "code", "left")
    times = F.coalesce(F.col("times"), F.lit(0))
    return joined.groupBy("rid").agg(
        *[F.max(c).alias(c) for c in ("doc_id", *RESULT, "groups_sha256")],
        F.sum(F.coalesce("n_best", F.lit(0)) + F.when(F.col("best"), times).otherwise(0)).alias("n_best"),
        F.sum(F.coalesce("count_sum", F.lit(0)) + F.coalesce(times * F.col("n"), F.lit(0))).alias("count_sum")).select(
        "doc_id", *RESULT, "n_best", "count_sum", "groups_sha256")
