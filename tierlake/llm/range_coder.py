"""Token ids as compressed binary blocks: an adaptive context-mixing range coder.

Model, per block, reset at its start: an order-2 table (hash of the last two ids)
and an order-1 table (hash of the last id) each predict one id with a confidence
of 0 to 3.  Which of them is right - order 2, order 1 or neither - is a
three-way event whose adaptive probabilities are chosen by both confidences and
by whether the predictions agree, so they are the mixing weights of the orders
in that context.  If neither is right, order 0 codes the id by the frequencies of
the segment's ids, which the segment's header holds: a block of a few thousand ids is too
short to learn a vocabulary from.  The ``HEAD`` most frequent ids are coded in one step,
the others by an escape and a second one.  Each decision is one step
of a range coder with 32-bit low and range that writes 16-bit words.

Blocks hold ``BLOCK`` ids, are independent of each other, and carry the CRC-32 of their ids.  A
segment is about ``SEGMENT`` ids of whole documents cut into blocks; its blocks
are coded side by side in numpy, one lane per block, which turns the
inherently sequential coder into array operations.  The file format is a Parquet
folder with one row per segment: documents, their lengths, the blocks' word
counts and checksums, and the words.  Reading decodes each segment by itself and
raises on any checksum that differs.

Rows are range-partitioned and sorted by ``doc_id`` (NULL first, equal ids by a hash
of their text), so files are in ascending ``doc_id`` order; no global sort passes through
one task.  NULL text is empty and still gets its end id; an empty table gives
no segments.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierlake.llm.bpe import encoder
from tierlake.llm.common import text_or_empty
from tierlake.session import scratch_path

BLOCK = 2048
SEGMENT = 8_000_000
SLOTS1, SLOTS2 = 1024, 2048
CONTEXTS = 32           # 4 confidences x 4 confidences x agreement
BITS = 12               # event probabilities are in units of 1 / 4096
ONE = np.uint32(1 << BITS)
EVENT_RATE = 4
FULL = (1 << BITS) - 3
HEAD = 8192             # ids coded in one step of order 0
ORDER0_BITS = 16        # order-0 probabilities are in units of 1 / 65,536


class Frequencies:
    """Order 0: the segment's ids by frequency, as ranges of the unit interval.

    Every id that occurs has a range, the more frequent the wider; the escape stands
    first among the head's symbols.
    """

    def __init__(self, counts: np.ndarray):
        """``counts``: of every id from 0 on."""
        used = np.flatnonzero(counts)
        ranked = used[np.lexsort((used, -counts[used].astype("i8")))]
        head, tail = ranked[:HEAD], ranked[HEAD:]
        size = max(len(counts), 1)
        self.ranges, self.ranges2 = np.zeros(size, "u4"), np.zeros(size, "u4")      # width - 1 << 16 | start
        edges = self._edges(np.concatenate(([counts[tail].sum(dtype="i8")], counts[head])))
        self.escape = edges[1]      # the escape's range ends here
        self.ranges[head] = self._packed(edges[1:])
        if tail.size:
            self.ranges[tail] = self._packed(edges[:2])
        first = np.concatenate((tail[:1] if tail.size else [0], head))
        self.ids = np.repeat(first, np.diff(edges)).astype("u4")     # by place in the interval; the escape's: any of the tail
        edges = self._edges(counts[tail])
        self.ranges2[tail] = self._packed(edges)
        self.ids2 = np.repeat(tail, np.diff(edges)).astype("u4")

    @staticmethod
    def _packed(edges: np.ndarray) -> np.ndarray:
        return (np.diff(edges) - np.uint32(1)) << np.uint32(16) | edges[:-1]

    @staticmethod
    def _edges(counts: np.ndarray) -> np.ndarray:
        """Range ends in proportion to the counts, at least one unit each that occurs."""
        counts = counts.astype("i8")
        if not counts.sum():
            return np.zeros(len(counts) + 1, "u4")
        some = (counts > 0).astype("i8")
        width = some + counts * ((1 << ORDER0_BITS) - some.sum()) // counts.sum()
        width[np.argmax(width)] += (1 << ORDER0_BITS) - width.sum()
        return np.concatenate(([0], np.cumsum(width))).astype("u4")


def _unpacked(ranges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, width) of packed ranges."""
    return ranges & np.uint32(0xFFFF), (ranges >> np.uint32(16)) + np.uint32(1)


class Lanes:
    """The model state of n blocks that are coded side by side.

    Adaptive probabilities are kept as limits in the unit interval that move a
    fixed share of the way towards what occurred.  A limit is raised by its
    number when it is used, so that no outcome ever has probability zero.
    """

    def __init__(self, n: int):
        self.n = n
        self.lane = np.arange(n)
        # Both tables in one, slot by slot: the order-1 slots of all lanes, then the order-2 ones.
        self.table = np.zeros(n * (SLOTS1 + SLOTS2), "u4")      # confidence << 16 | predicted id
        self.places = np.stack([self.lane, self.lane + n * SLOTS1])
        self.slots = np.zeros((2, n), "u4")
        # limits of "order 2 is right" (low half) and "order 2 or order 1 is right" (high half), by context
        self.limits = np.full(n * CONTEXTS, 2 * FULL // 5 << 16 | FULL // 5, "<u4")
        self.last1 = np.zeros(n, "u4")
        self.last2 = np.zeros(n, "u4")

    def predict(self) -> None:
        """Row 0 of ``guess`` and ``trust`` is order 1, row 1 is order 2."""
        one = self.last1
        np.bitwise_and(one, np.uint32(SLOTS1 - 1), out=self.slots[0])
        np.bitwise_and(one * np.uint32(0x85EBCA6B) + self.last2 * np.uint32(0xC2B2AE35), np.uint32(SLOTS2 - 1),
                       out=self.slots[1])
        self.at = np.multiply(self.slots, self.n, dtype="i8")
        self.at += self.places
        entry = self.table.take(self.at)
        self.guess = entry & np.uint32(0xFFFF)
        self.trust = (entry >> np.uint32(16)).astype("u1")
        context = self.trust[1] * np.uint8(8) + self.trust[0] * np.uint8(2) + (self.guess[0] == self.guess[1])
        self.at_event = np.multiply(context, self.n, dtype="i8")
        self.at_event += self.lane
        self.raw = self.limits.take(self.at_event)
        self.upto2 = (self.raw & np.uint32(0xFFFF)) + np.uint32(1)
        self.upto1 = (self.raw >> np.uint32(16)) + np.uint32(2)

    def event(self, hit2: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of what occurred; the masks (all bits or none) say whether order 2 was
        right and whether order 2 or order 1 was."""
        start = (self.upto1 ^ (self.upto1 ^ self.upto2) & hit) & ~hit2
        end = ONE ^ (ONE ^ self.upto1) & hit
        return start, end ^ (end ^ self.upto2) & hit2

    def update(self, ids: np.ndarray, right: np.ndarray, hit2: np.ndarray, hit: np.ndarray) -> None:
        """``right``: which predictions were; ``hit2`` and ``hit``: the masks of ``event``."""
        # Confidence after a miss with 0-3: 1, 1, 1, 2; after a hit: 1, 2, 3, 3.
        trust, guess = self.trust, self.guess
        kept = _mask(right | (trust > 1))
        most = trust & (trust >> np.uint8(1))
        trust = (most ^ (most ^ (trust - most)) & -right.view("u1")) + np.uint8(1)
        entry = trust.astype("u4")
        entry <<= np.uint32(16)
        entry |= ids ^ (ids ^ guess) & kept
        self.table[self.at] = entry
        occurred = (hit2 & np.uint32(FULL) | hit & np.uint32(FULL << 16)).view("<i2")
        raw = self.raw.view("<i2")
        raw += (occurred - raw) >> np.int16(EVENT_RATE)
        self.limits[self.at_event] = self.raw
        self.last2, self.last1 = self.last1, ids


def _mask(flags: np.ndarray) -> np.ndarray:
    """All 32 bits where the flag is set."""
    return np.negative(flags.astype("i4")).view("u4")


def _narrowed(whole: np.ndarray, unit: np.ndarray, start: np.ndarray, share: np.ndarray,
              among: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """How far the low ends move and the new widths; outside the mask ``among`` all stays as it is."""
    moved, width = unit * start, unit * share
    if among is not None:
        moved &= among
        width ^= whole
        width &= among
        width ^= whole
    return moved, width


class Writer:
    """Range encoder of n lanes.

    Words are noted in the order of the steps with their lanes and sorted by lane at
    the end; a carry adds one to the lane's word before, wherever that lies.
    """

    def __init__(self, n: int):
        self.low = np.zeros(n, "u4")
        self.range = np.full(n, 0xFFFFFFFF, "u4")
        self.used = np.zeros(n, "i8")
        self.kind = "u2" if n <= 1 << 16 else "u4"      # of lane numbers; the first are sorted by radix
        self.lanes: list[np.ndarray] = []
        self.words: list[np.ndarray] = []
        self.carries: list[tuple[np.ndarray, np.ndarray]] = []

    def code(self, lanes: np.ndarray | None, start: np.ndarray, share: np.ndarray, bits,
             among: np.ndarray | None = None) -> None:
        """Narrow to ``share`` units from ``start`` on of 2^bits; ``lanes`` None: all of them;
        ``among``: a mask of those that are narrowed at all."""
        low, unit = (self.low, self.range) if lanes is None else (self.low.take(lanes), self.range.take(lanes))
        moved, width = _narrowed(unit, unit >> bits, start, share, among)
        moved += low
        carry = np.flatnonzero(moved < low)
        if carry.size:
            at = carry if lanes is None else lanes[carry]
            self.carries.append((at, self.used[at] - 1))
        small = np.flatnonzero(width < 65536)
        if small.size:
            at, top = small if lanes is None else lanes[small], moved[small]
            self.lanes.append(at.astype(self.kind))
            self.words.append(top >> np.uint32(16))
            self.used[at] += 1
            moved[small] = top << np.uint32(16)
            width[small] = width[small] << np.uint32(16)
        if lanes is None:
            self.low, self.range = moved, width
        else:
            self.low[lanes], self.range[lanes] = moved, width

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        """(words per lane, all words lane by lane)."""
        every = np.arange(len(self.low), dtype=self.kind)
        for part in (self.low >> np.uint32(16), self.low & np.uint32(0xFFFF)):
            self.lanes.append(every)
            self.words.append(part)
            self.used += 1
        lanes = np.concatenate(self.lanes)
        words = np.concatenate(self.words)[np.argsort(lanes, kind="stable")]
        first = np.cumsum(self.used) - self.used
        for at, place in self.carries:
            words[first[at] + place] += 1
        while (over := np.flatnonzero(words > 0xFFFF)).size:
            words[over] &= 0xFFFF
            words[over - 1] += 1
        return self.used.astype("<u4"), words.astype("<u2")


class Reader:
    """Range decoder of n lanes."""

    def __init__(self, counts: np.ndarray, words: np.ndarray):
        self.words = np.concatenate([words, np.zeros(2, "<u2")]).astype("u4")
        self.at = np.concatenate([[0], np.cumsum(counts[:-1], dtype="i8")]).astype("i8")
        self.ahead = (self.words[self.at] << np.uint32(16)) | self.words[self.at + 1]
        self.at += 2
        self.range = np.full(len(counts), 0xFFFFFFFF, "u4")

    def target(self, lanes: np.ndarray | None, bits) -> np.ndarray:
        """Where in 2^bits the coded value lies."""
        self.now, self.whole = (self.ahead, self.range) if lanes is None else \
            (self.ahead.take(lanes), self.range.take(lanes))
        self.unit = self.whole >> bits
        return np.minimum(self.now // self.unit, (np.uint32(1) << bits) - np.uint32(1))

    def advance(self, lanes: np.ndarray | None, start: np.ndarray, share: np.ndarray,
                among: np.ndarray | None = None) -> None:
        moved, width = _narrowed(self.whole, self.unit, start, share, among)
        ahead = self.now - moved
        small = np.flatnonzero(width < 65536)
        if small.size:
            at = small if lanes is None else lanes[small]
            place = self.at[at]
            ahead[small] = (ahead[small] << np.uint32(16)) | self.words[place]
            self.at[at] = place + 1
            width[small] = width[small] << np.uint32(16)
        if lanes is None:
            self.ahead, self.range = ahead, width
        else:
            self.ahead[lanes], self.range[lanes] = ahead, width


def encode_ids(ids: np.ndarray, counts: np.ndarray | None = None) -> dict[str, bytes]:
    """Code one segment: id counts, word counts and CRC-32 per block, and the words.

    ``counts`` replaces the ids' own counts; a block's words depend on these and its ids alone."""
    ids = np.ascontiguousarray(ids, "<u4")
    if ids.size and ids.max() > 0xFFFF:
        raise ValueError("ids must be below 65,536")
    n = -(-len(ids) // BLOCK)
    if not n:
        return {"id_counts": b"", "block_words": b"", "block_crcs": b"", "words": b""}
    crcs = [zlib.crc32(ids[i * BLOCK:(i + 1) * BLOCK]) for i in range(n)]
    steps = min(BLOCK, len(ids))
    # The last block is padded with its last id; the reader knows the number of ids.
    grid = np.concatenate([ids, np.full(n * BLOCK - len(ids), ids[-1], "<u4")]).reshape(n, BLOCK)[:, :steps].T.copy()
    counts = np.bincount(ids).astype("<u4") if counts is None else counts
    model, order0, out = Lanes(n), Frequencies(counts), Writer(n)
    bits, bits0 = np.uint32(BITS), np.uint32(ORDER0_BITS)
    for now in grid:
        model.predict()
        right = model.guess == now
        hit2 = _mask(right[1])
        hit = hit2 | _mask(right[0])
        start, end = model.event(hit2, hit)
        out.code(None, start, end - start, bits)
        miss = ~hit
        start, share = _unpacked(order0.ranges.take(now))
        out.code(None, start, share, bits0, miss)
        if order0.escape:
            rare = np.flatnonzero((start < order0.escape) & (miss != 0))
            if rare.size:
                out.code(rare, *_unpacked(order0.ranges2.take(now.take(rare))), bits0)
        model.update(now, right, hit2, hit)
    lengths, words = out.finish()
    return {"id_counts": zlib.compress(counts.tobytes(), 6), "block_words": lengths.tobytes(),
            "block_crcs": np.array(crcs, "<u4").tobytes(), "words": words.tobytes()}


def decode_ids(n_ids: int, id_counts: bytes, block_words: bytes, block_crcs: bytes, words: bytes) -> np.ndarray:
    """The ids of one segment; ValueError when a block's checksum differs."""
    counts = np.frombuffer(block_words, "<u4")
    n = len(counts)
    if n != -(-n_ids // BLOCK) or len(words) != 2 * int(counts.sum(dtype="i8")) or len(block_crcs) != 4 * n:
        raise ValueError("the blocks do not fit the number of ids")
    if not n:
        return np.zeros(0, "<u4")
    try:
        seen = np.frombuffer(zlib.decompress(id_counts), "<u4")
    except (zlib.error, ValueError) as e:
        raise ValueError("the id counts cannot be read") from e
    if seen.sum(dtype="i8") != n_ids:
        raise ValueError("the id counts do not fit the number of ids")
    steps = min(BLOCK, n_ids)
    model, order0 = Lanes(n), Frequencies(seen)
    code = Reader(counts, np.frombuffer(words, "<u2"))
    bits, bits0 = np.uint32(BITS), np.uint32(ORDER0_BITS)
    grid = np.zeros((steps, n), "<u4")
    for now in grid:
        model.predict()
        v = code.target(None, bits)
        hit2, hit = _mask(v < model.upto2), _mask(v < model.upto1)
        start, end = model.event(hit2, hit)
        code.advance(None, start, end - start)
        miss = ~hit
        place = code.target(None, bits0)
        value = order0.ids.take(place)
        code.advance(None, *_unpacked(order0.ranges.take(value)), miss)
        now[:] = model.guess[0] ^ (model.guess[0] ^ model.guess[1]) & hit2
        now ^= (now ^ value) & miss
        if order0.escape:
            rare = np.flatnonzero((place < order0.escape) & (miss != 0))
            if rare.size:
                found = order0.ids2.take(code.target(rare, bits0))
                code.advance(rare, *_unpacked(order0.ranges2.take(found)))
                now[rare] = found
        model.update(now, model.guess == now, hit2, hit)
    ids = np.ascontiguousarray(grid.T).reshape(-1)[:n_ids].astype("<u4")
    for i, crc in enumerate(np.frombuffer(block_crcs, "<u4").tolist()):
        if zlib.crc32(ids[i * BLOCK:(i + 1) * BLOCK]) != crc:
            raise ValueError(f"checksum of block {i} differs")
    return ids


FILE_SCHEMA = ("part int, segment int, n_ids long, doc_ids array<long>, doc_tokens array<long>, "
               "id_counts binary, block_words binary, block_crcs binary, words binary")


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int = 2, segment: int = SEGMENT) -> None:
    """Encode every text, append ``end_id``, and write coded segments in ``doc_id`` order."""
    order = ["doc_id", F.xxhash64("text"), "text"]          # the hash parts rows without an id
    ordered = docs.select("doc_id", text_or_empty().alias("text")).repartitionByRange(*order[:2]).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, number = encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = int(end_id).to_bytes(4, "little")
        doc_ids: list = []
        lengths: list[int] = []
        packed: list[bytes] = []

        def texts() -> Iterator[str]:
            for b in batches:
                for lo in range(0, b.num_rows, 1024):
                    piece = b.slice(lo, 1024)
                    for d, t in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                        doc_ids.append(d)
                        yield t

        def coded() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(packed), "<u4")
            row = {"part": part, "segment": number, "n_ids": len(ids), "doc_ids": doc_ids[:len(lengths)],
                   "doc_tokens": lengths, **encode_ids(ids)}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([
                ("part", pa.int32()), ("segment", pa.int32()), ("n_ids", pa.int64()),
                ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
                ("id_counts", pa.binary()), ("block_words", pa.binary()), ("block_crcs", pa.binary()), ("words", pa.binary())]))

        held = 0
        for stretch, counts in enc.encode_stream(texts(), end):
            done = upto = 0
            for n in counts.tolist():
                lengths.append(n)
                held, upto = held + n, upto + n
                if held >= segment:
                    packed.append(stretch[4 * done:4 * upto])
                    yield coded()
                    del doc_ids[:len(lengths)]
                    lengths, packed, held, done, number = [], [], 0, upto, number + 1
            packed.append(stretch[4 * done:])
        if lengths:
            yield coded()

    ordered.mapInArrow(run, FILE_SCHEMA).write.option("compression", "none").parquet(path)


def read_ids(spark: SparkSession, path: str, keep_ids: bool = True) -> DataFrame:
    """Decode the files: per document its place (part, segment, ids before it in the
    segment), number of ids, their CRC-32 and, with ``keep_ids``, the ids."""
    schema = "part int, segment int, doc_id long, before long, n_tokens long, ids_crc32 long, token_ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(k)[i].as_py() for k, c in enumerate(b.schema.names)}
                data = decode_ids(row["n_ids"], row["id_counts"], row["block_words"], row["block_crcs"],
                                  row["words"]).tobytes()
                ends = 4 * np.cumsum([0, *row["doc_tokens"]], dtype="i8")
                parts = [data[a:z] for a, z in zip(ends[:-1].tolist(), ends[1:].tolist())]
                n = len(parts)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["part"]] * n, pa.int32()), pa.array([row["segment"]] * n, pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()), pa.array(ends[:-1] // 4, pa.int64()),
                    pa.array(row["doc_tokens"], pa.int64()), pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                    pa.array(parts if keep_ids else [None] * n, pa.binary()),
                ], ["part", "segment", "doc_id", "before", "n_tokens", "ids_crc32", "token_ids"])

    return spark.read.schema(FILE_SCHEMA).parquet(path).mapInArrow(run, schema)


def with_start(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Add ``start``: ids of all documents before, from the segments' sizes.

    A prefix sum per part over its segments, and one over a row per part.
    """
    segments = spark.read.schema(FILE_SCHEMA).parquet(path).select("part", "segment", "n_ids")
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("__n"))
    before = (Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("__n").over(Window.orderBy("part").rowsBetween(*before)),
                                            F.lit(0)).alias("__part"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(*before)
    offsets = segments.select("part", "segment", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("__segment"))
    offsets = offsets.join(parts, "part")
    return rows.join(offsets, ["part", "segment"]).withColumn(
        "start", (F.col("__part") + F.col("__segment") + F.col("before")).cast("long")).drop("__part", "__segment")


def written_and_read(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Write the coded files, read them back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    write_ids(docs, tokenizer, path)
    rows = read_ids(spark, path, keep_ids=False).drop("token_ids")
    return with_start(spark, path, rows).select("doc_id", "start", "n_tokens", "ids_crc32")
