"""Line dedup: range-partitioned line hashes, streamed first occurrences, keep bitmaps.

A line's key is the line stripped of white space at both ends with A-Z in lower
case.  A key of at least ``MIN_POINTS`` code points keeps its lines in the
smallest ``doc_id`` that holds it and loses them everywhere else; all other
lines stay.

1. Every line with a long enough key becomes a row of the two halves of the key's 128-bit
   hash, ``doc_id``, a hash of the text and the line's position: no text is shuffled.
2. These rows are range-partitioned by all their columns and sorted within the
   partitions (hashes first, then document and position).  The bounds come from a
   sample of the whole tuples, so a key that a third of all documents hold is
   spread over many partitions like any other stretch of rows.
3. Each partition is streamed once: the first document of a run of equal hashes
   keeps its lines, later ones lose theirs.  Only what a partition cannot know is
   left open: the lines of the first document of its *first* run, as that run may
   have begun before.  Every partition also states the first document of its last
   run; these claims - one row a partition - are broadcast and settle the open lines.
4. Dropped positions are grouped by document into a compressed bitmap of the lines
   to keep; the text meets its bitmap in one shuffle, where it is cut.

Two rows with the same ``doc_id`` and text share one bitmap; rows with the same
``doc_id`` count as one document, NULL as the last one.  NULL and empty texts are
one empty line, which is kept (a NULL text stays NULL).  Repeated lines inside the
keeping document stay.  Texts are never cut short: a long text is that many line
rows, and only its dropped positions meet again.  An empty table gives an empty
result.  Other columns are carried along by position, whatever they are called.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_128_digest

from tierlake.llm.common import ASCII_SPACES, text_or_empty
from tierlake.session import materialize

MIN_POINTS = 10
SLICE_ROWS = 256        # texts that are Python objects at a time
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DROPPED, OPEN, CLAIM = 0, 1, 2
LINE = ["h1", "h2", "doc_id", "text_key", "pos"]
LINE_SCHEMA = "h1 long, h2 long, doc_id long, text_key long, pos int"
FOUND_SCHEMA = "kind int, h1 long, h2 long, doc_id long, text_key long, pos int"
BITMAP_FIELDS = ["doc_id", "text_key", "n_lines", "n_dropped", "keep"]
BITMAP_SCHEMA = "doc_id long, text_key long, n_lines long, n_dropped long, keep binary"


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def line_rows(docs: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """h1, h2, doc_id, text_key, pos of every line whose key is long enough."""
    spaces = ASCII_SPACES.encode()
    lower = bytes.maketrans(UPPER.encode(), LOWER.encode())

    def long_enough(key: bytes) -> bool:
        # a code point has at most four bytes
        return len(key) >= 4 * min_points or len(key) >= min_points and len(key.decode()) >= min_points

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(k, SLICE_ROWS) for b in batches for k in range(0, b.num_rows, SLICE_ROWS)):
            digests, places, owners = [], [], []
            for row, text in enumerate(b.column(2)):
                for pos, line in enumerate(text.as_py().translate(lower).split(b"\n")):
                    key = line.strip(spaces)
                    if long_enough(key):
                        digests.append(xxh3_128_digest(key))
                        places.append(pos)
                        owners.append(row)
            hashes = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            rows = pa.array(owners, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(hashes[:, 0])), pa.array(np.ascontiguousarray(hashes[:, 1])),
                 b.column(0).take(rows), b.column(1).take(rows), pa.array(places, pa.int32())], LINE)

    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long"), text_key(text), text.cast("binary")).mapInArrow(run, LINE_SCHEMA)


class _Runs:
    """The runs of equal hashes of one partition, batch by batch."""

    def __init__(self):
        self.hashes = None          # of the run that the last batch ended in
        self.first = None           # its first document
        self.in_first_run = True    # that run is the partition's first one
        self.last = None            # the last row, to leave out repeats

    def split(self, b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Masks (dropped, open) over the rows of the next batch."""
        h1, h2 = (b.column(k).to_numpy() for k in (0, 1))
        null = np.asarray(b.column(2).is_null())
        doc = b.column(2).fill_null(0).to_numpy()
        rest = [b.column(k).to_numpy() for k in (3, 4)]
        begins = np.ones(len(h1), bool)
        begins[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        again = ~begins
        for c in (null, doc, *rest):
            again[1:] &= c[1:] == c[:-1]
        row = [(int(h1[k]), int(h2[k]), bool(null[k]), int(doc[k]), *(int(c[k]) for c in rest)) for k in (0, -1)]
        begins[0] = (h1[0], h2[0]) != self.hashes if self.hashes else True
        again[0] = row[0] == self.last
        run = np.cumsum(begins) - (1 if begins[0] else 0)
        starts = np.flatnonzero(begins)
        first_null, first_doc = null[starts], doc[starts]
        if not begins[0]:
            first_null = np.concatenate(([self.first[0]], first_null))
            first_doc = np.concatenate(([self.first[1]], first_doc))
        own = (null == first_null[run]) & (doc == first_doc[run])
        first_run = self.in_first_run & ((run == 0) if self.hashes is None or not begins[0] else np.zeros(len(run), bool))
        self.in_first_run = bool(first_run[-1])
        self.hashes, self.last = (row[1][0], row[1][1]), row[1]
        self.first = bool(first_null[-1]), int(first_doc[-1])
        return ~own & ~again, own & first_run & ~again


def first_occurrences(lines: DataFrame) -> DataFrame:
    """Dropped lines, open lines and claims (``FOUND_SCHEMA``) of the sorted line rows."""
    order = ["h1", "h2", F.asc_nulls_last("doc_id"), "text_key", "pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _Runs()
        for b in batches:
            if not b.num_rows:
                continue
            dropped, undecided = runs.split(b)
            for kind, mask in ((DROPPED, dropped), (OPEN, undecided)):
                rows = b.filter(pa.array(mask))
                if rows.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(rows.num_rows, kind, "int32")), *rows.columns], ["kind", *LINE])
        if runs.hashes:
            null, doc = runs.first
            values = [CLAIM, *runs.hashes, None if null else doc, None, None]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], ["kind", *LINE])

    placed = lines.select(*LINE).repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.mapInArrow(run, FOUND_SCHEMA)


def dropped_lines(docs: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """doc_id, text_key, pos of the lines that go."""
    found = materialize(first_occurrences(line_rows(docs, min_points)), "line-first-occurrences")
    # one claim a partition: as many rows as the shuffle has partitions
    owner = found.filter(F.col("kind") == CLAIM).groupBy("h1", "h2").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"))).alias("owner"))
    own = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"))
    late = found.filter(F.col("kind") == OPEN).join(F.broadcast(owner), ["h1", "h2"]).filter(own > F.col("owner"))
    sure = found.filter(F.col("kind") == DROPPED)
    return sure.select("doc_id", "text_key", "pos").unionByName(late.select("doc_id", "text_key", "pos"))


def pack(n_lines: int, dropped: np.ndarray) -> bytes:
    """zlib of the keep bits, first line in the lowest bit."""
    keep = np.ones(n_lines, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 1)


def unpack(n_lines: int, packed: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(packed), "u1"), count=n_lines, bitorder="little").astype(bool)


def keep_bitmaps(docs: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """doc_id, text_key, n_lines, n_dropped, keep: one row per distinct (doc_id, text)."""
    text = text_or_empty()
    every = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(text).alias("text_key"),
                        (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).alias("n_lines"), F.lit(None).cast("int").alias("pos"))
    gone = dropped_lines(docs, min_points).select("doc_id", "text_key", F.lit(None).cast("int").alias("n_lines"), "pos")
    grouped = every.unionByName(gone).groupBy("doc_id", "text_key").agg(
        F.max("n_lines").alias("n_lines"), F.collect_list("pos").alias("pos"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines = b.column(2).to_pylist()
            gone = [np.unique(np.asarray(p.values, "int64")) for p in b.column(3)]
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), b.column(2).cast(pa.int64()), pa.array([len(g) for g in gone], pa.int64()),
                pa.array([pack(n, g) for n, g in zip(lines, gone)], pa.binary())], BITMAP_FIELDS)

    return grouped.select("doc_id", "text_key", "n_lines", "pos").mapInArrow(run, BITMAP_SCHEMA)


def keep_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``docs`` with the kept lines as text, and n_lines and n_dropped added at the end
    (columns of these names are replaced)."""
    added = ["n_lines", "n_dropped"]
    kept = [k for k, c in enumerate(docs.columns) if c not in added]
    schema = T.StructType([docs.schema.fields[k] for k in kept] + [T.StructField(c, T.LongType()) for c in added])
    at = docs.columns.index("text")
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    ids, text = F.col(f"c{docs.columns.index('doc_id')}").cast("long"), F.coalesce(F.col(f"c{at}"), F.lit(""))
    # a document's bitmap is a small part of its text: the bitmaps are the build side
    joined = plain.join(bitmaps.hint("shuffle_hash"),
                        ids.eqNullSafe(F.col("doc_id")) & (text_key(text) == F.col("text_key")), "left")
    columns = [F.col(f"c{k}") for k in kept]

    def cut(text: str | None, n_lines: int, n_dropped: int, keep: bytes) -> str | None:
        if not n_dropped:
            return text
        lines = text.split("\n")
        return "\n".join([lines[k] for k in np.flatnonzero(unpack(n_lines, keep))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = kept.index(at)
        for b in (b.slice(k, SLICE_ROWS) for b in batches for k in range(0, b.num_rows, SLICE_ROWS)):
            *columns, lines, dropped, keep = b.columns
            columns[place] = pa.array(list(map(cut, columns[place].to_pylist(), lines.to_pylist(), dropped.to_pylist(),
                                               keep.to_pylist())), pa.string())
            yield pa.RecordBatch.from_arrays([*columns, lines, dropped], [f"o{k}" for k in range(len(schema.fields))])

    return joined.select(*columns, "n_lines", "n_dropped", "keep").mapInArrow(run, schema)


def drop_repeated_lines(docs: DataFrame, min_points: int = MIN_POINTS) -> DataFrame:
    """The documents without the lines that an earlier document holds."""
    return keep_lines(docs, keep_bitmaps(docs, min_points))
