"""Exact round trips, checksums, and the order of the files."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tierlake.llm import range_coder as rc
from tierlake.llm.bpe import TrieEncoder
from tierlake.llm.common import text_or_empty


def round_trip(ids):
    ids = np.asarray(ids, "<u4")
    assert (rc.decode_ids(len(ids), **rc.encode_ids(ids)) == ids).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 65535), st.integers(0, 3)), max_size=400))
def test_any_ids(ids):
    round_trip(ids)


def test_lengths_around_blocks_and_extremes():
    rng = np.random.default_rng(2)
    for n in (0, 1, rc.BLOCK - 1, rc.BLOCK, rc.BLOCK + 1, 5 * rc.BLOCK + 3):
        round_trip(rng.integers(0, 65536, n))
        round_trip(np.minimum(rng.zipf(1.3, n), 65535))
    round_trip(np.zeros(9000))
    round_trip(np.full(9000, 65535))
    round_trip(np.tile([7, 8, 9, 65535, 0], 3000))
    with pytest.raises(ValueError):
        rc.encode_ids(np.array([65536]))


def test_prediction_pays():
    repeated = rc.encode_ids(np.tile(np.arange(300, 360), 200))
    even = rc.encode_ids(np.random.default_rng(1).integers(0, 49408, 12000))
    assert len(repeated["words"]) * 8 / 12000 < 2 and len(even["words"]) * 8 / 12000 < 16.8


def test_blocks_are_independent_and_checked():
    ids = np.random.default_rng(4).integers(0, 500, 3 * rc.BLOCK).astype("<u4")
    coded = rc.encode_ids(ids)
    alone = rc.encode_ids(ids[rc.BLOCK:2 * rc.BLOCK], np.bincount(ids))
    counts = np.frombuffer(coded["block_words"], "<u4")
    words = np.frombuffer(coded["words"], "<u2")
    assert (words[counts[0]:counts[0] + counts[1]] == np.frombuffer(alone["words"], "<u2")).all()
    spoiled = bytearray(coded["words"])
    spoiled[len(spoiled) // 2] ^= 1
    with pytest.raises(ValueError):
        rc.decode_ids(len(ids), **{**coded, "words": bytes(spoiled)})
    for bad in (b"", b"no zlib", rc.encode_ids(ids[1:])["id_counts"]):
        with pytest.raises(ValueError):
            rc.decode_ids(len(ids), **{**coded, "id_counts": bad})


def test_bits_per_id_on_documents(small_docs, tokenizer):
    """Order 0 knows the ids' frequencies: well below the entropy of even ids, header included."""
    enc = TrieEncoder(tokenizer)
    packed = enc.encode_batch([r.text for r in small_docs.select("text").collect()])
    ids = np.concatenate([np.frombuffer(p, "<u4") for p in packed])
    coded = rc.encode_ids(ids)
    assert (rc.decode_ids(len(ids), **coded) == ids).all()
    assert 8 * sum(map(len, coded.values())) / len(ids) < 10


def test_files_in_document_order(spark, tmp, edge_docs, tokenizer):
    rc.write_ids(edge_docs, tokenizer, tmp, segment=5000)
    assert spark.read.parquet(tmp).count() > 3
    got = rc.with_start(spark, tmp, rc.read_ids(spark, tmp)).orderBy("start").collect()
    enc, start = TrieEncoder(tokenizer), 0
    ordered = edge_docs.select("doc_id", text_or_empty().alias("text")).orderBy("doc_id", F.xxhash64("text"), "text")
    rows = [(r.doc_id, r.text) for r in ordered.collect()]
    assert len(got) == len(rows)
    for g, (d, t) in zip(got, rows):
        ids = enc.encode_batch([t])[0] + (2).to_bytes(4, "little")
        assert (g.doc_id, g.start, g.n_tokens, g.ids_crc32, bytes(g.token_ids)) == (d, start, len(ids) // 4, zlib.crc32(ids), ids)
        start += len(ids) // 4


def test_coded_bytes_stay_the_same():
    """The file format: words of ids inside and beyond the head of order 0."""
    x = np.arange(50_000, dtype="u8")
    ids = ((x * x * 2654435761 >> 7) % (x % 977 + 3) * (x % 5 + 1) % 60_000).astype("<u4")
    ids = np.concatenate([ids, np.arange(40_000, dtype="<u4")])
    coded = rc.encode_ids(ids)
    assert (len(coded["words"]), zlib.crc32(coded["words"])) == (152644, 1195593177)
    assert (rc.decode_ids(len(ids), **coded) == ids).all()


def test_order0_ranges_are_packed_by_id():
    """One lookup gives an id's start and width, and the escape's for the tail."""
    counts = np.ones(rc.HEAD + 5, "u4")
    counts[:rc.HEAD] = 3
    order0 = rc.Frequencies(counts)
    start, share = rc._unpacked(order0.ranges)
    assert (start[rc.HEAD:] == 0).all() and (share[rc.HEAD:] == order0.escape).all()
    assert start[0] == order0.escape and int(share[:rc.HEAD].sum()) + int(order0.escape) == 1 << rc.ORDER0_BITS
    start, share = rc._unpacked(order0.ranges2[rc.HEAD:])
    assert share.sum() == 1 << rc.ORDER0_BITS and (order0.ids2[start] == np.arange(rc.HEAD, rc.HEAD + 5)).all()
    alone = rc.Frequencies(np.array([0, 7], "u4"))
    assert alone.escape == 0 and [int(v[1]) for v in rc._unpacked(alone.ranges)] == [0, 1 << rc.ORDER0_BITS]
