"""Trie encoding equals the tokenizers library on every text."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tierlake.llm import bpe

ODD = ["", "  ", "<|endoftext|>x <|startoftext|><|endoftext|>", "It's we'll I'VE'd 'south ''ll", "½ ² 12345 ٣٤",
       "naïve é é Ǆ ß İ ΑΣ ΣΑΣ. ſ K", "a b c\x1cd\x85e", "日本語テキスト 한국어 🙂🙂", "\x00\x01 \x7f ~~~", "</w> <|endof text|>",
       "x" * 5000, "aaaaaaaaa banana " * 20, "́abc a ̧́", "a\tb\nc\x0bd\x0ce\rf"]


@pytest.fixture(scope="module")
def library(tokenizer):
    return Tokenizer.from_file(tokenizer)


def agrees(enc, library, texts):
    for text, packed in zip(texts, enc.encode_batch(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packed, "<u4").tolist() == want, text[:80]
        assert enc.decode(packed).decode() == library.decode(want, skip_special_tokens=False)


def test_odd_texts_and_documents(tokenizer, library, small_docs):
    texts = ODD + [r.text for r in small_docs.select("text").collect()]
    agrees(bpe.TrieEncoder(tokenizer), library, texts)
    agrees(bpe.TrieEncoder(tokenizer, cache_entries=50), library, texts[:60])     # caches emptied all the time


ENCODERS = {}


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    from tierlake.llm.queries import tokenizer_path
    if not ENCODERS:
        ENCODERS["pair"] = bpe.TrieEncoder(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    agrees(*ENCODERS["pair"], [text])


def test_shared_prefixes_are_walked_once(tokenizer):
    enc, steps = bpe.TrieEncoder(tokenizer), []
    walk = enc._step
    enc._step = lambda *a: steps.append(a) or walk(*a)
    enc.encode_batch(["interest interested interesting interests"])
    assert len(steps) <= len("interest") + 4 * 5


def test_spark_columns_and_digests(tokenizer, library, edge_docs):
    ids = bpe.encode_documents(edge_docs, tokenizer)
    assert ids.columns == [*edge_docs.columns, "token_ids"]
    back = bpe.decode_documents(ids.drop("kept").withColumnRenamed("token_ids", "kept"), tokenizer, ids="kept", out="word")
    for r in back.collect():
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.kept == want and r.word == library.decode(want, skip_special_tokens=False)
    for r, t in zip(sorted(bpe.round_trip(edge_docs.filter("doc_id > 6"), tokenizer).collect()),
                    sorted((r.doc_id, r.text) for r in edge_docs.filter("doc_id > 6").collect())):
        want = np.array(library.encode(t[1], add_special_tokens=False).ids, "<u4")
        assert (r.doc_id, r.n_tokens, r.ids_sha256) == (t[0], len(want), hashlib.sha256(want.tobytes()).hexdigest())


def test_other_tokenizer_kinds_are_refused():
    import public_tokenizers
    with pytest.raises(ValueError):
        bpe.TrieEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_streams_equal_the_library_text_by_text(tokenizer, library, small_docs, monkeypatch):
    """Stretches of any size, caches emptied all the time, the end id after every text."""
    texts = [*ODD, None, "X\r\ny\x1cZ\x1f\x85\xa0w", "Ünï <|ENDOFTEXT|> <|", *[r.text for r in small_docs.select("text").collect()]]
    for entries, stretch in ((bpe.CACHE_ENTRIES, bpe.STREAM_CHARS), (20, 3000)):
        monkeypatch.setattr(bpe, "STREAM_CHARS", stretch)
        got = list(bpe.TrieEncoder(tokenizer, cache_entries=entries).encode_stream(iter(texts), b"\x02\0\0\0"))
        want = [library.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
        assert np.concatenate([n for _, n in got]).tolist() == list(map(len, want))
        assert np.frombuffer(b"".join(p for p, _ in got), "<u4").tolist() == sum(want, [])
    assert not list(bpe.TrieEncoder(tokenizer).encode_stream([], b"\x02\0\0\0"))


def test_a_stream_encodes_each_distinct_chunk_once(tokenizer):
    enc, asked = bpe.TrieEncoder(tokenizer), []
    resolve = enc._resolve
    enc._resolve = lambda chunks: asked.extend(chunks) or resolve(chunks)
    list(enc.encode_stream(["some words, some\nwords", "SOME words,"] * 50, b"\x02\0\0\0"))
    assert sorted(c for c in asked if c) == [b"some", b"words", b"words,"]


def test_a_stream_asks_the_model_once_for_each_distinct_word(tokenizer, monkeypatch):
    """Chunks that differ in punctuation share their words; a full memo keeps the stretch at hand."""
    texts = ["Some words, some. (words) été", "words; SOME! été? don't", "don't <|endoftext|> some日本"] * 20
    monkeypatch.setattr(bpe, "STREAM_CHARS", 100)
    enc, asked = bpe.TrieEncoder(tokenizer), []
    resolve = enc._resolve_words
    enc._resolve_words = lambda words: asked.extend(words.to_pylist()) or resolve(words)
    want = list(enc.encode_stream(texts, b"\x02\0\0\0"))
    assert sorted(w for w in asked if w) == ["!", "'t", "(", ")", ",", ".", ";", "?", "don", "some", "words", "été"]
    small = bpe.TrieEncoder(tokenizer, cache_entries=3)
    assert [p for p, _ in small.encode_stream(texts, b"\x02\0\0\0")] == [p for p, _ in want]
    list(small.encode_stream(["other"], b"\x02\0\0\0"))
    assert set(small.known_words.keys.to_pylist()) - {""} == {"other"}


def test_caches_of_objects_stay_small(tokenizer, library):
    """Words, pairs and automaton steps that a worker keeps are bounded by its entries, whatever the texts."""
    enc = bpe.TrieEncoder(tokenizer, cache_entries=4000)
    rng = np.random.default_rng(2)
    words = ["".join(w) for w in rng.choice(list("abcdefghijklmnopqrstuvwxyz-#1"), (30_000, 7))]
    for at in range(0, len(words), 500):
        text = " ".join(words[at:at + 500])
        packed = enc.encode_batch([text])[0]
    assert len(enc.words) + len(enc.words.old) <= 4000
    assert len(enc.pairs) <= 4000 and len(enc.steps) <= 4000
    assert np.frombuffer(packed, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
