"""Alignment against a plain version that encodes whole texts with the two libraries."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierlake.llm import alignment as al
from tierlake.llm.queries import tokenizer_path

ODD = ["", " ", "a", "  two  spaces ", "\n", "\n\nline\n next\n", "tab\there \r\n\r\n x", "<|endoftext|> <0x0A> <s></s> <unk>",
       "mark ▁ inside", "nul\x00 and \x1c\x1d sep", "日本語のテキスト 한국어 🙂🙂👩‍👩‍👧", "it's we'll 12345,678", "᠎ x​ y﻿ z",
       "x" * 3000, "ab" * 500 + " \n" * 40, "é é \xa0nbsp 　wide sep", " lead", "trail ", "a\n b \nc\n\n d", "{ \r}\r\n;"]


@pytest.fixture(scope="module")
def both():
    return al.Aligner(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def plain(both, text):
    """ids of A and B and the groups of a text, whole, or None."""
    text = text or ""
    if not text:
        return None
    ids_a = both.a.encode(" " + text, add_special_tokens=False).ids
    ids_b = both.b.encode(text)
    own = (" " + text).encode()
    a, b = [both.bytes_a[i] for i in ids_a], [both.bytes_b[i] for i in ids_b]
    if b"".join(a) != own or b"".join(b) != own:
        return None
    groups, i, j, at, bt = [([], [])], 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if at <= bt:
            groups[-1][0].append(ids_a[i])
            at += len(a[i])
            i += 1
        else:
            groups[-1][1].append(ids_b[j])
            bt += len(b[j])
            j += 1
        if at == bt and (i < len(a) or j < len(b)):
            groups.append(([], []))
    return ids_a, ids_b, groups


def brute(both, rows):
    found = [(d, plain(both, t)) for d, t in rows]
    counts = Counter()
    for _, p in found:
        if p:
            counts.update({(x, y) for a, b in p[2] for x in a for y in b})
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    out = []
    for d, p in found:
        if not p:
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(x, y) for a, b in p[2] for x in a for y in b]
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in p[2])
        out.append((d, len(p[0]), len(p[1]), len(p[2]), len(links), sum(counts[x] == highest[x[0]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(written.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_token_bytes_and_cuts(both):
    assert both.cuts
    assert both.bytes_a[220] == b" " and b"\n" in both.bytes_a and b"\n" in both.bytes_b
    for text in ("plain words here", "日本 🙂"):
        assert b"".join(both.bytes_a[i] for i in both.a.encode(text, add_special_tokens=False).ids).decode() == text


def agrees(both, texts):
    for t, r in zip(texts, both.align_batch(texts)):
        p = plain(both, t)
        if p is None:
            assert r is None, t[:60]
            continue
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in p[2])
        links = Counter(x * both.size_b + y for a, b in p[2] for x in a for y in b)
        assert r[:4] == (len(p[0]), len(p[1]), len(p[2]), sum(links.values())), t[:60]
        assert r[4] == hashlib.sha256(written.encode()).hexdigest(), t[:60]
        assert dict(zip(r[5].tolist(), r[6].tolist())) == links


def test_odd_texts_and_documents(both, small_docs, monkeypatch):
    texts = ODD + [r.text for r in small_docs.select("text").collect()]
    agrees(both, texts)
    monkeypatch.setattr(al, "GROUP_CHARS", 3000)
    agrees(al.Aligner(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"), 40), texts[:80])


ENCODERS = {}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\r\t▁a'bA1.é日\x00"), st.characters(codec="utf-8")), max_size=40))
def test_any_text(text):
    if not ENCODERS:
        ENCODERS["x"] = al.Aligner(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    agrees(ENCODERS["x"], [text])


@pytest.mark.parametrize("head", [0, 50, al.HEAD_PAIRS])
def test_counts_whatever_is_broadcast(spark, both, head):
    rng = random.Random(4)
    words = ["the", "quick", "naïve", "日本語", "x1", "a\nb", "🙂", "  gap", "Tokens", "it's"]
    rows = [(rng.randrange(60), " ".join(rng.choice(words) for _ in range(rng.randrange(30)))) for _ in range(150)]
    rows += [(k, t) for k, t in enumerate(ODD)] + [(None, None), (None, "the quick"), (5, None)] + [(7, "the the the")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    out = al.align_documents(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"), head)
    assert got(out) == brute(both, rows)


def test_edge_rows(spark, both, edge_docs):
    out = al.align_documents(edge_docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    assert got(out) == brute(both, [(r.doc_id, r.text) for r in edge_docs.collect()])


def test_large_groups_count_distinct_pairs(both, monkeypatch):
    texts = ["日本語🙂" * 30 + " and words", "🙂🙂👩‍👩‍👧 x", "plain words only"]
    agrees(both, texts)
    monkeypatch.setattr(al, "LARGE_GROUP", 1)
    agrees(al.Aligner(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")), texts + ODD)
