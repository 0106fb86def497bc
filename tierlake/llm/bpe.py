"""BPE encoding and decoding with a prefix-sharing trie.

The last token of a BPE encoding is a function of the prefix alone: the last
token of a prefix is the one vocabulary token t that ends there and is
*compatible* with the last token of the prefix before t, that is, no merge would
have joined pieces across their boundary.  So the distinct words of a group of
texts go into a trie, a depth-first walk gives every node the last token of its
prefix from the states on the path above it, and a prefix that many words share
is worked out once.  A word's ids are read off backwards from its last node.
The trie is held as the sorted words and the length each shares with the word
before it: going through them in order is the depth-first walk, and the states
of the shared prefix are the path that stays on the stack.

A word's final symbol carries the end-of-word mark of the vocabulary, as a
symbol of its own, so a trie edge is one (marked) byte symbol.

Texts of ASCII and composed Latin-1 letters without special tokens need no
normalisation but lower case, and are cut into words by the same pattern in
``re``.  Other texts are cut at ASCII white space into chunks - no token, no
normalisation step and no pre-token of this family of tokenizers crosses such a
boundary - and each distinct chunk goes through the tokenizer file's own
normaliser and pre-tokenizer.  Results are kept in per-worker caches of two
generations of a fixed number of entries: a full young generation becomes the
old one, which costs time for rare words and never changes a result.  A worker
outlives its stage and keeps them, so they are sized for the memory that the
stages after it need: those of Python objects take a fraction of the entries
that Arrow arrays do.

Encoding is a map: no shuffle, memory bounded by the caches and by ``SLICE_ROWS``
rows and ``GROUP_CHARS`` characters of text at a time plus the longest text.  NULL text counts as empty
(no ids).  Repeated rows repeat their ids, an empty table gives an empty result,
other columns are carried along untouched; an existing column of the output's
name is replaced.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tierlake.llm.common import map_batches, slices

END = 0x1000            # added to a symbol's code point when it ends a word
NEVER = 1 << 60
GROUP_CHARS = 2_000_000
STREAM_CHARS = 16_000_000
CACHE_ENTRIES = 500_000
OBJECTS = 4             # a cache of Python objects has this fraction of the entries

# --- fixed values: the pre-token pattern of the supported tokenizer files ----------
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The same for lower-cased plain text: ASCII and the composed letters of Latin-1.
PLAIN_PATTERN = r"[a-z\xdf-\xf6\xf8-\xff]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^ \t\n\r\x0b\x0ca-z\xdf-\xf6\xf8-\xff0-9]+"
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PLAIN_TEXT = r"[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]*"
# --- end fixed values ---------------------------------------------------------------


def byte_symbols() -> dict[int, str]:
    """The printable stand-in of every byte: itself, or the next free code point from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Cache(dict):
    """A dictionary of at most ``2 * most`` entries: the young ones are the dictionary,
    entries found among the old ones are young again."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.old = most, {}

    def unknown(self, keys: set) -> set:
        """The keys in neither generation; makes room first."""
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()
        missing = keys.difference(self)
        if self.old and missing:
            known = missing.intersection(self.old)
            self.update((k, self.old[k]) for k in known)
            missing -= known
        return missing


class Memo:
    """Values of strings as two Arrow arrays; one that holds more than ``most`` entries is cut
    down to those just asked for."""

    def __init__(self, most: int):
        self.most = most
        self.keys, self.values = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def values_of(self, keys: pa.Array, resolve) -> pa.Array:
        """The values of distinct keys; ``resolve`` gives those of the unknown ones."""
        at = pc.index_in(keys, value_set=self.keys)
        if at.null_count:
            new = keys.filter(at.is_null())
            numbers = pc.replace_with_mask(at, at.is_null(), pa.array(np.arange(len(new), dtype="i4") + len(self.keys)))
            self.keys, self.values, at = pa.concat_arrays([self.keys, new]), \
                pa.concat_arrays([self.values, resolve(new)]), numbers
        found = self.values.take(at)
        if len(self.keys) > self.most:
            self.keys, self.values = keys, found
        return found


class TrieEncoder:
    """Encoder and decoder of one tokenizer file (a path that every worker can open)."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self._check(spec)
        self.library = Tokenizer.from_file(path)
        self.suffix = model.get("end_of_word_suffix") or ""
        self.objects = max(1, cache_entries // OBJECTS)
        self.chunks, self.words = Cache(self.objects), Cache(self.objects)
        self.known_chunks, self.known_words = Memo(cache_entries), Memo(cache_entries)
        self.pairs: dict[int, bool] = {}
        self.steps: dict[str, tuple[str, tuple]] = {}
        self._load(model)
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.special_re = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None
        texts = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        self.texts = [texts.get(i, "").encode() for i in range(max(texts) + 1)]
        self.packed = [i.to_bytes(4, "little") for i in range(max(texts) + 1)]
        self.special_start = os.path.commonprefix(list(self.special))
        split = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        known = split == [WORD_PATTERN] and spec["normalizer"] == NORMALIZER
        self.plain_words = re.compile(PLAIN_PATTERN).findall if known else None
        self.plain_text = re.compile(PLAIN_TEXT).fullmatch
        self.symbols = byte_symbols()

    @staticmethod
    def _check(spec: dict) -> None:
        kinds = [p["type"] for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        plain = all(not (a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"]) for a in spec["added_tokens"])
        model = spec["model"]
        if model["type"] != "BPE" or kinds != ["Split", "ByteLevel"] or not plain or spec.get("decoder") or \
                model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("dropout"):
            raise ValueError("a byte-level word BPE file with unconditional added tokens and no decoder is needed")

    def _load(self, model: dict) -> None:
        vocab = model["vocab"]
        self.rank, self.left, self.right, self.merge = {}, {}, {}, {}
        piece = {}
        for c in byte_symbols().values():
            piece[vocab[c]] = c
            if self.suffix:
                piece[vocab[c + self.suffix]] = chr(ord(c) + END)
        self.ids = {p: i for i, p in piece.items()}
        self.length = {i: 1 for i in piece}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            t, a, b = vocab[a + b], vocab[a], vocab[b]
            self.merge[a << 20 | b] = rank
            if t in self.rank or a not in piece or b not in piece:
                continue
            piece[t] = piece[a] + piece[b]
            self.rank[t], self.left[t], self.right[t] = rank, a, b
            self.length[t] = len(piece[t])
            # A token that its own string does not encode to never occurs.
            if self._crossing(a, b) == rank and piece[a] in self.ids and piece[b] in self.ids:
                self.ids[piece[t]] = t
        self.begins = {p[:k] for p in self.ids for k in range(len(p) + 1)}

    def _crossing(self, a: int, b: int) -> int | None:
        """The rank of the first merge across the boundary of tokens a and b.

        Pieces x at a's right edge and y at b's left edge meet while neither has
        been merged further; of equal merges the left one goes first.
        """
        found = None
        x, x_until = a, NEVER
        while True:
            y, y_until = b, NEVER
            while True:
                m = self.merge.get(x << 20 | y)
                if m is not None and m < x_until and m <= y_until and (found is None or m < found):
                    found = m
                if y not in self.rank:
                    break
                y_until, y = self.rank[y], self.left[y]
            if x not in self.rank:
                return found
            x_until, x = self.rank[x], self.right[x]

    def _compatible(self, key: int) -> bool:
        if len(self.pairs) >= 2 * self.objects:
            self.pairs.clear()
        ok = self.pairs[key] = self._crossing(key >> 20, key & 0xFFFFF) is None
        return ok

    def _step(self, state: str, symbol: str) -> tuple[str, tuple]:
        """Follow the vocabulary's automaton: the longest end of state + symbol that
        begins a token, and the tokens that end there, longest first."""
        text = state + symbol
        s = text
        while s not in self.begins:
            s = s[1:]
        ends = tuple((self.ids[s[k:]], len(s) - k) for k in range(len(s)) if s[k:] in self.ids)
        if len(self.steps) >= self.objects:
            self.steps.clear()
        self.steps[text] = found = (s, ends)
        return found

    def _encode_words(self, words: Iterable[str]) -> dict[str, bytes]:
        """Walk the trie of the words depth first: packed ids of each."""
        found: dict[str, bytes] = {}
        pairs, steps, packed = self.pairs, self.steps, self.packed
        last, size, states = [0], [0], [""]     # per depth: last token, its length, automaton state
        before = ""
        for w in sorted(words):
            shared, most = 0, min(len(w), len(before))
            while shared < most and w[shared] == before[shared]:
                shared += 1
            del last[shared + 1:], size[shared + 1:], states[shared + 1:]
            state = states[shared]
            for depth in range(shared + 1, len(w) + 1):
                symbol = w[depth - 1]
                state, ends = steps.get(state + symbol) or self._step(state, symbol)
                for t, k in ends:
                    if k == depth:
                        break
                    key = last[depth - k] << 20 | t
                    ok = pairs.get(key)
                    if self._compatible(key) if ok is None else ok:
                        break
                last.append(t)
                size.append(k)
                states.append(state)
            out, d = [], len(w)
            while d:
                out.append(packed[last[d]])
                d -= size[d]
            out.reverse()
            found[w] = b"".join(out)
            before = w
        return found

    def _marked(self, piece: str) -> str:
        """A pre-token in byte symbols as the trie spells it: the last symbol marked."""
        return piece[:-1] + chr(ord(piece[-1]) + END) if self.suffix else piece

    def _in_symbols(self, word: str) -> str:
        """A plain word in byte symbols."""
        if word.isascii() and word.isprintable():
            return word
        return "".join(map(self.symbols.__getitem__, word.encode()))

    def _spelled(self, word: str) -> str:
        """A plain word in byte symbols, the last one marked."""
        return self._marked(self._in_symbols(word))

    def _encode_plain(self, words: set[str]) -> None:
        spelled = {w: self._spelled(w) for w in words}
        found = self._encode_words(spelled.values())
        self.words.update((w, found[x]) for w, x in spelled.items())

    def _encode_chunks(self, chunks: set[bytes]) -> None:
        """Chunks of texts that are not plain, through the library's own steps."""
        parts: dict[bytes, list] = {}
        for c in chunks:
            out = parts[c] = []
            text = c.decode()
            for stretch in self.special_re.split(text) if self.special and self.special_start in text else [text]:
                if stretch in self.special:
                    out.append(self.special[stretch])
                elif stretch:
                    normal = self.library.normalizer.normalize_str(stretch) if self.library.normalizer else stretch
                    out += [self._marked(p) for p, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        found = self._encode_words({p for out in parts.values() for p in out if isinstance(p, str)})
        for c, out in parts.items():
            self.chunks[c] = b"".join([found[p] if isinstance(p, str) else self.packed[p] for p in out])

    def encode_batch(self, texts: Iterable[str | bytes | None]) -> list[bytes]:
        """Ids of each text (UTF-8 bytes or str) as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        group: list[tuple[bool, list]] = []
        size = 0

        def flush() -> None:
            nonlocal group, size
            new = self.words.unknown(set().union(*[w for plain, w in group if plain]))
            if new:
                self._encode_plain(new)
            new = self.chunks.unknown(set().union(*[w for plain, w in group if not plain]))
            if new:
                self._encode_chunks(new)
            words, chunks = self.words.__getitem__, self.chunks.__getitem__
            out.extend([b"".join(map(words if plain else chunks, w)) for plain, w in group])
            group, size = [], 0

        for t in texts:
            text = (t.decode() if isinstance(t, bytes) else t) or ""
            if self.plain_words and self.plain_text(text) and not (self.special and self.special_start in text):
                group.append((True, self.plain_words(text.lower())))
            else:
                group.append((False, text.encode().split()))
            size += len(text)
            if size >= GROUP_CHARS:
                flush()
        flush()
        return out

    def _resolve(self, chunks: list[bytes]) -> pa.Array:
        """Ids of unknown chunks: plain ones word by word, others through the library's own steps."""
        texts = pa.array(chunks, pa.large_binary()).cast(pa.large_string())
        plain = np.full(len(chunks), bool(self.plain_words))
        if self.plain_words:
            plain &= pc.match_substring_regex(texts, f"^{PLAIN_TEXT}$").to_numpy(zero_copy_only=False)
        if self.special:
            plain &= ~pc.match_substring(texts, self.special_start).to_numpy(zero_copy_only=False)
        if plain.all():
            return self._plain_chunks(texts)
        rest = [chunks[i] for i in np.flatnonzero(~plain).tolist()]
        new = self.chunks.unknown(set(rest))
        if new:
            self._encode_chunks(new)
        values = pa.concat_arrays([self._plain_chunks(texts.filter(pa.array(plain))),
                                   pa.array(map(self.chunks.__getitem__, rest), pa.large_binary())])
        return values.take(pa.array(np.argsort(np.argsort(~plain, kind="stable"))))

    def _plain_chunks(self, texts: pa.Array) -> pa.Array:
        """Ids of plain chunks, cut into words by the same pattern in Arrow; each distinct word is encoded once."""
        spaced = pc.replace_substring_regex(pc.utf8_lower(texts), f"({PLAIN_PATTERN})", r"\1 ")
        cut = pc.ascii_split_whitespace(spaced)
        numbered = cut.values.dictionary_encode()
        _, ends, packed = self.known_words.values_of(numbered.dictionary, self._resolve_words).take(numbered.indices).buffers()
        ends = np.frombuffer(ends, "<i8")[cut.offsets.to_numpy()]
        return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(ends), packed])

    def _resolve_words(self, words: pa.Array) -> pa.Array:
        """Ids of unknown plain words from the library's model."""
        tokenize, packed = self.library.model.tokenize, self.packed
        return pa.array([b"".join([packed[t.id] for t in tokenize(self._in_symbols(w))]) for w in words.to_pylist()],
                        pa.large_binary())

    def encode_stream(self, texts: Iterable[str | None], end: bytes) -> Iterator[tuple[bytes, np.ndarray]]:
        """Ids of all texts, each followed by ``end``, in stretches: (packed ids, ids per text, ``end`` included).

        No token crosses ASCII white space, so the texts are cut there; the distinct chunks of about
        ``STREAM_CHARS`` characters are numbered, encoded once each and put in place by number.
        """
        group: list[str] = []
        size = 0
        for t in texts:
            t = t or ""
            lower = self.plain_words and (t.isascii() or self.plain_text(t)) and \
                not (self.special and self.special_start in t)
            group.append(t.lower() if lower else t)
            size += len(t)
            if size >= STREAM_CHARS:
                yield self._placed(group, end)
                group, size = [], 0
        if group:
            yield self._placed(group, end)

    def _placed(self, texts: list[str], end: bytes) -> tuple[bytes, np.ndarray]:
        cut = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        numbered = cut.values.dictionary_encode()
        values = self.known_chunks.values_of(numbered.dictionary, lambda new: self._resolve(_byte_list(new)))
        values = pa.concat_arrays([values, pa.array([end], pa.large_binary())])
        last = cut.offsets.to_numpy()[1:]
        places = np.insert(numbered.indices.to_numpy(), last, len(values) - 1)
        _, ends, packed = values.take(pa.array(places)).buffers()
        ends = np.frombuffer(ends, "<i8")[last + np.arange(1, len(texts) + 1)]
        return packed.to_pybytes()[:ends[-1]], np.diff(ends, prepend=0) // 4

    def decode(self, packed: bytes) -> bytes:
        """UTF-8 of the decoded text: without a decoder in the file, the tokens space-joined."""
        return b" ".join(map(self.texts.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def _byte_list(strings: pa.Array) -> list[bytes]:
    """UTF-8 of every string of a large_string array without NULLs."""
    _, ends, data = strings.buffers()
    ends, data = np.frombuffer(ends, "<i8")[:len(strings) + 1].tolist(), data.to_pybytes() if data else b""
    return [data[a:z] for a, z in zip(ends, ends[1:])]


@lru_cache(maxsize=2)
def encoder(path: str) -> TrieEncoder:
    return TrieEncoder(path)


def _with_column(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != name] + [T.StructField(name, kind)])


def _append(batch: pa.RecordBatch, kept: list[int], values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], values],
                                      [f"c{k}" for k in range(len(kept) + 1)])


def encode_documents(docs: DataFrame, path: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """Add ``out`` (array<int>): the ids of the whole text."""
    schema = _with_column(docs.schema, out, T.ArrayType(T.IntegerType(), False))
    at, kept = docs.columns.index(text), [k for k, c in enumerate(docs.columns) if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in slices(batches):
            packed = enc.encode_batch(b.column(at).to_pylist())
            ends = np.cumsum([0, *[len(p) // 4 for p in packed]], dtype="int32")
            ids = np.frombuffer(b"".join(packed), "<i4")
            yield _append(b, kept, pa.ListArray.from_arrays(pa.array(ends), pa.array(ids, pa.int32())))

    return map_batches(docs, run, schema)


def decode_documents(docs: DataFrame, path: str, ids: str = "token_ids", out: str = "decoded_text") -> DataFrame:
    """Add ``out`` (string): the decoded text of an id array (NULL array: empty)."""
    schema = _with_column(docs.schema, out, T.StringType())
    at, kept = docs.columns.index(ids), [k for k, c in enumerate(docs.columns) if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in slices(batches):
            lists = b.column(at)
            texts = [enc.decode(np.asarray(x.values, "<u4").tobytes() if x.is_valid else b"").decode() for x in lists]
            yield _append(b, kept, pa.array(texts, pa.string()))

    return map_batches(docs, run, schema)


ROUND_TRIP_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every text; digests of the ids and of the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in slices(batches):
            packed = enc.encode_batch(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([
                b.column(0).cast(pa.int64()),
                pa.array([len(p) // 4 for p in packed], pa.int64()),
                pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                pa.array([hashlib.sha256(enc.decode(p)).hexdigest() for p in packed], pa.string()),
            ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, ROUND_TRIP_SCHEMA)
