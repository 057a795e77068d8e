"""Byte-level BPE by a tokenization automaton.

The merges are compiled, in order, into an automaton over tokens. Its states are the tokens read last (and a start
state), and an arc (state, token) exists if the two may stand side by side in an encoded word. Each merge applies one
gadget: the arc that spells the merged pair is taken away, and the new token gets arcs wherever the pair could be read
and a state with the arcs of its right half. Every prefix of a word is read in exactly one state, so the automaton is determinised
over bytes: a byte state holds, for every token that may be open, the token before it and its place in the tree of labels, and names the token
that ends there. Words are encoded by one look-up in a transition table per byte and read back from the last token; no dead end
is entered. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers.pre_tokenizers import ByteLevel

from .common import map_texts, values

_NUMERALS = "".join(chr(c) for c in range(0x10000) if unicodedata.category(chr(c)) in ("No", "Nl"))
#: How the byte-level pre-tokenizer splits text before merges (fixed value); letters are word characters that are no digits, numerals or "_".
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_{_NUMERALS}]+| ?[\d{_NUMERALS}]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
#: Characters but those that every Unicode version of the last decade, and Python, class alike; texts with others are split by the library itself (fixed value).
COMMON = r"[^\x00-\x1b\x20-\u0557\u2010-\u205e\u3001-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3\uff01-\uffbe]"
#: Encoded words that a worker remembers before the older half makes room; this changes speed only.
MEMO = 1 << 18
#: Byte states that a worker's table holds before it starts anew; this changes speed only.
STATES = 1 << 17


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files, as character to byte."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def labels(vocabulary: dict[str, int], specials: dict[str, int]) -> dict[int, bytes]:
    """The bytes of every token."""
    as_byte = byte_characters()
    return {i: bytes(as_byte[c] for c in t) for t, i in vocabulary.items()} | {i: t.encode() for t, i in specials.items()}


def tokens_of(model: dict) -> tuple[dict[str, int], dict[str, int]]:
    """Vocabulary and special tokens of a parsed vocabulary file."""
    specials = {x["content"]: x["id"] for x in model.get("added_tokens", ())}
    return {k: v for k, v in model["model"]["vocab"].items() if k not in specials}, specials


class Decoder:
    """Packed ids to text: emits the labels of arcs, for which no merge has to be compiled."""

    def __init__(self, tokenizer_json: bytes):
        self.label = labels(*tokens_of(json.loads(tokenizer_json)))

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.label.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


class TokenAutomaton:
    """Compiled merges: ``encode_word`` runs bytes through the arcs, ``label`` has each arc's bytes."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], specials: dict[str, int]):
        self.label = labels(vocabulary, specials)
        self.specials = specials
        steps = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges]
        if len({w for _, _, w in steps}) != len(steps):
            raise ValueError("two merges make one token")
        self._place(vocabulary, steps)
        self._compile(steps)
        self.closed = _Closed(self.missing)
        self.table = ByteTable(self, vocabulary)

    def _place(self, vocabulary: dict[str, int], steps: list[tuple[int, int, int]]) -> None:
        """Number tokens so that a token and those grown from it on the left, youngest first, are neighbours."""
        grown: dict[int, list[int]] = {}
        for u, _, w in steps:
            grown.setdefault(u, []).append(w)
        made = {w for _, _, w in steps}
        self.rank: dict[int, int] = {}
        self.end: dict[int, int] = {}
        stack = [(t, False) for t in vocabulary.values() if t not in made]
        while stack:
            t, left = stack.pop()
            if left:
                self.end[t] = len(self.rank)
                continue
            self.rank[t] = len(self.rank)
            stack.append((t, True))
            stack.extend((w, False) for w in grown.get(t, ()))  # the last pushed, the youngest, is numbered first

    def _compile(self, steps: list[tuple[int, int, int]]) -> None:
        """Apply the gadgets in order. A state holds its missing arcs as a chain of rank ranges, shared with the state it was copied from."""
        self.missing: dict[int, tuple | None] = {}
        older: dict[int, int] = {}  # the youngest token grown from v so far: ranks of those before it stay allowed
        for u, v, w in steps:
            before = self.missing.get(v)
            last = older.get(v)
            stop = self.rank[last] if last is not None else self.end[v]
            self.missing[w] = before
            if u == v:  # three in a row pair up from the left, so the new token may not follow its half either
                stop = self.end[w]
            self.missing[u] = (self.rank[v], stop, self.missing.get(u))
            older[u] = w

    def arc(self, state: int, token: int) -> bool:
        """Whether ``token`` may be read in the state after ``state``."""
        return not bisect_right(self.closed[state], self.rank[token]) & 1

    def encode_word(self, word: bytes) -> list[int]:
        """Token ids of one pre-split word."""
        return self.table.run(word)


class ByteTable:
    """Transitions of the determinised automaton, from byte state and byte to byte state, made when first taken.

    A byte state is the set of (token before, place in the tree of labels) of the tokens that may be open, as numbers; where a token ends,
    the pair (that token, root) is among them, as the next token may begin. At most one token ends in a state.
    """

    def __init__(self, automaton: TokenAutomaton, vocabulary: dict[str, int]):
        self.automaton = automaton
        self.size = {t: len(automaton.label[t]) for t in vocabulary.values()}
        #: The tree: for a place and a byte the next place, and the token whose label ends there.
        self.tree: list[dict[int, int]] = [{}]
        self.ending = [-1]
        for t in vocabulary.values():
            at = 0
            for b in automaton.label[t]:
                after = self.tree[at].get(b)
                if after is None:
                    after = self.tree[at][b] = len(self.tree)
                    self.tree.append({})
                    self.ending.append(-1)
                at = after
            self.ending[at] = t
        leaf: dict[int, int] = {}
        self.tree = [x or leaf for x in self.tree]
        self._begin()

    def _begin(self) -> None:
        self.open: list[tuple[int, ...]] = [(-len(self.tree),)]  # token -1, before the first, at the root
        self.names = {self.open[0]: 0}
        self.ended = [-1]
        self.rows: list[dict[int, int]] = [{}]

    def step(self, state: int, byte: int) -> int:
        """The transition, which is added to the table."""
        tree, ending, rank, closed, width = self.tree, self.ending, self.automaton.rank, self.automaton.closed, len(self.tree)
        kept, end = [], -1
        for pair in self.open[state]:
            before, at = divmod(pair, width)
            after = tree[at].get(byte)
            if after is None:
                continue
            if tree[after]:
                kept.append(before * width + after)
            t = ending[after]
            if t >= 0 and end < 0 and (before < 0 or not bisect_right(closed[before], rank[t]) & 1):
                end = t
        if end >= 0:
            kept.append(end * width)
        name = tuple(kept)
        found = self.names.get(name)
        if found is None:
            found = self.names[name] = len(self.open)
            self.open.append(name)
            self.ended.append(end)
            self.rows.append({})
        self.rows[state][byte] = found
        return found

    def run(self, word: bytes) -> list[int]:
        if len(self.open) > STATES:
            self._begin()
        rows, ended, size, state, ends = self.rows, self.ended, self.size, 0, []
        for b in word:
            after = rows[state].get(b)
            state = self.step(state, b) if after is None else after
            ends.append(ended[state])
        path, at = [], len(word)
        while at:
            t = ends[at - 1]
            if t < 0:
                raise ValueError("a byte of the word has no token")
            path.append(t)
            at -= size[t]
        path.reverse()
        return path


class _Closed(dict):
    """For each state, made when first asked for: where its ranges of missing arcs begin and end, in order and disjoint."""

    def __init__(self, missing: dict[int, tuple | None]):
        super().__init__()
        self.missing = missing

    def __missing__(self, state: int) -> array:
        ranges, chain = [], self.missing.get(state)
        while chain is not None:
            ranges.append(chain[:2])
            chain = chain[2]
        bounds: list[int] = []
        for start, stop in sorted(ranges):
            if bounds and start <= bounds[-1]:
                bounds[-1] = max(bounds[-1], stop)
            elif start < stop:
                bounds += (start, stop)
        self[state] = found = array("i", bounds)
        return found


class Codec(Decoder):
    """Whole texts to packed little-endian unsigned 32-bit ids and back."""

    def __init__(self, tokenizer_json: bytes):
        t = json.loads(tokenizer_json)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in t["model"]["merges"]]
        vocabulary, specials = tokens_of(t)
        self.automaton = TokenAutomaton(vocabulary, merges, specials)
        self.label = self.automaton.label
        self.words = re.compile(PATTERN)
        self.odd = re.compile(COMMON)
        self.library = ByteLevel(add_prefix_space=False)
        self.cut = re.compile("|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True))) if specials else None
        self.memo = _Words(self.automaton)

    def split(self, text: str) -> list[str]:
        """Words of a text without special tokens."""
        if self.odd.search(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        return self.words.findall(text)

    def encode(self, text: str) -> bytes:
        if self.cut is None or not self.cut.search(text):
            return b"".join(map(self.memo.__getitem__, self.split(text)))
        out, at = [], 0
        for m in self.cut.finditer(text):
            out += map(self.memo.__getitem__, self.split(text[at : m.start()]))
            out.append(self.automaton.specials[m.group()].to_bytes(4, "little"))
            at = m.end()
        out += map(self.memo.__getitem__, self.split(text[at:]))
        return b"".join(out)


class _Words(dict):
    """Packed ids by word. When full, the words met since the last time stay within reach, so that common ones are kept."""

    def __init__(self, automaton: TokenAutomaton):
        super().__init__()
        self.automaton = automaton
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        packed = self.older.get(word)
        if packed is None:
            packed = np.array(self.automaton.encode_word(word.encode()), dtype="<u4").tobytes()
        if len(word) <= 64:
            if len(self) >= MEMO:
                self.older = dict(self)
                self.clear()
            self[word] = packed
        return packed


_CODECS: dict[tuple[type, int], Decoder] = {}


def _codec(broadcast, kind: type[Decoder]) -> Decoder:
    """The worker's codec of this kind, built once for each vocabulary."""
    key = (kind, hash(broadcast.value))
    if key not in _CODECS:
        if len(_CODECS) >= 4:
            _CODECS.clear()
        _CODECS[key] = kind(broadcast.value)
    return _CODECS[key]


def _column(docs: DataFrame, tokenizer_path: str, source: str, name: str, kind: T.DataType, codec_kind: type[Decoder], apply) -> DataFrame:
    with open(tokenizer_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = T.StructType([*[x for x in docs.schema.fields if x.name != name], T.StructField(name, kind)])
    at = docs.columns.index(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model, codec_kind)
        arrow = pa.binary() if isinstance(kind, T.BinaryType) else pa.string()
        for batch in batches:
            made = pa.array([apply(codec, x) for x in values(batch.column(at))], type=arrow)
            kept = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != name]
            yield pa.RecordBatch.from_arrays([*[c for _, c in kept], made], names=[*[n for n, _ in kept], name])

    return map_texts(docs, run, schema)


def encode(docs: DataFrame, tokenizer_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a binary column of packed ids (little-endian, 4 bytes each); null text gives empty ids.

    Special tokens of the vocabulary file are recognised in texts, as its library does. A column called ``ids`` is
    replaced; all others pass through. Rows are independent, so nothing is shuffled; memory is bounded by the memo and
    the longest text. The vocabulary file (about a megabyte) is read by the driver and broadcast.
    """
    return _column(docs, tokenizer_path, text, ids, T.BinaryType(), Codec, lambda c, x: c.encode(x or ""))


def decode(encoded: DataFrame, tokenizer_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its packed ids; invalid UTF-8 becomes U+FFFD, null ids the empty text."""
    return _column(encoded, tokenizer_path, ids, text, T.StringType(), Decoder, lambda c, x: c.decode(x or b""))


def round_trip(docs: DataFrame, tokenizer_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` as ``encode`` makes them and ``decoded``, the text that ``decode`` makes of those ids, in one pass.

    One worker per task instead of two, which halves the memory of both together. Columns of these names are replaced.
    """
    with open(tokenizer_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    made = {"ids": T.BinaryType(), "decoded": T.StringType()}
    schema = T.StructType([*[x for x in docs.schema.fields if x.name not in made], *[T.StructField(n, k) for n, k in made.items()]])
    at = docs.columns.index(text)
    keep = [i for i, c in enumerate(docs.columns) if c not in made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model, Codec)
        for b in batches:
            ids = [codec.encode(x or "") for x in values(b.column(at))]
            new = [pa.array(ids, pa.binary()), pa.array([codec.decode(x) for x in ids], pa.string())]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in keep], *new], names=[*[b.schema.names[i] for i in keep], *made])

    return map_texts(docs, run, schema)


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of rows with ids and decoded."""
    return decoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("ids"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
