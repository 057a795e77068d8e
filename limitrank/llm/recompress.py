"""Removal of repeated passages by recompression (after Jeż, 2013): equal passages are made to hold equal symbols, and those are compared.

Every text becomes a sequence of symbols. In a round, runs of one word and then pairs of neighbours become symbols of their own; which
neighbours pair is decided by a coin that each symbol carries, so it depends on nothing but the two. Equal passages therefore get equal symbols
except near their ends, and for each symbol it is known how much text around it decided its form. After each round Spark names the new
symbols: it counts them over the whole corpus, those that occur again keep their name, and those that occur once are left and pair no more, as no
repeated passage holds them. A window of words that holds such a symbol, with the text that decided it, is unlike any other window.

The last rounds compare words: the text that decides a symbol, then stretches of windows between some of the symbols, then, of stretches that
are not equal to an earlier one, the symbols that other such stretches hold too, and the single windows around those. Stretches and windows
are compared by 128 bits: a window counts as repeated only if all its words are equal, so names decide what is compared, never what is removed.

Texts are cut into chunks once; chunks stay where they are (a bucketed table) and only names that are asked for, packed and cut into
ranges of their hashes, travel, with a bit each for the answers.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed, group_starts, map_texts, stored, values, whole_groups
from .word_lm import _packed, _unpacked

#: Words after which a chunk ends (with a whole document), and names that are counted in a range of hashes, about.
CHUNK, RANGE = 350_000, 2_000_000
#: Pairings in each of the rounds after which names are given.
ROUNDS = (2, 1)
#: One of so many symbols ends a stretch.
STRETCH = 8

_FAR = 1 << 20
_ODD = 0x9E3779B97F4A7C15
#: Bases of the two sums that tell stretches of words apart, with their inverses modulo 2**64.
_BASES = tuple((np.uint64(b), np.uint64(pow(b, -1, 2**64))) for b in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F))


def _spread(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that leaves no pattern (the finaliser of splitmix64; its constants are fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of a base and of its inverse."""
    return tuple(np.multiply.accumulate(np.append(np.uint64(1), np.full(n - 1, x, dtype=np.uint64))) for x in _BASES[which])


def _digest(b: bytes) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(b)).astype(np.int64))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (doc_id, text) as chunks: ids, digests and sizes of texts, digests of distinct words, the number of each word's, and the words."""
    part, made = TaskContext.get().partitionId(), 0

    def fresh() -> tuple:
        index = defaultdict(int)
        index.default_factory = index.__len__  # a new word gets the next number
        return [], [], [], array("q"), [], index

    def row() -> pa.RecordBatch:
        named = np.array([xxhash.xxh64_intdigest(w) for w in index], dtype=np.uint64).view(np.int64)
        lists = [pa.array([x], pa.list_(t)) for x, t in ((ids, pa.int64()), (digests, pa.int64()), (sizes, pa.int32()), (named, pa.int64()))]
        content = b"\n".join(lines)
        packed = [_packed(np.frombuffer(tokens, dtype=np.int64)), pa.compress(content, codec="zstd", asbytes=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array([(part << 32) + made], pa.int64()), *lists, *[pa.array([x], pa.binary()) for x in packed], pa.array([len(content)], pa.int64())],
            names=["chunk", "ids", "digests", "sizes", "words", "tokens", "content", "bytes"])

    ids, digests, sizes, tokens, lines, index = fresh()
    for b in batches:
        for doc_id, text in zip(values(b.column(0), 64), values(b.column(1), 64), strict=True):
            words = (text or "").encode("utf-8", "replace").split()  # at bytes 9 to 13 and 32
            line = b" ".join(words)
            ids.append(doc_id)
            digests.append(_digest(line))
            sizes.append(len(words))
            lines.append(line)
            tokens.extend(map(index.__getitem__, words))
            if len(tokens) >= CHUNK or len(ids) >= CHUNK // 4:
                yield row()
                ids, digests, sizes, tokens, lines, index = fresh()
                made += 1
    if ids:
        yield row()


class _Words:
    """A chunk's words as digests; ``begin`` and ``end`` of the text of each."""

    def __init__(self, row: dict, window: int):
        self.window, self.sizes = window, row["sizes"].astype(np.int64)
        self.words = row["words"].view(np.uint64)[_unpacked(row["tokens"]).view(np.int64)]
        ends = np.cumsum(self.sizes)
        self.begin, self.end = np.repeat(ends - self.sizes, self.sizes), np.repeat(ends, self.sizes)
        # texts equal in id and words are one text
        self.keys = [(i is None, i or 0, d) for i, d in zip(row["ids"], row["digests"].tolist(), strict=True)]
        self.sums: dict[int, np.ndarray] = {}

    @cached_property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    @cached_property
    def place(self) -> np.ndarray:
        """Place of each text among the chunk's."""
        places = {k: j for j, k in enumerate(sorted(set(self.keys)))}
        return np.array([places[k] for k in self.keys], dtype=np.int64)

    def stretch(self, a: np.ndarray, b: np.ndarray, which: int) -> np.ndarray:
        """64 bits of the words from ``a`` to before ``b``."""
        n = len(self.words)
        up, down = _powers(which, 1 << max(10, n.bit_length()))
        if which not in self.sums:
            self.sums[which] = np.append(np.uint64(0), np.cumsum(self.words * up[:n], dtype=np.uint64))
        total = self.sums[which]
        return _spread((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64) * np.uint64(_ODD))


def _unique_windows(lo: np.ndarray, hi: np.ndarray, window: int, n: int) -> np.ndarray:
    """How many of the stretches from ``lo`` to before ``hi`` the window at each word holds."""
    sums = np.zeros(n + window + 2, dtype=np.int32)
    np.add.at(sums, np.maximum(hi - window, 0), 1)
    np.add.at(sums, lo + 1, -1)
    return np.cumsum(sums)[:n]


class _Parse(_Words):
    """A chunk's words and their symbols.

    ``start``, ``size`` and ``name`` of each symbol; ``left`` and ``right``: how many words beside it decided its form (_FAR: what is not in
    the text); ``opens``: whether a text begins with it; ``named``: whether it may occur elsewhere; ``fresh``: whether that has not been asked.
    ``dead`` counts for each window the symbols that make it unique.
    """

    def __init__(self, row: dict, window: int):
        super().__init__(row, window)
        self.dead = np.zeros(len(self.words), dtype=np.int32)
        self._runs()

    def _runs(self, most: int = 4) -> None:
        """Runs of two to ``most`` equal words become symbols; in longer ones words stay, and count as never decided."""
        n = len(self.words)
        first_word = self.begin == np.arange(n)
        new = first_word.copy()
        new[1:] |= self.words[1:] != self.words[:-1]
        group = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, n)).astype(np.int32)
        kept = new | (size[group] > most)
        self.start = np.flatnonzero(kept)
        k = size[group[self.start]]
        run = (k > 1) & (k <= most)
        self.size = np.where(run, k, 1).astype(np.int32)
        self.name = np.where(run, _spread(self.words[self.start] + k.astype(np.uint64) * np.uint64(_ODD)), self.words[self.start])
        self.opens = first_word[self.start]
        closes = np.append(self.opens[1:], True)[: len(self.start)]
        self.left = np.where(self.opens | (k > most), _FAR, 1).astype(np.int32)
        self.right = np.where(closes | (k > most), _FAR, 1).astype(np.int32)
        self.named, self.fresh = np.ones(len(self.start), dtype=bool), np.ones(len(self.start), dtype=bool)

    def pair(self, step: int) -> None:
        """Neighbours whose coins fall left and right become one symbol, of at most half a window."""
        n = len(self.start)
        if not n:
            return
        size, named = self.size, self.named
        coin = _spread(self.name + np.uint64((step + 1) * _ODD % 2**64)).view(np.int64) < 0
        joined = ~self.opens[1:]
        two = np.zeros(n, dtype=bool)
        two[:-1] = joined & ~coin[:-1] & coin[1:] & named[:-1] & named[1:] & (size[:-1] + size[1:] <= self.window // 2)
        # a symbol alone has to know the neighbour that it did not pair with
        after, before = np.full(n, _FAR, dtype=np.int32), np.full(n, _FAR, dtype=np.int32)
        after[:-1] = np.where(joined, size[1:] + self.right[1:], _FAR)
        before[1:] = np.where(joined, size[:-1] + self.left[:-1], _FAR)
        taken = np.append(False, two[:-1])
        right = np.where(named & ~coin & ~two, np.maximum(self.right, after), self.right)
        left = np.where(named & coin & ~taken, np.maximum(self.left, before), self.left)
        keep = np.flatnonzero(~taken)
        both = two[keep]
        pairs = keep[both]
        name, size, right = self.name[keep], size[keep], right[keep]
        name[both] = _spread(_spread(self.name[pairs]) * np.uint64(3) + self.name[pairs + 1])
        size[both] += self.size[pairs + 1]
        right[both] = self.right[pairs + 1]
        self.start, self.name, self.size, self.opens = self.start[keep], name, size, self.opens[keep]
        self.left, self.right = np.minimum(left[keep], _FAR), np.minimum(right, _FAR)
        self.named, self.fresh = named[keep], self.fresh[keep] | both

    def _whole(self) -> np.ndarray:
        """Symbols that a window can hold with all that decided them."""
        return self.size + self.left + self.right <= self.window

    def asked(self, last: bool) -> tuple[np.ndarray, np.ndarray]:
        """Symbols to ask for, and their names; in the last round those of the text that decided them."""
        if last:
            at = np.flatnonzero(self.named & self._whole())
            return at, self.stretch(self.start[at] - self.left[at], self.start[at] + self.size[at] + self.right[at], 0)
        at = np.flatnonzero(self.named & self.fresh)
        return at, self.name[at]

    def told(self, at: np.ndarray, again: np.ndarray, last: bool) -> None:
        """``again``: whether each symbol of ``at`` occurs elsewhere. Windows around those that do not are unique."""
        gone = at[~again]
        gone = gone[self._whole()[gone]]
        self.dead += _unique_windows(self.start[gone] - self.left[gone], self.start[gone] + self.size[gone] + self.right[gone], self.window, len(self.words))
        if not last:
            self.named[at] = again
            self.fresh[:] = False

    def live(self) -> np.ndarray:
        """First words of the windows that may be repeated."""
        return np.flatnonzero((np.arange(self.window, len(self.words) + self.window) <= self.end) & (self.dead == 0))

    def stretches(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last window of each stretch of neighbouring live windows that begin between the same two of the symbols that end stretches."""
        at = self.live()
        group = np.searchsorted(self.start[_spread(self.name) % np.uint64(STRETCH) == 0], at)
        new = np.ones(len(at), dtype=bool)
        new[1:] = (np.diff(at) != 1) | (np.diff(group) != 0) | (self.begin[at[1:]] != self.begin[at[:-1]])
        first = np.flatnonzero(new)
        return at[first], at[np.append(first[1:], len(at)) - 1] if len(at) else at

    def decided(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word, and the one after the last, of each symbol with the text that decided it, where any of ``windows`` holds that."""
        at = np.flatnonzero(self._whole())
        lo, hi = self.start[at] - self.left[at], self.start[at] + self.size[at] + self.right[at]
        some = _held(windows, lo, hi, self.window, len(self.words))
        return lo[some], hi[some]


def _held(windows: np.ndarray, lo: np.ndarray, hi: np.ndarray, window: int, n: int) -> np.ndarray:
    """Whether each stretch from ``lo`` to before ``hi`` lies in any of ``windows``."""
    sums = np.zeros(n + 2, dtype=np.int32)
    sums[windows + 1] = 1
    sums = np.cumsum(sums)
    return sums[lo + 1] - sums[np.maximum(hi - window, 0)] > 0


class _Firsts:
    """Stretches of words from ``a`` to before ``b`` by content: which is the first of each in the chunk, and which come later."""

    def __init__(self, parse: _Words, a: np.ndarray, b: np.ndarray):
        self.k1, self.k2 = (parse.stretch(a, b, i) for i in (0, 1))
        self.place, self.pos = parse.place[parse.doc[a]], a - parse.begin[a]
        order = np.lexsort((self.pos, self.place, self.k2, self.k1))
        new = np.ones(len(a), dtype=bool)
        new[1:] = (np.diff(self.k1[order]) != 0) | (np.diff(self.k2[order]) != 0)
        head = order[np.flatnonzero(new)]
        self.head = np.empty(len(a), dtype=np.int64)
        self.head[order] = head[np.cumsum(new) - 1]
        self.heads, self.doc = np.sort(head), parse.doc[a]
        self.same = (self.place == self.place[self.head]) & (self.pos == self.pos[self.head])

    def later(self, told: np.ndarray) -> np.ndarray:
        """Whether each is equal to one that starts earlier; ``told``: those of ``heads`` of which that is known from elsewhere."""
        known = np.zeros(len(self.k1), dtype=bool)
        known[told] = True
        return ~self.same | known[self.head]


def _bits_of(flags: np.ndarray) -> bytes:
    return pa.compress(np.packbits(flags).tobytes(), codec="zstd", asbytes=True) if len(flags) else b""


def _flags(b: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(pa.decompress(b, -(-n // 8), codec="zstd", asbytes=True), np.uint8))[:n].astype(bool) if n else np.zeros(0, bool)


def _cuts(keys: np.ndarray, bits: int) -> np.ndarray:
    return np.searchsorted(keys >> np.uint64(64 - bits), np.arange(2**bits + 1)) if bits else np.array([0, len(keys)])


def _given(row: dict, r: int, names: np.ndarray, bits: int) -> np.ndarray:
    """Whether each of ``names`` occurs elsewhere, by the answers of round ``r``."""
    keys, inverse = np.unique(names, return_inverse=True)
    cuts, again = _cuts(keys, bits), np.zeros(len(keys), dtype=bool)
    for x in row["told"]:
        if x["round"] == r:
            lo, hi = cuts[x["bucket"]], cuts[x["bucket"] + 1]
            again[lo:hi] = _flags(x["bits"], hi - lo)
    return again[inverse]


def _replayed(row: dict, window: int, rounds: int, bits: int) -> _Parse:
    """A chunk after ``rounds`` rounds of answers (``told``: round, range, bits)."""
    parse, step = _Parse(row, window), 0
    row = row | {"told": row["told"] or []}
    for r in range(rounds):
        last = r == len(ROUNDS)
        if not last:
            for _ in range(ROUNDS[r]):
                parse.pair(step)
                step += 1
        at, names = parse.asked(last)
        parse.told(at, _given(row, r, names, bits), last)
    if rounds < len(ROUNDS):
        for _ in range(ROUNDS[rounds]):
            parse.pair(step)
            step += 1
    return parse


def _ask(window: int, r: int, bits: int) -> Callable:
    """The names to be given in round ``r``, and whether a chunk holds them more than once, cut into ranges of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            if r <= len(ROUNDS):
                names = _replayed(row, window, r, bits).asked(r == len(ROUNDS))[1]
            else:
                names = _Settled(row | {"told": row["told"] or []}, window, bits).asked()[2]
            keys, n = np.unique(names, return_counts=True)
            cuts = _cuts(keys, bits)
            used = np.flatnonzero(np.diff(cuts))
            ranges = [slice(cuts[j], cuts[j + 1]) for j in used]
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array([row["chunk"]] * len(used), pa.int64()), pa.array([_packed(np.append(keys[s][:1], np.diff(keys[s]))) for s in ranges], pa.binary()),
                 pa.array([_bits_of(n[s] > 1) for s in ranges], pa.binary())], names=["bucket", "chunk", "keys", "twice"])

    return run


def _answer(r: int) -> Callable:
    """Whether each name that a chunk asks for occurs more than once in all chunks together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["bucket"]):
            at = group_starts(t, ["bucket"])
            for lo, hi in zip(at[:-1], at[1:], strict=True):
                g = t.slice(lo, hi - lo)
                asked = [np.cumsum(_unpacked(x), dtype=np.uint64) for x in g.column("keys").to_pylist()]
                twice = np.concatenate([_flags(x, len(k)) for x, k in zip(g.column("twice").to_pylist(), asked, strict=True)])
                _, inverse = np.unique(np.concatenate(asked), return_inverse=True)
                again = np.bincount(inverse, weights=1 + twice)[inverse] > 1
                cuts = np.cumsum([0, *map(len, asked)])
                bits = pa.array([_bits_of(again[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([g.column("chunk").combine_chunks(), pa.array(np.full(hi - lo, r, np.int32)), g.column("bucket").combine_chunks(), bits], names=["chunk", "round", "bucket", "bits"])

    return run


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows as Python values, but lists of numbers without nulls as arrays."""
    for b in batches:
        for i in range(b.num_rows):
            row = {}
            for name, column in zip(b.schema.names, b.columns, strict=True):
                x = column[i]
                plain = pa.types.is_list(column.type) and pa.types.is_integer(column.type.value_type) and name != "ids"
                row[name] = x.values.to_numpy(zero_copy_only=False) if plain and x.is_valid else np.zeros(0, dtype=np.int64) if plain else x.as_py()
            yield row


_FOUND = "k1 long, k2 long, no_id boolean, id long, digest long, pos int, slot int"


def _found(words: _Words, f: "_Firsts") -> list[pa.Array]:
    """The first of each content in a chunk, in the columns of _FOUND."""
    h = f.heads
    d = f.doc[h]
    ids, digests = (np.array([k[i] for k in words.keys], dtype=np.int64) for i in (1, 2))
    no_id = np.array([k[0] for k in words.keys], dtype=bool)
    return [pa.array(x) for x in (f.k1[h].view(np.int64), f.k2[h].view(np.int64), no_id[d], ids[d], digests[d], f.pos[h].astype(np.int32), h.astype(np.int32))]


def _stretches(window: int, bits: int) -> Callable:
    """What later rounds need of each chunk: its stretches, the symbols in their windows, and the first stretch of each content."""
    names = [x.split()[0] for x in _FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            parse = _replayed(row, window, len(ROUNDS) + 1, bits)
            a, b = parse.stretches()
            lo, hi = parse.decided(parse.live())
            found = pa.StructArray.from_arrays(_found(parse, _Firsts(parse, a, b + window)), names)
            packed = [_packed(np.append(a[:1], np.diff(a))), _packed(b - a), _packed(np.append(lo[:1], np.diff(lo)) + _FAR), _packed(hi - lo)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["chunk"]], pa.int64()), *[pa.array([x], pa.binary()) for x in packed], pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), found)], names=["chunk", "a", "b", "lo", "hi", "found"])

    return run


class _Settled:
    """A chunk after the stretches: which of them are equal to an earlier one, and the windows of the others."""

    def __init__(self, row: dict, window: int, bits: int):
        self.row, self.bits, self.window = row, bits, window
        self.words = _Words(row, window)
        a, b, lo, hi = (_unpacked(row[k]).astype(np.int64) for k in ("a", "b", "lo", "hi"))
        self.a = np.cumsum(a)
        self.b = self.a + b
        self.lo = np.cumsum(lo - _FAR)
        self.hi = self.lo + hi
        self.later = _Firsts(self.words, self.a, self.b + window).later(row["later"])
        rest = [np.arange(x, y + 1) for x, y in zip(self.a[~self.later].tolist(), self.b[~self.later].tolist(), strict=True)]
        self.open = np.concatenate(rest) if rest else np.zeros(0, dtype=np.int64)

    def asked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols in open windows with the text that decided them: first word, the one after the last, name."""
        some = _held(self.open, self.lo, self.hi, self.window, len(self.words.words))
        lo, hi = self.lo[some], self.hi[some]
        return lo, hi, self.words.stretch(lo, hi, 0)

    def windows(self) -> tuple[np.ndarray, "_Firsts"]:
        """Open windows all of whose symbols occur in other open windows too; the others are the first of their kind."""
        lo, hi, names = self.asked()
        single = ~_given(self.row, len(ROUNDS) + 1, names, self.bits)
        unique = _unique_windows(lo[single], hi[single], self.window, len(self.words.words))
        found = self.open[unique[self.open] == 0]
        return found, _Firsts(self.words, found, found + self.window)


def _windows(window: int, bits: int) -> Callable:
    """The first window of each content in a chunk, of those that are left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            s = _Settled(row | {"told": row["told"] or []}, window, bits)
            found = _found(s.words, s.windows()[1])
            yield pa.RecordBatch.from_arrays([*found, pa.array(np.full(len(found[0]), row["chunk"], np.int64))], names=[*[x.split()[0] for x in _FOUND.split(", ")], "chunk"])

    return run


def _kept(window: int, bits: int) -> Callable:
    """The texts without what is repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            s = _Settled(row | {"told": row["told"] or []}, window, bits)
            parse = s.words
            cover = np.zeros(len(parse.words) + 1, dtype=np.int64)
            np.add.at(cover, s.a[s.later], 1)
            np.add.at(cover, s.b[s.later] + window, -1)
            at, windows = s.windows()
            found = at[windows.later(row["gone"])]
            np.add.at(cover, found, 1)
            np.add.at(cover, found + window, -1)
            gone = np.cumsum(cover)[:-1] > 0
            lines = pa.decompress(row["content"], row["bytes"], codec="zstd", asbytes=True).split(b"\n")
            ends = np.cumsum(parse.sizes)
            for i in range(0, len(lines), 256):
                texts, removed, spans = [], [], []
                for line, lo, hi in zip(lines[i : i + 256], (ends - parse.sizes)[i : i + 256].tolist(), ends[i : i + 256].tolist(), strict=True):
                    g = gone[lo:hi]
                    removed.append(int(g.sum()))
                    edges = np.flatnonzero(np.diff(g, prepend=False, append=False)) if removed[-1] else []
                    spans.append([{"first": int(x), "last": int(y) - 1} for x, y in zip(edges[0::2], edges[1::2], strict=True)])
                    texts.append(b" ".join([w for w, x in zip(line.split(b" "), g.tolist(), strict=True) if not x]) if removed[-1] else line)
                n = slice(i, i + 256)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"][n], pa.int64()), pa.array(parse.sizes[n]), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))), pa.array(texts, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "n_removed", "removed", "kept"])

    return run


def remove_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed, removed (first and last word of each stretch), kept (words joined by one space) for each row of ``docs``
    (doc_id, text).

    Words are what is between ASCII white space. A window is ``window`` words in a row of one text; the words of a window whose sequence also
    starts earlier, in a text with a smaller id or before it in the same text, are removed. Windows are judged on the whole input.

    doc_id is an integer; null ids come last. Rows equal in id and words are one text and share a result; of rows that share an id only, the
    smaller digest of the words is the earlier. Null and empty texts have no words, and texts of fewer words than a window keep them. Very
    long texts are a chunk of their own. No rows give no rows; extra columns are ignored.
    """
    if window < 4:
        raise ValueError("a window has four words at least")
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    plan = "chunk long, ids array<long>, digests array<long>, sizes array<int>, words array<long>, tokens binary, content binary, bytes long"
    content = bucketed(map_texts(rows, _chunks, plan), "chunk")
    n_words = content.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    bits = int(np.ceil(np.log2(max(1.0, n_words / RANGE))))
    seen = content.select("chunk", "ids", "digests", "sizes", "words", "tokens")
    answers = spark.createDataFrame([], "chunk long, round int, bucket int, bits binary")

    def known(whole: DataFrame, *more: DataFrame) -> DataFrame:
        d = answers.groupBy("chunk").agg(F.collect_list(F.struct("round", "bucket", "bits")).alias("told"))
        for other in (d, *more):
            whole = whole.join(other.hint("merge"), "chunk", "left")
        return whole

    def named(r: int, whole: DataFrame) -> DataFrame:
        asked = map_texts(whole, _ask(window, r, bits), "bucket int, chunk long, keys binary, twice binary")
        given = asked.repartition("bucket").sortWithinPartitions("bucket", "chunk").mapInArrow(_answer(r), "chunk long, round int, bucket int, bits binary")
        return answers.unionByName(stored(given, "names")[0])

    def earlier(found: DataFrame, name: str) -> DataFrame:
        """Slots of what starts earlier elsewhere, by chunk."""
        at = F.struct("no_id", "id", "digest", "pos")
        first = found.groupBy("k1", "k2").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        slots = found.join(first.hint("merge"), ["k1", "k2"]).where(at != F.col("first"))
        return stored(slots.groupBy("chunk").agg(F.collect_list("slot").alias(name)), "later")[0]

    for r in range(len(ROUNDS) + 1):
        answers = named(r, known(seen))
    state, _ = stored(map_texts(known(seen), _stretches(window, bits), f"chunk long, a binary, b binary, lo binary, hi binary, found array<struct<{', '.join(x.replace(' ', ':') for x in _FOUND.split(', '))}>>"), "stretches")
    later = earlier(state.select("chunk", F.explode("found").alias("f")).select("chunk", "f.*"), "later")
    answers = spark.createDataFrame([], answers.schema)  # of the rounds before only the stretches matter from now on
    state = state.drop("found")
    answers = named(len(ROUNDS) + 1, known(seen, state, later))
    windows, _ = stored(map_texts(known(seen, state, later), _windows(window, bits), f"{_FOUND}, chunk long"), "windows")
    gone = earlier(windows, "gone")
    out = "doc_id long, n_words long, n_removed long, removed array<struct<first:int,last:int>>, kept string"
    return map_texts(known(content, state, later, gone), _kept(window, bits), out)
