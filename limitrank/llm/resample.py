"""Importance resampling of documents towards a target distribution (after Xie et al., 2023), with hashed n-gram features.

Features are counted twice over: once to sum buckets over the corpus and once to weigh documents. Either pass interns the n-grams of
a batch of texts in an open-addressed NumPy table, so that a feature is digested once per batch, however often it occurs there. Only the
buckets' counts leave the tasks, and their number is a parameter, so they are small whatever the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, stored
from .mixing import _sums_before

#: Occurrences put into a table at once; it never gets more than half full.
SLAB = 1 << 16
#: Bytes of text that share a table; a longer text has one of its own.
TABLE_BYTES = 8_000_000

#: The primes of XXH64 (fixed values).
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))

_WORD = np.ones(256, dtype=bool)
_WORD[0x00:0x30] = _WORD[0x3A:0x61] = _WORD[0x7B:0x80] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _turned(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def xxhash64(data: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of the slices of ``data``; slices of one length below 32 bytes are hashed together, longer ones one by one.

    ``data`` must go on for 8 bytes after the last slice.
    """
    out = np.empty(len(start), dtype=np.uint64)
    wide = _at_any_place(data, "<u8", 8)
    narrow = _at_any_place(data, "<u4", 4)
    single = np.frombuffer(data, np.uint8)
    by_size = np.argsort(size, kind="stable")
    cuts = np.flatnonzero(np.diff(size[by_size], prepend=-1))
    for rows in np.split(by_size, cuts[1:]):
        if not len(rows):
            continue
        n, at = int(size[rows[0]]), start[rows]
        if n >= 32:
            out[rows] = [xxhash.xxh64_intdigest(data[s : s + n]) for s in at.tolist()]
            continue
        h = np.full(len(rows), _P5 + np.uint64(n), dtype=np.uint64)
        done = 0
        while n - done >= 8:
            h = _turned(h ^ (_turned(wide[at + done] * _P2, 31) * _P1), 27) * _P1 + _P4
            done += 8
        if n - done >= 4:
            h = _turned(h ^ (narrow[at + done].astype(np.uint64) * _P1), 23) * _P2 + _P3
            done += 4
        for k in range(done, n):
            h = _turned(h ^ (single[at + k].astype(np.uint64) * _P5), 11) * _P1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        out[rows] = h ^ (h >> np.uint64(32))
    return out


def _at_any_place(data: bytes, kind: str, width: int) -> np.ndarray:
    """``data`` read as numbers that begin at every byte."""
    return np.ndarray((max(0, len(data) - width + 1),), dtype=kind, buffer=data, strides=(1,))


def _equal_bytes(wide: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether slices of equal size hold the same bytes."""
    same = np.ones(len(a), dtype=bool)
    rows, k = np.arange(len(a)), 0
    while len(rows := rows[size[rows] > k]):
        rest = np.minimum(size[rows] - k, 8).astype(np.uint64)
        mask = np.uint64(2**64 - 1) >> (np.uint64(64) - rest * np.uint64(8))
        same[rows] &= ((wide[a[rows] + k] ^ wide[b[rows] + k]) & mask) == 0
        rows, k = rows[same[rows]], k + 8
    return same


class NgramTable:
    """The distinct slices of a buffer: open addressing with linear steps, XXH64 keys, and the bytes compared before a slot is shared.

    Slots hold key, place and size of a slice, its count and its bucket. ``intern`` gives the slot of each occurrence.
    """

    def __init__(self, data: bytes):
        self.data, self.wide = data, _at_any_place(data, "<u8", 8)
        self.used = 0
        self._room(2 * SLAB)

    def _room(self, slots: int) -> None:
        self.key, self.start = np.zeros(slots, dtype=np.uint64), np.full(slots, -1, dtype=np.int64)
        self.size, self.count = np.zeros(slots, dtype=np.int64), np.zeros(slots, dtype=np.int64)

    def _place(self, key: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Slots of the slices, which are put in where they are new. Of equal new slices that meet at a free slot one gets it, and
        the others find it there."""
        mask = len(self.key) - 1
        slot = (key & np.uint64(mask)).astype(np.int64)
        left = np.arange(len(key))
        while len(left):
            at = slot[left]
            new = left[self.start[at] < 0]
            self.start[slot[new]] = new  # one of those that meet stays
            mine = new[self.start[slot[new]] == new]
            to = slot[mine]
            self.key[to], self.start[to], self.size[to] = key[mine], start[mine], size[mine]
            self.used += len(mine)
            like = (self.key[at] == key[left]) & (self.size[at] == size[left])
            like[like] = _equal_bytes(self.wide, self.start[at[like]], start[left[like]], size[left[like]])
            left = left[~like]
            slot[left] = (slot[left] + 1) & mask
        return slot

    def intern(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Slots of all occurrences, after all are in; the counts go up."""
        key = xxhash64(self.data, start, size)
        for i in range(0, len(start), SLAB):
            if 2 * (self.used + SLAB) > len(self.key):
                full = np.flatnonzero(self.start >= 0)
                old = self.key[full], self.start[full], self.size[full], self.count[full]
                self._room(2 * len(self.key))
                self.used = 0
                self.count[self._place(*old[:3])] = old[3]
            part = slice(i, i + SLAB)
            self.count += np.bincount(self._place(key[part], start[part], size[part]), minlength=len(self.key))
        # the table may have grown meanwhile, so slots are looked up at the end
        return np.concatenate([self._place(key[i : i + SLAB], start[i : i + SLAB], size[i : i + SLAB]) for i in range(0, len(start), SLAB)] or [np.zeros(0, np.int64)])

    def buckets(self, n: int) -> np.ndarray:
        """crc32 of each slice modulo ``n``; free slots: 0."""
        out = np.zeros(len(self.key), dtype=np.int64)
        full = np.flatnonzero(self.start >= 0)
        out[full] = [zlib.crc32(self.data[s : s + k]) % n for s, k in zip(self.start[full].tolist(), self.size[full].tolist(), strict=True)]
        return out


def _features(texts: list[bytes], least: int, most: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' words joined by single spaces, then place, size and text of each run of ``least`` to ``most`` words; words of each text."""
    low = _LOWER[np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)]
    word = _WORD[low]
    bounds = np.flatnonzero(np.diff(word, prepend=False, append=False))
    begin, end = bounds[0::2], bounds[1::2]
    ends = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(ends, begin, side="right")
    kept = word.copy()
    kept[end] = True
    low[end] = 32
    place = np.cumsum(kept) - 1
    data = low[kept].tobytes() + bytes(8)
    begin, end = place[begin], place[end]
    runs = [(begin[: len(begin) - k], end[k:], doc[: len(doc) - k], doc[: len(doc) - k] == doc[k:]) for k in range(least - 1, min(most, len(begin)))]
    parts = [(a[ok], (b - a)[ok], d[ok]) for a, b, d, ok in runs] or [(np.zeros(0, np.int64),) * 3]
    start, size, owner = (np.concatenate(x) for x in zip(*parts, strict=True))
    return data, start, size, owner, np.bincount(doc, minlength=len(texts))


def _tables(column: pa.Array, least: int, most: int) -> Iterator[tuple]:
    """The texts of a batch by about TABLE_BYTES: first row, rows, table, slots and text of each occurrence, words of each text."""
    held: list[bytes] = []
    first = total = 0
    for i in range(len(column)):
        text = column[i].as_py() or ""
        held.append(text.encode("utf-8", "replace"))
        total += len(held[-1])
        if total >= TABLE_BYTES or i == len(column) - 1:
            data, start, size, owner, words = _features(held, least, most)
            table = NgramTable(data)
            yield first, len(held), table, table.intern(start, size), owner, words
            first, total, held = i + 1, 0, []


def bucket_counts(docs: DataFrame, words: tuple[int, int] = (1, 1), buckets: int = 10_000) -> DataFrame:
    """bucket, n: occurrences of the features of all texts of ``docs`` (text) by bucket; a task sends a row for each bucket at most."""
    least, most = words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for _, _, table, _, _, _ in _tables(b.column(0), least, most):
                np.add.at(total, table.buckets(buckets), table.count)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], names=["bucket", "n"])

    return map_texts(docs.select("text"), run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """Gain of each bucket in thousandths, floored: the log ratio of its shares, with one more occurrence in every bucket of either.

    The driver gets two numbers for each of ``buckets``, so little at any size of the tables.
    """
    s, t = np.zeros(buckets), np.zeros(buckets)
    for counts, into in ((source, s), (target, t)):
        for row in counts.collect():
            into[row.bucket] = row.n
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, words: tuple[int, int] = (1, 1)) -> DataFrame:
    """doc_id, n_words, n_features, weight for each row of ``docs`` (doc_id, text): the floored mean of its features' gains (none: 0)."""
    least, most = words
    field = docs.schema["doc_id"].dataType
    kind = docs.select("doc_id").limit(0).toArrow().schema.field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, n, table, slots, owner, n_words in _tables(b.column(1), least, most):
                gained = gains[table.buckets(len(gains))][slots]
                features = np.bincount(owner, minlength=n)
                weight = np.bincount(owner, weights=gained, minlength=n).astype(np.int64) // np.maximum(features, 1)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, n).cast(kind), pa.array(n_words, pa.int64()), pa.array(features, pa.int64()), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"])

    return map_texts(docs.select("doc_id", "text"), run, f"doc_id {field.simpleString()}, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, words: tuple[int, int] = (1, 1), buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024) -> DataFrame:
    """doc_id, n_features, weight, score, rank for each row of ``docs`` (doc_id, text); rank is null for rows that are not drawn.

    Features are runs of words of whole texts, A-Z lower-cased. score is the weight plus Gumbel noise that the seed and the id decide, so
    the highest scores are a sample without replacement by weight. Of the rows with ``least_words`` words or more, ``percent`` of a hundred
    (rounded down) are drawn, ties to the smaller id; rows equal in score and id too go by weight and size. Rows are ranked by ranges of
    scores, so no task holds them all.

    Null texts have no features; a null id has the noise of an empty one and comes last among ties; repeated rows repeat, each with a
    rank of its own; no rows give no rows, and an empty target makes rare features gain. Extra columns are ignored.
    """
    gains = bucket_gains(bucket_counts(docs, words, buckets), bucket_counts(target, words, buckets), buckets)
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored, _ = stored(weigh(docs, gains, words).withColumn("score", F.col("weight") + noise), "resample")
    able = scored.where(F.col("n_words") >= least_words)
    n = able.count() * percent // 100
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last(), F.desc("weight"), F.desc("n_features")]
    ranked, _ = _sums_before(able, order, {"before": F.lit(1).cast("long")})
    out = ranked.withColumn("rank", F.when(F.col("before") < n, F.col("before") + 1)).drop("before")
    out = out.unionByName(scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
