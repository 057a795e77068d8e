"""Cross-entropy difference of documents between a target and a background model of word bigrams (after Moore and Lewis, 2010).

The target model learns from the target documents, the background from as many words of other documents, and a document is scored by what
both have learned from others than itself, so target documents compare with the rest. The tables of both models grow with the corpus, so they
are neither broadcast nor brought to the driver. Texts are read once into chunks; a chunk asks for each of its distinct n-grams once, n-grams are counted and answered in ranges of their hashes, and the answers go back
to the chunks. So a common n-gram costs one entry per chunk, not one per occurrence.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed, group_starts, stored, whole_groups

#: Tokens after which a chunk ends (with a whole document), and n-grams asked for in a range of hashes, about.
CHUNK, RANGE = 600_000, 2_000_000

_CJK = "\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_TOKEN = re.compile(rf"[^\W{_CJK}]+|[{_CJK}]|[^\w\s]")


def words(text: str | None) -> list[str]:
    """Tokens of a whole text, as written: runs of letters and digits, single CJK characters, and every other visible character."""
    return _TOKEN.findall(text) if text else []


def _name(token: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(token, digest_size=8).digest(), "little", signed=True)


#: No token holds white space.
_START, _END, _TOTAL = _name(b" start"), _name(b" end"), np.uint64(_name(b" total") & (2**64 - 1)) | np.uint64(1)


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers that are not negative, mostly small, by planes of bytes."""
    x = x.astype("<u8")
    used = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :used].T).tobytes()
    return len(x).to_bytes(4, "little") + bytes([used]) + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def _unpacked(b: bytes) -> np.ndarray:
    n, used = int.from_bytes(b[:4], "little"), b[4]
    out = np.zeros((n, 8), dtype=np.uint8)
    if n and used:
        out[:, :used] = np.frombuffer(pa.decompress(b[5:], n * used, codec="zstd", asbytes=True), np.uint8).reshape(used, n).T
    return out.reshape(-1).view("<u8")


def _bigrams(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a * np.uint64(0x9E3779B97F4A7C15) + b) ^ (b >> np.uint64(29))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) & ~np.uint64(1)


def _chunks(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Rows of (doc_id, text) as chunks: ids, numbers of tokens, names of distinct words, and the number of each token's word."""
    part, made = TaskContext.get().partitionId(), 0
    ids, sizes, tokens, index = [], [], [], {}

    def row() -> pa.RecordBatch:
        names = [_name(w.encode("utf-8", "replace")) for w in index]
        lists = [pa.array([ids], pa.list_(kind)), pa.array([sizes], pa.list_(pa.int32())), pa.array([names], pa.list_(pa.int64()))]
        at = pa.array([_packed(np.array(tokens, dtype=np.int64))], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([(part << 32) + made], pa.int64()), *lists, at], names=["chunk", "ids", "sizes", "words", "tokens"])

    for b in batches:
        for i in range(0, b.num_rows, 64):
            for doc_id, text in zip(b.column(0).slice(i, 64).to_pylist(), b.column(1).slice(i, 64).to_pylist(), strict=True):
                w = words(text)
                ids.append(doc_id)
                sizes.append(len(w))
                tokens += [index.setdefault(x, len(index)) for x in w]
                if len(tokens) >= CHUNK or len(ids) >= CHUNK // 4:
                    yield row()
                    ids, sizes, tokens, index, made = [], [], [], {}, made + 1
    if ids:
        yield row()


class _Chunk:
    """A chunk's n-grams: ``keys`` are its distinct ones in order; ``one``, ``before`` and ``two`` say for each predicted token which
    of them are the token, the one before it and both. Every text with a token ends with a predicted end."""

    def __init__(self, row: dict):
        sizes = np.array(row["sizes"], dtype=np.int64)
        names = np.array(row["words"], dtype=np.int64)
        full = np.flatnonzero(sizes)
        ends = np.cumsum(sizes[full] + 2)
        h = np.full(int(ends[-1]) if len(ends) else 0, _END, dtype=np.int64)
        started = np.zeros(len(h), dtype=bool)
        started[ends - sizes[full] - 2] = True
        inner = ~started
        inner[ends - 1] = False
        h[started], h[inner] = _START, names[_unpacked(row["tokens"])]
        h = h.view(np.uint64)
        at = np.flatnonzero(~started)
        self.doc = np.repeat(full, sizes[full] + 1)
        self.sizes, self.n_docs = sizes, len(sizes)
        self.draws = np.array([_name(repr(i).encode()) for i in row["ids"]], dtype=np.int64).view(np.uint64)
        self.target = np.zeros(self.n_docs, dtype=bool)
        self.target[row["pos"] or []] = True
        single = np.concatenate([h | np.uint64(1), [_TOTAL]])
        self.keys, inverse = np.unique(np.concatenate([single, _bigrams(h[at - 1], h[at])]), return_inverse=True)
        self.inverse = inverse
        self.one, self.before, self.two, self.total = inverse[at], inverse[at - 1], inverse[len(single) :], inverse[len(h)]
        self.owner = np.concatenate([np.repeat(full, sizes[full] + 2), [-1], self.doc])

    def background(self, share: float) -> np.ndarray:
        """Documents that the background learns from: about ``share`` of those that are no targets, drawn by their ids."""
        return ~self.target & (self.draws.astype(np.float64) < share * 2.0**64)

    def counts(self, chosen: np.ndarray | None = None) -> np.ndarray:
        """Occurrences of each key in the documents ``chosen`` (a mask), or of each token in all."""
        mine = self.inverse[: len(self.inverse) - len(self.two)] if chosen is None else self.inverse[np.append(chosen, False)[self.owner]]
        out = np.bincount(mine, minlength=len(self.keys))
        out[self.total] = len(self.doc) if chosen is None else int(chosen[self.doc].sum())
        return out

    def own(self) -> dict[str, np.ndarray]:
        """For each predicted token, how often it, the token before it, both, and any token occur in its own document."""
        k = len(self.keys)
        pairs, n = np.unique(self.owner * k + self.inverse, return_counts=True)
        found = {name: n[np.searchsorted(pairs, self.doc * k + keys)] for name, keys in (("one", self.one), ("before", self.before), ("two", self.two))}
        return found | {"total": self.sizes[self.doc] + 1}

    def log_probabilities(self, n: np.ndarray, all_: np.ndarray, own: dict[str, np.ndarray], prior: float, base: float) -> np.ndarray:
        """Of each predicted token after the one before it, given the counts ``n`` of the keys less ``own``: Dirichlet priors down to the
        shares of tokens in the whole corpus (counts ``all_``), where every token occurs."""
        share = all_[self.one] / all_[self.total] if len(self.one) else np.zeros(0)
        p = (n[self.one] - own["one"] + base * share) / (n[self.total] - own["total"] + base)
        return np.log((n[self.two] - own["two"] + prior * p) / (n[self.before] - own["before"] + prior))


#: What is counted: tokens of all documents, n-grams of the targets, n-grams of the background.
_COUNTED = ("n", "m", "b")


def _ask(bits: int, share: float):
    """The n-grams of every chunk with their counts, cut into ranges of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                c = _Chunk(row)
                counted = c.counts(), c.counts(c.target), c.counts(c.background(share))
                cuts = np.searchsorted(c.keys >> np.uint64(64 - bits), np.arange(2**bits + 1)) if bits else np.array([0, len(c.keys)])
                used = np.flatnonzero(np.diff(cuts))
                ranges = [slice(cuts[j], cuts[j + 1]) for j in used]
                parts = [[_packed(np.append(c.keys[r][:1], np.diff(c.keys[r]))) for r in ranges], *[[_packed(x[r]) for r in ranges] for x in counted]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int32()), pa.array([row["chunk"]] * len(used), pa.int64()), *[pa.array(x, pa.binary()) for x in parts]],
                    names=["bucket", "chunk", "keys", *_COUNTED],
                )

    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of all chunks together for the n-grams that each asked for."""
    for t in whole_groups(batches, ["bucket"]):
        at = group_starts(t, ["bucket"])
        for lo, hi in zip(at[:-1], at[1:], strict=True):
            g = t.slice(lo, hi - lo)
            asked = [np.cumsum(_unpacked(x), dtype=np.uint64) for x in g.column("keys").to_pylist()]
            _, inverse = np.unique(np.concatenate(asked), return_inverse=True)
            cuts = np.cumsum([0, *map(len, asked)])
            told = []
            for name in _COUNTED:
                own = np.concatenate([_unpacked(x) for x in g.column(name).to_pylist()])
                all_ = np.bincount(inverse, weights=own).astype(np.int64)[inverse]
                told.append(pa.array([_packed(all_[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()))
            yield pa.RecordBatch.from_arrays([g.column("chunk").combine_chunks(), g.column("bucket").combine_chunks(), *told], names=["chunk", "bucket", *_COUNTED])


def _score(prior: float, base: float, share: float, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                c = _Chunk(row)
                told = sorted(row["told"], key=lambda x: x["bucket"])
                n, m, g = (np.concatenate([_unpacked(x[k]).astype(np.int64) for x in told]) for k in _COUNTED)
                own, loss = c.own(), 0.0
                for counts, learned, sign in ((g, c.background(share), 1), (m, c.target, -1)):
                    mine = learned[c.doc].astype(np.int64)
                    loss = loss + sign * c.log_probabilities(counts, n, {k: x * mine for k, x in own.items()}, prior, base)
                mean = np.bincount(c.doc, weights=loss, minlength=c.n_docs) / (c.sizes + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], kind), pa.array(c.sizes), pa.array(mean, pa.float64(), mask=c.sizes == 0)], names=["doc_id", "n_tokens", "score"]
                )

    return run


def cross_entropy_difference(docs: DataFrame, targets: DataFrame, prior: float = 4.0, base: float = 1000.0) -> DataFrame:
    """doc_id, n_tokens, score for every row of ``docs`` (doc_id, text): the mean per-token loss under the target model minus that
    under the background model; negative: nearer to the target.

    The target model learns from rows whose doc_id is in ``targets``. The background learns from about as many words of other rows, drawn by
    their ids, or from all others where they are fewer. Neither learns from a document while it is scored, so a target document scores
    as it would if it were not in the list. Both share the vocabulary of all rows and the smoothing, and differ only in their counts: a
    bigram's share is drawn to its word's by ``prior`` counts, and a word's to its share of the whole corpus by ``base`` counts. Every token of
    a whole text counts, and its end. Texts without a token have a null score. A null doc_id is never a target; repeated ids in ``targets``
    count once; repeated rows repeat, and know each other. Empty docs give an empty result; extra columns are ignored.
    """
    field = docs.schema["doc_id"].dataType
    kind = docs.select("doc_id").limit(0).toArrow().schema.field(0).type
    plan = f"chunk long, ids array<{field.simpleString()}>, sizes array<int>, words array<long>, tokens binary"
    # chunks stay where they are: joins on them move counts only
    content = bucketed(docs.select("doc_id", "text").mapInArrow(lambda batches: _chunks(batches, kind), plan), "chunk")
    tokens = content.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    bits = int(np.ceil(np.log2(max(1.0, tokens / RANGE))))
    places = content.select("chunk", F.posexplode(F.arrays_zip("ids", "sizes")).alias("pos", "d")).select("chunk", "pos", F.col("d.ids").alias("doc_id"), F.col("d.sizes").alias("size"))
    # targets grow with the documents, so they are never broadcast
    found = places.join(targets.select("doc_id").hint("merge"), "doc_id", "left_semi")
    hits, _ = stored(found.groupBy("chunk").agg(F.collect_list("pos").alias("pos"), F.sum("size").alias("size")), "targets")
    learned = hits.agg(F.sum("size")).first()[0] or 0
    share = min(1.0, learned / max(1, tokens - learned))
    known = content.join(hits.select("chunk", "pos").hint("merge"), "chunk", "left")
    columns = ", ".join(f"{x} binary" for x in _COUNTED)
    asked = known.mapInArrow(_ask(bits, share), f"bucket int, chunk long, keys binary, {columns}")
    dealt = asked.repartition("bucket").sortWithinPartitions("bucket", "chunk")
    answers = dealt.mapInArrow(_answer, f"chunk long, bucket int, {columns}")
    told = answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", *_COUNTED)).alias("told"))
    back = known.join(told.hint("merge"), "chunk", "left")
    return back.mapInArrow(_score(prior, base, share, kind), f"doc_id {field.simpleString()}, n_tokens long, score double")
