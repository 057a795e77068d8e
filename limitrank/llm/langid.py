"""Language identification by the nearest of several centroids per language over hashed TF-IDF n-gram vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_stored, map_texts, stored, values

#: Buckets of hashed n-grams, longest n-gram in bytes, and training rows per language at most (the fit is on a bounded sample).
DIMS, LONGEST, ROWS_PER_LANGUAGE = 4096, 3, 600
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
#: Bytes to bytes: A-Z to lower case, and every other ASCII byte that is no letter to a space.
_FOLD = np.array([32 if b < 128 and not chr(b).isalpha() else (b | 32 if b < 128 else b) for b in range(256)], dtype=np.uint8)
_MULTIPLIERS = (2654435761, 2246822519, 3266489917)  # odd numbers, to spread n-grams over buckets


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def counts(text: str) -> np.ndarray:
    """Counts of hashed n-grams of 1 to ``LONGEST`` bytes over the whole lower-cased text."""
    b = _FOLD[np.frombuffer((" " + text.lower() + " ").encode("utf-8", "replace"), dtype=np.uint8)].astype(np.uint32)
    total, key = np.zeros(DIMS, dtype=np.int64), np.zeros(len(b), dtype=np.uint32)
    for n, m in zip(range(1, LONGEST + 1), _MULTIPLIERS, strict=True):
        if len(b) < n:
            break
        key = (key[: len(b) - n + 1] * np.uint32(31) + b[n - 1 :] + np.uint32(1)) * np.uint32(m)
        total += np.bincount(key >> np.uint32(20), minlength=DIMS)
    return total


@dataclass
class LanguageModel:
    """``centroids`` are unit rows with the language of each in ``owner``; texts nearer than ``reject_below`` to none are rejected."""

    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    reject_below: float

    def vector(self, text: str) -> np.ndarray:
        v = np.log1p(counts(text)) * self.idf
        size = np.sqrt(v @ v)
        return v / size if size else v

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine to its nearest centroid (0 to 1), and whether the text is rejected."""
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        near = self.centroids @ self.vector(text)
        best = int(near.argmax())
        score = float(min(1.0, max(0.0, near[best])))
        return self.languages[self.owner[best]], score, score < self.reject_below


def _clusters(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Unit centres of spherical k-means, begun from spread-out rows."""
    rng = np.random.default_rng(seed)
    centres = x[[int(rng.integers(len(x)))]]
    while len(centres) < min(k, len(x)):
        centres = np.vstack([centres, x[int((x @ centres.T).max(axis=1).argmin())]])
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        new = np.stack([x[own == j].mean(axis=0) if (own == j).any() else centres[j] for j in range(len(centres))])
        new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
        if np.allclose(new, centres):
            break
        centres = new
    return centres


def fit(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, per_language: int = 4, margin: float = 0.5) -> LanguageModel:
    """Learn from the rows of ``docs`` (text, lang) with a language and a letter in the text.

    The sample is the same on every run: the ``rows_per_language`` different texts of a language with the smallest hashes. Rows
    above a hash bound that keeps about twice as many different texts are left out before they are sorted, so a language may
    hold any share of the table and any number of copies. Every labelled language is learned. ``reject_below`` is ``margin`` times the cosine that all but
    one in a hundred sampled texts of 20 letters or more reach. No usable row: a model that rejects everything.

    Texts are counted, and each language is clustered, in tasks; the driver gets document frequencies of DIMS buckets and a few
    centroids per language (16 KB each).
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", F.xxhash64("text").alias("h"))
    sizes = known.select("lang", "h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = F.least(F.lit(1.0), F.lit(2.0 * rows_per_language + 200) / F.col("n"))
    bound = (F.lit(float(-(2**63))) + share * float(2**64)).alias("bound")
    near = known.join(F.broadcast(sizes.select("lang", bound)), "lang").where(F.col("h") <= F.col("bound")).groupBy("lang", "h").agg(F.min("text").alias("text"))
    top = near.withColumn("i", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))).where(F.col("i") <= rows_per_language)

    def to_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, n = [], []
            for x in values(b.column(2)):  # one text's full vector at a time
                c = counts(x)
                used = np.flatnonzero(c)
                at.append(used.astype("<u4").tobytes())
                n.append(c[used].astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at, pa.binary()), pa.array(n, pa.binary())], names=["lang", "h", "at", "n"])

    rows, path = stored(map_texts(top.select("lang", "h", "text"), to_counts, "lang string, h long, at binary, n binary"), "texts")

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIMS + 1, dtype=np.int64), 0
        for b in batches:
            for x in b.column(0).to_pylist():
                df[np.frombuffer(x, "<u4")] += 1
            n += b.num_rows
        df[DIMS] = n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMS + 1)), pa.array(df)], names=["at", "n"])

    sums = rows.select("at").mapInArrow(presence, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(DIMS + 1, dtype=np.int64)
    if sums.num_rows:
        df[sums.column("at").to_numpy()] = sums.column("n").to_numpy()
    if not df[DIMS]:
        return LanguageModel([], np.ones(DIMS), np.zeros((0, DIMS)), np.zeros(0, dtype=int), 1.0)
    idf = np.log((1 + df[DIMS]) / (1 + df[:DIMS])) + 1

    def centres(group: pa.Table) -> pa.Table:
        """Centroids of one language, and how near its longer texts (or all, without longer ones) lie to them."""
        group = group.sort_by("h")
        x = np.zeros((group.num_rows, DIMS), dtype=np.float32)
        for i, (at, n) in enumerate(zip(group.column("at").to_pylist(), group.column("n").to_pylist(), strict=True)):
            x[i, np.frombuffer(at, "<u4")] = np.frombuffer(n, "<u4")
        long = x.sum(axis=1) >= 3 * 20
        np.log1p(x, out=x)
        x *= idf.astype(np.float32)
        x /= np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), 1e-12)[:, None]
        c = _clusters(x, per_language, seed=0)
        near = (x @ c.T).max(axis=1)
        kinds = (pa.string(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64()))
        row = (group.column("lang")[0].as_py(), c.astype("<f4").tobytes(), near[long].tolist(), near[~long].tolist())
        return pa.Table.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=["lang", "centres", "near", "short"])

    # a group is one language's sample, at most `rows_per_language` texts; a language comes back as its centroids
    made = rows.groupBy("lang").applyInArrow(centres, "lang string, centres binary, near array<double>, short array<double>").toArrow().sort_by("lang")
    drop_stored(docs.sparkSession, path)
    parts = [np.frombuffer(x, "<f4").reshape(-1, DIMS).astype(np.float64) for x in made.column("centres").to_pylist()]
    near, short = (np.array([y for x in made.column(c).to_pylist() for y in x]) for c in ("near", "short"))
    usual = float(np.quantile(near if len(near) else short, 0.01))
    return LanguageModel(made.column("lang").to_pylist(), idf, np.vstack(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts]), margin * usual)


def classify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected; columns of these names are replaced, all others pass through.

    Whole texts are read. Texts that are null or have no letter get ``und``, score 0, and are rejected; others get the language
    of the nearest centroid, its cosine as score, and are rejected when that is below the model's bound. The model (a few
    hundred kilobytes) is sent to the tasks; rows are independent, so repeated rows agree and nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    made = {"lang_pred": "string", "score": "double", "rejected": "boolean"}
    kept = [c for c in docs.columns if c not in made]
    at = docs.columns.index(text)
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema
    for name, kind in made.items():
        schema = schema.add(name, kind)
    keep_at = [docs.columns.index(c) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shared.value.predict(x) for x in values(b.column(at))]
            new = [pa.array([f[i] for f in found], type=t) for i, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in keep_at], *new], names=[*kept, *made])

    return map_texts(docs, run, schema)


def crc_fold(doc_id: Column, folds: int = 4) -> Column:
    """Remainder that deals documents into folds: crc32 of the id as text."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))
