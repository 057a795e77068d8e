"""Approximate nearest neighbours by an inverted multi-index (after Babenko and Lempitsky, 2012), for inner products."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Different vectors that train the centroids, and sampled queries on which recall is measured, at most (the fit is on bounded samples).
TRAIN_ROWS, MEASURED = 20_000, 128
#: Centroids of one half, and entries of one tile, at least and at most; both grow with the square root of the table in between.
CENTROIDS, TILE = (8, 512), (4096, 131_072)


def packed(df: DataFrame, vec_id: str, embedding: str, **more: str) -> DataFrame:
    """id, v: little-endian doubles of the vectors that take part: not null, empty or zero, all components finite.

    ``more`` names string columns to make and the columns that they are cast from. Rows with a null id are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, out = b.column(0), []
            for x in b.column(1).to_pylist():
                v = np.array([np.nan if y is None else y for y in x], dtype="<f8") if x is not None else None
                out.append(v.tobytes() if v is not None and np.isfinite(v).all() and v.any() else None)
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array(out, pa.binary()), *b.columns[2:]], names=["id", "v", *more])

    found = df.where(F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("e"), *[F.col(c).cast("string").alias(n) for n, c in more.items()])
    return found.mapInArrow(run, ", ".join(["id long", "v binary", *[f"{n} string" for n in more]])).where(F.col("v").isNotNull())


def one_length(vectors: DataFrame) -> int:
    """Components of all vectors of a packed table (0 without rows); vectors of several lengths cannot be compared and are an error."""
    least, most = vectors.agg(F.min(F.octet_length("v")), F.max(F.octet_length("v"))).first()
    if least != most:
        raise ValueError(f"vectors of {least // 8} to {most // 8} components; all must have one length")
    return (least or 0) // 8


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.stack([np.frombuffer(x, "<f8") for x in column.to_pylist()])


def _k_means(x: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(rounds):
        own = assign(x, centres)
        order = np.argsort(own, kind="stable")
        full, starts = np.unique(own[order], return_index=True)
        centres = centres.copy()
        centres[full] = np.add.reduceat(x[order], starts) / np.diff(np.append(starts, len(x)))[:, None]
    return centres


def assign(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)


def _between(value: float, bounds: tuple[int, int]) -> int:
    return int(min(bounds[1], max(bounds[0], value)))


def traverse(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, want: int) -> tuple[list[tuple[int, int]], float]:
    """Cells of the multi-index in order of summed distance until they hold ``want`` entries, and the distance of the last one.

    A heap holds, for each first centroid, the next second centroid on its sorted list.
    """
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    near, rest = first[a].tolist(), second[b].tolist()
    counts = sizes[np.ix_(a, b)].tolist()
    heap, begun, out, held, last, most = [(near[0] + rest[0], 0, 0)], 1, [], 0, -np.inf, len(rest)
    while heap and held < want:
        last, i, j = heap[0]
        if counts[i][j]:
            out.append((i, j))
            held += counts[i][j]
        if j + 1 < most:
            heapq.heapreplace(heap, (near[i] + rest[j + 1], i, j + 1))
        else:
            heapq.heappop(heap)
        if j == 0 and begun < len(near):  # the next row can only follow the first cell of this one
            heapq.heappush(heap, (near[begun] + rest[0], begun, 0))
            begun += 1
    return [(int(a[i]), int(b[j])) for i, j in out], last


def _best(scores: np.ndarray, q: np.ndarray, x: np.ndarray, ids: list[list[int]], k: int) -> list[tuple[int, float]]:
    """The ``k`` best ids of one query. Products of matrices only preselect; the kept score is a plain sum of products."""
    cut = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) > k else -np.inf
    near = np.flatnonzero((scores >= cut - 1e-9) & (scores > -np.inf))
    exact = (x[near] * q).sum(axis=1)
    found = [(-s, i) for r, s in zip(near.tolist(), exact.tolist(), strict=True) for i in ids[r]]
    return [(i, -s) for s, i in heapq.nsmallest(k, found)]


class _Index:
    """What tasks need of the index: centroids of both halves, entries of each cell, and the first and number of tiles of each first centroid."""

    def __init__(self, books: tuple[np.ndarray, np.ndarray], cells: pa.Table, tile: int):
        self.books, self.half = books, books[0].shape[1]
        self.sizes = np.zeros((len(books[0]), len(books[1])), dtype=np.int64)
        self.sizes[cells.column("c1").to_numpy(), cells.column("c2").to_numpy()] = cells.column("n").to_numpy()
        # first centroids that lie close are put on one shelf until it holds a tile's entries; a larger one has tiles of its own
        c = books[0] - books[0].mean(axis=0)
        order = np.argsort(c @ np.linalg.svd(c, full_matrices=False)[2][0], kind="stable")
        self.shelf, self.tiles = np.zeros(len(order), dtype=np.int32), np.ones(len(order), dtype=np.int32)
        at, held = 0, 0
        for i in order:
            n = int(self.sizes[i].sum())
            if held and held + n > tile:
                at, held = at + 1, 0
            self.shelf[i], self.tiles[i] = at, 1
            held += n
            if n > tile:
                self.tiles[i] = -(-n // tile)
                at, held = at + int(self.tiles[i]), 0

    def products(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.half] @ self.books[0].T, x[:, self.half :] @ self.books[1].T


def _classes(v: DataFrame, every: int, keep: int) -> DataFrame:
    """One row per different vector: h1, h2, v, asked (whether one of its ids is a query), ids (its ``keep`` smallest).

    Equal vectors are told by 128 bits of hash. Copies meet as partial sums and as the smallest ids of each task, never as rows.
    """
    keyed = v.select("id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"))
    one = keyed.groupBy("h1", "h2").agg(F.bool_or(F.pmod("id", F.lit(every)) == 0).alias("asked"), F.first("v").alias("v"))
    place = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))
    ids = keyed.select("h1", "h2", "id").distinct().withColumn("i", place).where(F.col("i") <= keep).groupBy("h1", "h2").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return one.join(ids.hint("merge"), ["h1", "h2"])


def _needed(entries: DataFrame, index: _Index, k: int, n: int) -> np.ndarray:
    """For sampled queries and each of their true neighbours: the share of all entries that a walk holds when it reaches its cell."""
    some = entries.where("asked").orderBy("h2", "h1").limit(MEASURED).select("v").toArrow()
    if not some.num_rows:
        return np.zeros(0)
    q = matrix(some.column("v"))

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((len(q), k + 1), -np.inf)
        cell = np.zeros((len(q), k + 1), dtype=np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            code = b.column(1).to_numpy().astype(np.int64) * len(index.books[1]) + b.column(2).to_numpy()
            s = np.hstack([best, q @ matrix(b.column(0)).T])
            c = np.hstack([cell, np.broadcast_to(code, (len(q), len(code)))])
            top = np.argpartition(-s, k, axis=1)[:, : k + 1]
            best, cell = np.take_along_axis(s, top, 1), np.take_along_axis(c, top, 1)
        i = np.repeat(np.arange(len(q)), k + 1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(best.ravel()), pa.array(cell.ravel())], names=["q", "s", "cell"])

    near = entries.select("v", "c1", "c2").mapInArrow(brute, "q long, s double, cell long").where(F.col("s") > float("-inf"))
    w = Window.partitionBy("q").orderBy(F.desc("s"), "cell")
    # the nearest is the query itself
    rows = near.withColumn("i", F.row_number().over(w)).where(F.col("i").between(2, k + 1)).select("q", "cell").toArrow()
    at, cell = rows.column("q").to_numpy(), rows.column("cell").to_numpy()
    a, b = index.products(q)
    out, sizes = [], index.sizes.ravel()
    for i in np.unique(at):
        order = np.argsort(-(a[i][:, None] + b[i][None, :]).ravel(), kind="stable")
        reached = np.empty(len(order))
        reached[order] = np.cumsum(sizes[order]) / n
        out.append(reached[cell[at == i]])
    return np.concatenate(out) if out else np.zeros(0)


def search(
    table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", every: int = 20, k: int = 20,
    recall: float = 0.95, portion: float | None = None, centroids: int | None = None,
) -> DataFrame:
    """query_id, rank, vec_id, score: for ids divisible by ``every``, the ``k`` found with largest inner product.

    Both halves of every vector are quantised (``centroids`` each; None: about half the square root of the number of different
    vectors). A query walks the pairs of centroids by summed distance (the negative inner product with each half) until they hold
    ``portion`` of the entries and k + 1 at least; all of these are reranked by the inner product of the original vectors in double
    precision. With ``portion`` None it is measured: the share at which the walks of sampled queries reach ``recall`` of
    their true neighbours, found by brute force. It is small where vectors form clusters and nears a half where they spread
    evenly. Ties go to the smaller id.

    Equal vectors are one entry with their smallest ids, so copies use up no walk. Entries are dealt once, in tiles; a query travels
    to the tiles that its walk meets, with the distance at which the walk ended, and is streamed past the entries. A tile
    keeps k + 1 of them per query. Copies of a query are searched once.

    Vectors that are null, empty, zero or hold null or non-finite components take no part; nor do null ids. Vectors of several
    lengths are an error. A repeated id counts once for each of its vectors and is never its own neighbour. Empty table: empty result.
    Extra columns are ignored.
    """
    v, _ = stored(packed(table, vec_id, embedding), "vectors")
    dims = one_length(v)
    if not dims:
        return v.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score"))
    spark = table.sparkSession
    classes, _ = stored(_classes(v, every, k + 1), "classes")
    n = classes.count()
    count = centroids or _between(2.0 ** round(np.log2(max(1.0, np.sqrt(n / 4)))), CENTROIDS)
    share = min(1.0, 1.2 * TRAIN_ROWS / n)
    some = classes.where(F.col("h1") <= float(-(2**63)) + share * float(2**64)).orderBy("h1", "h2").limit(TRAIN_ROWS).select("v").toArrow()
    x, half = matrix(some.column("v")), max(1, dims // 2)
    books = spark.sparkContext.broadcast((_k_means(x[:, :half], count), _k_means(x[:, half:], count) if dims > 1 else np.zeros((1, 0))))
    del x, some

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                y = matrix(b.column(2))
                c1, c2 = assign(y[:, :half], books.value[0]), assign(y[:, half:], books.value[1])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(c1.astype(np.int32)), pa.array(c2.astype(np.int32))], names=["h1", "h2", "v", "asked", "ids", "c1", "c2"])

    entries, _ = stored(classes.select("h1", "h2", "v", "asked", "ids").mapInArrow(place, "h1 long, h2 long, v binary, asked boolean, ids array<long>, c1 int, c2 int"), "entries")
    cells = entries.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n")).toArrow()  # at most centroids ** 2 rows
    index_ = _Index(books.value, cells, _between(32 * np.sqrt(n), TILE))
    if portion is None:
        needed = _needed(entries, index_, k, n)
        portion = float(np.quantile(needed, recall)) if len(needed) else 1.0
    want = max(k + 1, int(np.ceil(portion * n)))
    index = spark.sparkContext.broadcast(index_)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each query and tile on its walk, with the inner product of the last cell."""
        ix = index.value
        for b in batches:
            out: list[tuple] = []
            a, c = ix.products(matrix(b.column(2))) if b.num_rows else ([], [])
            for i, key in enumerate(zip(*[x.to_pylist() for x in b.columns], strict=True)):
                met, last = traverse(-a[i], -c[i], ix.sizes, want)
                tiles = {int(ix.shelf[c1]) + t for c1 in {c1 for c1, _ in met} for t in range(ix.tiles[c1])}
                out += [(t, *key, -last) for t in sorted(tiles)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*out, strict=True), (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.float64()), strict=True)], names=["tile", "h1", "h2", "v", "last"])

    asked = entries.where("asked").select("h1", "h2", "v").mapInArrow(walk, "tile int, h1 long, h2 long, v binary, last double")
    shelf, tiles = (F.element_at(F.array(*[F.lit(int(t)) for t in x]), F.col("c1") + 1) for x in (index_.shelf, index_.tiles))
    none = F.lit(None)
    both = entries.select((shelf + F.pmod("h2", tiles)).cast("int").alias("tile"), F.lit(0).alias("side"), "h1", "h2", "v", "c1", "c2", "ids", none.cast("double").alias("last")).unionByName(
        asked.select("tile", F.lit(1).alias("side"), "h1", "h2", "v", none.cast("int").alias("c1"), none.cast("int").alias("c2"), none.cast("array<long>").alias("ids"), "last")
    )

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Holds the entries of one tile; its queries are streamed past them."""
        ix, tile, held, made = index.value, None, [], None
        for whole in batches:
            t = whole.column("tile").to_numpy()
            sides = whole.column("side").to_numpy()
            cuts = np.flatnonzero(np.append(True, (t[1:] != t[:-1]) | (sides[1:] != sides[:-1]))) if len(t) else []
            for lo, hi in zip(cuts, [*cuts[1:], len(t)], strict=True):
                b = whole.slice(lo, hi - lo)
                if t[lo] != tile:
                    tile, held, made = t[lo], [], None
                if sides[lo] == 0:
                    held.append(b)
                    continue
                if made is None:
                    e = pa.Table.from_batches(held) if held else b.slice(0, 0)
                    made = (matrix(e.column("v")), e.column("c1").to_numpy(), e.column("c2").to_numpy(), e.column("ids").to_pylist()) if e.num_rows else ()
                    held = []
                if not made:
                    continue
                x, c1, c2, ids = made
                out: list[tuple] = []
                for i in range(0, b.num_rows, 64):
                    part = b.slice(i, 64)
                    q, a, c = matrix(part.column("v")), *ix.products(matrix(part.column("v")))
                    scores = q @ x.T
                    # the walk's cells are those at least as near as its last one
                    scores[a[:, c1] + c[:, c2] < part.column("last").to_numpy()[:, None] - 1e-9] = -np.inf
                    for r, (g, h) in enumerate(zip(part.column("h1").to_pylist(), part.column("h2").to_pylist(), strict=True)):
                        out += [(g, h, *f) for f in _best(scores[r], q[r], x, ids, k + 1)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(y) for y in zip(*out, strict=True)], names=["h1", "h2", "vec_id", "score"])

    near = both.repartition("tile").sortWithinPartitions("tile", "side").mapInArrow(rerank, "h1 long, h2 long, vec_id long, score double")
    best = Window.partitionBy("h1", "h2").orderBy(F.desc("score"), "vec_id")
    top = near.withColumn("i", F.row_number().over(best)).where(F.col("i") <= k + 1).groupBy("h1", "h2").agg(F.sort_array(F.collect_list(F.struct("i", "vec_id", "score"))).alias("found"))
    queries = v.where(F.pmod("id", F.lit(every)) == 0).select(F.col("id").alias("query_id"), F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"))
    # answers grow with the table, so they are never broadcast; the copies of a hot query are split by adaptive execution
    rows = queries.join(top.hint("merge"), ["h1", "h2"]).withColumn("found", F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k))
    rows = rows.select("query_id", F.posexplode("found").alias("i", "f"))
    return rows.select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("f.vec_id").alias("vec_id"), F.col("f.score").alias("score"))
