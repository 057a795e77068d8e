"""Embedding near-duplicates by a subspace pigeonhole join.

Unit vectors with cosine c are at squared distance 2 - 2c. After a rotation the coordinates are cut into blocks; a pair within
the whole distance is, in one block at least, within that block's share of the squared distance. Each block is range-joined
in a grid of cells, on byte-sized coordinates whose rounding is added to the budgets. The union of what the blocks find is verified exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ann import matrix, one_length, packed
from .common import components_of_matrix, connected_components, group_starts, stored, tile_keys, whole_groups

#: Rows of a tile of whole vectors, and of one of ids and bytes; rows of the sample that places the cuts of cells.
TILE, HELD, SAMPLE_ROWS = 2048, 8192, 16_384
#: Added to squared-distance budgets so that rounding loses no pair; what it lets through is verified.
SLACK = 1e-5


def rotation(dims: int, seed: int = 7) -> np.ndarray:
    """A fixed random rotation, which spreads the distance of any pair over all blocks."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow for very large components
    return x / np.sqrt((x**2).sum(axis=1, keepdims=True))


class Grid:
    """Cells of one block's space: each coordinate is cut at quantiles of a sample, and the number of cells doubles ``depth`` times.

    ``home`` gives a row's cell, ``reach`` all cells that a ball may touch.
    """

    def __init__(self, sample: np.ndarray, depth: int):
        dims = sample.shape[1]
        spread = np.argsort(-sample.var(axis=0), kind="stable") if len(sample) else np.arange(dims)
        halvings = np.bincount(spread[np.arange(depth) % dims], minlength=dims)
        self.cuts = [np.quantile(sample[:, d], np.arange(1, 2**h) / 2**h) if h and len(sample) else np.zeros(0) for d, h in enumerate(halvings)]

    def reach(self, y: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cells for all cells within ``radius`` of each row of ``y`` along every coordinate."""
        rows, cell = np.arange(len(y)), np.zeros(len(y), dtype=np.int64)
        for d, cuts in enumerate(self.cuts):
            if not len(cuts):
                continue
            low, high = np.searchsorted(cuts, y[rows, d] - radius, "right"), np.searchsorted(cuts, y[rows, d] + radius, "right")
            n = high - low + 1
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            rows, cell = np.repeat(rows, n), np.repeat(cell * (len(cuts) + 1) + low, n) + step
        return rows, cell

    def home(self, y: np.ndarray) -> np.ndarray:
        cell = np.zeros(len(y), dtype=np.int64)
        for d, cuts in enumerate(self.cuts):
            if len(cuts):
                cell = cell * (len(cuts) + 1) + np.searchsorted(cuts, y[:, d], "right")
        return cell


class _Forest:
    """Edges that connect the rows of a held tile and whatever is linked to them; no edge is given twice for what is connected already."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.root, self.edges = ids, np.arange(len(ids)), []

    def add(self, node: int, linked: np.ndarray) -> None:
        roots = np.unique(self.root[linked])
        if node != self.ids[roots[0]]:
            self.edges.append((node, int(self.ids[roots[0]])))
        if len(roots) > 1:
            self.edges += [(int(self.ids[r]), int(self.ids[roots[0]])) for r in roots[1:]]
            self.root[np.isin(self.root, roots)] = roots[0]


def near_duplicates(
    table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    threshold: float = 0.98, blocks: int = 8, leaf_rows: int = 8192,
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``table`` with an id.

    Rows link when their labels are equal and not null and their cosine in double precision is at least ``threshold``.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, as does a
    null label; they are kept. Vectors of several lengths are an error. Rows with equal vectors and label are joined first and counted, so
    thousands of copies cost one row in the join; a repeated id is one row for each vector and its rows are reported once each. A null id is
    left out. Empty table: empty result. Extra columns are ignored.

    In each block a row goes to its own cell and, as a probe, to the other cells within reach; only ids and one byte per
    coordinate travel. A task holds the rows of a cell (cut into tiles that meet pairwise where it is crowded) and streams the probes past
    them. It keeps pairs that are near in the block and, by all bytes, may be within the whole distance, and returns a forest
    of them. Whole vectors are then dealt once, by the groups that the blocks found, and every pair of a group is verified; tasks
    return sums of links and a forest, never the pairs themselves. No bound cuts candidates.
    """
    spark = table.sparkSession
    budget = max(0.0, 2 - 2 * threshold)
    rows, _ = stored(packed(table.where(F.col(label).isNotNull()), vec_id, embedding, label=label).distinct(), "vectors")
    dims = one_length(rows)
    every = table.where(F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("id"))
    if not dims:
        return every.select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    blocks = min(blocks, dims)
    classes, _ = stored(rows.groupBy("label", "v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")), "classes")
    most = classes.groupBy("label").agg(F.count(F.lit(1)).alias("c")).agg(F.max("c")).first()[0]
    depth = int(max(0, np.ceil(np.log2(most / leaf_rows))))
    turn = rotation(dims)
    edges_of = np.linspace(0, dims, blocks + 1).astype(int)
    share = [budget * (hi - lo) / dims for lo, hi in zip(edges_of[:-1], edges_of[1:], strict=True)]
    bound = min(1.0, 2 * SAMPLE_ROWS / classes.count())
    some = classes.where(F.xxhash64("id") <= float(-(2**63)) + bound * float(2**64)).orderBy(F.xxhash64("id"), "v").limit(SAMPLE_ROWS).select("v").toArrow() if depth else None
    sample = unit(matrix(some.column("v"))) @ turn if some is not None and some.num_rows else np.zeros((0, dims))
    grids = spark.sparkContext.broadcast([Grid(sample[:, lo:hi], depth) for lo, hi in zip(edges_of[:-1], edges_of[1:], strict=True)])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (block, cell, probe) of every vector with its coordinates as bytes and their unit."""
        for b in batches:
            if not b.num_rows:
                continue
            y = unit(matrix(b.column(1))) @ turn
            step = np.maximum(np.abs(y).max(axis=1), 1e-30) / 127
            code = pa.array([x.tobytes() for x in np.rint(y / step[:, None]).astype(np.int8)], pa.binary())
            for k, grid in enumerate(grids.value):
                part = y[:, edges_of[k] : edges_of[k + 1]]
                own = grid.home(part)
                at, cell = grid.reach(part, np.sqrt(share[k]) + SLACK)
                away = cell != own[at]
                take = np.concatenate([np.arange(len(part)), at[away]])
                where, probe = np.concatenate([own, cell[away]]), np.arange(len(take)) >= len(part)
                yield pa.RecordBatch.from_arrays(
                    [*[x.take(pa.array(take)) for x in (b.column(0), b.column(2), code, pa.array(step.astype(np.float32)))], pa.array(np.full(len(take), k, np.int8)), pa.array(where), pa.array(probe)],
                    names=["label", "id", "code", "step", "block", "cell", "probe"],
                )

    cell_keys = ["label", "block", "cell"]
    dealt = classes.select("label", "v", "id").mapInArrow(deal, "label string, id long, code binary, step float, block byte, cell long, probe boolean")
    # counted without the codes
    hot = tile_keys(dealt.where(~F.col("probe")).groupBy(*cell_keys).agg(F.count(F.lit(1)).alias("n")), cell_keys, HELD) if most > HELD else None
    tiled = dealt.withColumn("n_tiles", F.lit(1)) if hot is None else dealt.join(hot, cell_keys, "left").withColumn("n_tiles", F.coalesce("n_tiles", F.lit(1)))
    own = F.pmod(F.xxhash64("id"), F.col("n_tiles")).cast("int")
    # held rows meet all tiles of their cell, probes pass by each tile once
    pairs = F.transform(F.sequence(F.lit(0), F.col("n_tiles") - 1), lambda t: F.when(F.col("probe"), F.struct(t.alias("ti"), t.alias("tj"))).otherwise(F.struct(F.least(t, own).alias("ti"), F.greatest(t, own).alias("tj"))))
    tiled = tiled.withColumn("own", own).withColumn("pair", F.explode(pairs))
    tiled = tiled.select(F.xxhash64(*cell_keys, "pair").alias("key"), "block", F.when(F.col("probe"), F.lit(2)).otherwise((F.col("own") != F.col("pair.ti")).cast("int")).cast("byte").alias("side"), F.col("pair.ti").alias("ti"), F.col("pair.tj").alias("tj"), "label", "cell", "id", "code", "step")

    def coordinates(b: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        step = b.column("step").to_numpy()
        return np.stack([np.frombuffer(x, np.int8) for x in b.column("code").to_pylist()]).astype(np.float32) * step[:, None], step

    def near(k: int, p: np.ndarray, ps: np.ndarray, q: np.ndarray, qs: np.ndarray) -> np.ndarray:
        """Pairs within the block's share, and by all coordinates within the budget, when rounding is allowed for."""
        lo, hi = edges_of[k], edges_of[k + 1]
        off = (float(ps.max()) + float(qs.max())) / 2
        def within(a: np.ndarray, b: np.ndarray, whole: float) -> np.ndarray:
            bound = (np.sqrt(whole) + off * np.sqrt(a.shape[1])) ** 2 + SLACK
            return (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a @ b.T <= bound

        out = within(p[:, lo:hi], q[:, lo:hi], share[k])
        r, c = np.flatnonzero(out.any(axis=1)), np.flatnonzero(out.any(axis=0))
        if len(r):
            out[np.ix_(r, c)] &= within(p[r], q[c], budget)
        return out

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["key", "label", "block", "cell", "ti", "tj"]
        current, held, forest, x, step, sides = None, [], None, None, None, None
        for whole in batches:
            cuts = group_starts(pa.Table.from_batches([whole]), [*keys, "side"]) if whole.num_rows else [0]
            made: list[tuple[int, int]] = []
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                b = whole.slice(lo, hi - lo)
                key, side = tuple(b.column(k)[0].as_py() for k in keys), b.column("side")[0].as_py()
                if key != current:
                    if held:
                        made += _held(held)
                    current, held, forest = key, [], None
                if side < 2:
                    held.append(b)
                    continue
                if held:
                    t = pa.Table.from_batches(held)
                    made += _held(held)
                    forest, (x, step), held = _Forest(t.column("id").to_numpy()), coordinates(t), []
                if forest is None:
                    continue
                for i in range(0, b.num_rows, 256):
                    part = b.slice(i, 256)
                    ids = part.column("id").to_numpy()
                    linked = near(key[2], *coordinates(part), x, step) & (ids[:, None] > forest.ids[None, :])
                    for r in np.flatnonzero(linked.any(axis=1)):
                        forest.add(int(ids[r]), np.flatnonzero(linked[r]))
                made += forest.edges
                forest.edges = []
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in zip(*made, strict=True)], names=["a", "b"])
        if held and (made := _held(held)):
            yield pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in zip(*made, strict=True)], names=["a", "b"])

    def _held(held: list[pa.RecordBatch]) -> list[tuple[int, int]]:
        """Pairs among the held rows: of the one tile, or between the two."""
        t = pa.Table.from_batches(held)
        ids, side, k = t.column("id").to_numpy(), t.column("side").to_numpy(), t.column("block")[0].as_py()
        (y, s), forest = coordinates(t), _Forest(ids)
        two = t.column("ti")[0].as_py() != t.column("tj")[0].as_py()
        for i in range(0, len(ids), 512):
            j = min(len(ids), i + 512)
            linked = near(k, y[i:j], s[i:j], y, s)
            linked &= (side[i:j, None] < side[None, :]) if two else (np.arange(i, j)[:, None] < np.arange(len(ids))[None, :])
            for r in np.flatnonzero(linked.any(axis=1)):
                forest.add(int(ids[i + r]), np.append(np.flatnonzero(linked[r]), i + r))
        return forest.edges

    ordered = tiled.repartition("key").sortWithinPartitions("key", "label", "block", "cell", "ti", "tj", "side")
    likely, _ = stored(ordered.mapInArrow(join, "a long, b long").where("a <> b").distinct(), "likely")
    groups = connected_components(likely).withColumnRenamed("node", "id")
    # groups grow with the table, so they are never broadcast; ids are those of classes, and one id may name several
    members = classes.join(groups.hint("merge"), "id")
    large = tile_keys(members.groupBy("component").agg(F.count(F.lit(1)).alias("n")), ["component"], TILE)
    m = members.join(large, "component", "left").withColumn("n_tiles", F.coalesce("n_tiles", F.lit(1)))
    m = m.withColumn("own", F.pmod(F.xxhash64("v"), F.col("n_tiles")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1)))
    m = m.select("component", F.least("own", "other").alias("ti"), F.greatest("own", "other").alias("tj"), (F.col("own") > F.col("other")).cast("int").alias("second"), "label", F.xxhash64("v").alias("h"), "id", "n", "v")
    parts = ["component", "ti", "tj"]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, parts):
            out: list[tuple] = []
            at = group_starts(t, parts)
            for lo, hi in zip(at[:-1], at[1:], strict=True):
                g = t.slice(lo, hi - lo)
                ids, n, names, x = g.column("id").to_numpy(), g.column("n").to_numpy(), np.array(g.column("label").to_pylist()), unit(matrix(g.column("v")))
                second = g.column("second").to_numpy()
                two = g.column("ti")[0].as_py() != g.column("tj")[0].as_py()
                links = (x @ x.T >= threshold) & (names[:, None] == names[None, :])
                if two:
                    links &= second[:, None] != second[None, :]
                np.fill_diagonal(links, False)
                if not links.any():
                    continue
                out.append((ids, ids, g.column("h").to_numpy(), links @ n))
                # rows of one id are told apart by their vectors, but stand for one document
                uniq, where = np.unique(ids, return_inverse=True)
                square = np.zeros((len(uniq), len(uniq)), dtype=bool)
                i, j = np.nonzero(links)
                square[where[i], where[j]] = True
                np.fill_diagonal(square, False)
                root = uniq[components_of_matrix(square)]
                away = root != uniq
                out.append((uniq[away], root[away], np.zeros(int(away.sum()), np.int64), np.zeros(int(away.sum()), np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["a", "b", "h", "n"])

    found, _ = stored(m.repartition(*parts).sortWithinPartitions(*parts, "second", "id", "h").mapInArrow(verify, "a long, b long, h long, n long"), "links")
    sums = found.where("a = b").groupBy(F.col("a").alias("class_id"), "h").agg(F.sum("n").alias("others"))
    comps = connected_components(found.where("a <> b")).withColumnRenamed("node", "class_id")
    per_class = classes.select("label", F.xxhash64("v").alias("h"), F.xxhash64(F.lit(1), "v").alias("h2"), F.col("id").alias("class_id"), "n")
    per_class = per_class.join(sums, ["class_id", "h"], "left").join(comps, "class_id", "left")
    per_class = per_class.select("label", "h", "h2", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "class_id").alias("component_id"))
    mine = rows.select("id", "label", F.xxhash64("v").alias("h"), F.xxhash64(F.lit(1), "v").alias("h2")).join(per_class, ["label", "h", "h2"]).select("id", "n_links", "component_id")
    out = every.join(mine, "id", "left").select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
