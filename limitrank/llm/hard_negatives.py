"""Hard-negative mining by a multiway hyperplane tree in the manner of GNAT (Brin, 1995), with exact leaves.

Scores are integer inner products. One more coordinate makes all rows equally long (M), and then the distance of a row from an anchor
falls as their score grows: d^2 = |q|^2 + M^2 - 2 * score. So "scores between two numbers" is an annulus around the anchor, and a tree for
distances serves. Each node has split points; a row belongs to the nearest one, and for each pair of split points the node knows
the range of distances from one of them to the rows of the other. A subtree is left out where such a range misses what the annulus allows.

The tree is fitted on a bounded sample and holds every row. It stays small (at most MOST_LEAVES leaves), so tasks get it whole; rows never do
more than lie in their leaf, and anchors travel to the leaves that the tree leaves over, where scores are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Split points of a node, leaves of the tree, and rows of the sample that it is fitted on, at most.
FAN, MOST_LEAVES, SAMPLE = 16, 4096, 20_000
#: Rows that a task holds of a leaf: as many as a leaf aims at, within these bounds. Anchors whose best rows it holds, and scores at once, at most.
SLICE, HELD, SCORES = (512, 65_536), 20_000, 4_000_000
#: A leaf aims at this many times the root of the number of rows, so that leaves and anchors' ways grow alike.
LEAF_ROOTS = 2.0

_NEVER = -(2**62)


@dataclass
class Node:
    points: np.ndarray
    children: list  # Node, or the number of a leaf
    number: int
    near: np.ndarray = field(default=None)
    far: np.ndarray = field(default=None)


@dataclass
class Tree:
    """``longest``: M^2; ``slack``: more than rounding can do to a distance."""

    root: Node | int
    nodes: list[Node]
    n_leaves: int
    longest: float
    slack: float

    def raised(self, x: np.ndarray) -> np.ndarray:
        """Rows with the coordinate that makes them equally long."""
        return np.column_stack([x, np.sqrt(np.maximum(self.longest - (x * x).sum(1), 0))])

    def leaves(self, x: np.ndarray, seen=None) -> np.ndarray:
        """Leaf of each row of ``x`` (raised); ``seen`` gets (node, split point of each row, distances) on the way."""
        out = np.zeros(len(x), dtype=np.int32)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not isinstance(node, Node):
                out[rows] = node
            elif len(rows):
                d = _distances(x[rows], node.points)
                mine = d.argmin(1)
                if seen is not None:
                    seen(node, mine, d)
                todo += [(c, rows[mine == j]) for j, c in enumerate(node.children)]
        return out

    def left_over(self, q: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Whether each leaf may hold rows in any of the annuli ``near`` to ``far`` (one column for each, empty where near > far) around
        each of the points ``q``: a matrix of points and leaves."""
        out = np.zeros((len(q), self.n_leaves), dtype=bool)
        todo = [(self.root, np.flatnonzero((near <= far).any(1)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if not isinstance(node, Node):
                out[rows, node] = True
                continue
            d = _distances(q[rows], node.points)[:, None, :]
            a, b = near[rows][:, :, None], far[rows][:, :, None]
            least = np.maximum(np.maximum(a - d, d - b), 0) - self.slack
            most = d + b + self.slack
            alive = np.empty((len(rows), len(node.children)), dtype=bool)
            for j in range(len(node.children)):
                meets = ((least <= node.far[:, j]) & (most >= node.near[:, j])).all(2)
                # a row of a cell is nearer to its split point than to any other
                beyond = d[:, :, j] - d.min(2) > 2 * b[:, :, 0] + 2 * self.slack
                alive[:, j] = (meets & ~beyond & (a <= b)[:, :, 0]).any(1)
            todo += [(c, rows[alive[:, j]]) for j, c in enumerate(node.children)]
        return out


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * x @ y.T, 0))


def fit_tree(sample: np.ndarray, longest: float, n_leaves: int) -> Tree:
    """A tree of about ``n_leaves`` leaves. Split points are rows of a node's sample, chosen greedily far apart among three times as many."""
    tree = Tree(0, [], 0, float(longest), 1e-6 * (float(longest) ** 0.5 + 1))
    x = tree.raised(sample)
    levels = max(1, int(np.ceil(np.log(max(n_leaves, 2)) / np.log(FAN))))
    fan = max(2, int(np.ceil(n_leaves ** (1 / levels)))) if n_leaves > 1 else 1
    chance = np.random.default_rng(7)

    def grow(rows: np.ndarray, level: int):
        picked = chance.permutation(rows)[: 3 * fan]
        chosen = picked[:1]
        while level and len(chosen) and len(chosen) < fan:
            d = _distances(x[picked], x[chosen]).min(1)
            if d.max() <= tree.slack:
                break
            chosen = np.append(chosen, picked[d.argmax()])
        if len(chosen) < 2 or not level:
            tree.n_leaves += 1
            return tree.n_leaves - 1
        node = Node(x[chosen], [], len(tree.nodes))
        tree.nodes.append(node)
        mine = _distances(x[rows], node.points).argmin(1)
        node.children = [grow(rows[mine == j], level - 1) for j in range(len(chosen))]
        return node

    tree.root = grow(np.arange(len(x)), levels if fan > 1 else 0)
    for node in tree.nodes:
        m = len(node.children)
        node.near, node.far = np.full((m, m), np.inf), np.full((m, m), -np.inf)
    return tree


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    """Rows of packed int32 as doubles, shorter ones filled up with zeros."""
    out = np.zeros((len(column), d))
    for i, b in enumerate(column.to_pylist()):
        x = np.frombuffer(b, "<i4")
        out[i, : len(x)] = x
    return out


def quantised(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """vec_id, label, anchor, v (floor(scale * x) of each component as packed int32), norm2 of the rows that take part.

    Rows with a null id or label, or a vector that is null or holds a null or a component that is not finite, take no part; nor do those
    whose squared length passes 2**62, as scores are 64-bit integers.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, packed, norms = [], [], []
            for i, x in enumerate(b.column(3)):
                if not x.is_valid or x.values.null_count:
                    continue
                x = np.floor(scale * x.values.to_numpy(zero_copy_only=False).astype(np.float64))
                n = float((x * x).sum())
                if n < 2.0**62:  # false for what is not finite
                    keep.append(i)
                    packed.append(x.astype("<i4").tobytes())
                    norms.append(int((x.astype(np.int64) ** 2).sum()))
            b = b.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(packed, pa.binary()), pa.array(norms, pa.int64())], names=["vec_id", "label", "anchor", "v", "norm2"])

    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "anchor", F.col("embedding").cast("array<double>"))
    return rows.mapInArrow(run, "vec_id long, label long, anchor boolean, v binary, norm2 long")


class Index:
    """The rows of ``rows`` (vec_id, label, v, norm2) in the leaves of a tree.

    Of rows with equal label and vector only those with the ``ties`` smallest ids are held: they have one score whatever the anchor and ties go
    to smaller ids, so no other of them can be among the first ``ties``. Copies of one vector thus cost nothing.
    """

    def __init__(self, rows: DataFrame, ties: int):
        w = Window.partitionBy("label", "v").orderBy("vec_id")
        few = rows.select("vec_id", "label", "v", "norm2").withColumn("__n", F.dense_rank().over(w)).where(F.col("__n") <= ties).drop("__n")
        few, _ = stored(few.dropDuplicates(["label", "v", "vec_id"]), "negatives")
        longest, size = rows.agg(F.max("norm2"), F.max(F.octet_length("v"))).first()
        n = few.count()
        self.d = d = (size or 0) // 4
        sample = few.orderBy(F.xxhash64("v", "vec_id")).limit(SAMPLE).select("v").toArrow().column(0).combine_chunks()
        self.tree = tree = fit_tree(_matrix(sample, d), longest or 0, int(min(MOST_LEAVES, np.ceil(n / max(1.0, LEAF_ROOTS * n**0.5)))) if n else 1)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.append_column("leaf", pa.array(tree.leaves(tree.raised(_matrix(b.column(2), d)))))

        self.rows, _ = stored(few.mapInArrow(assign, "vec_id long, label long, v binary, norm2 long, leaf int"), "negatives")

        def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = {}

            def seen(node, mine, dist):
                lo, hi = found.setdefault(node.number, (np.full(node.near.shape, np.inf), np.full(node.near.shape, -np.inf)))
                for j in np.unique(mine):
                    lo[:, j] = np.minimum(lo[:, j], dist[mine == j].min(0))
                    hi[:, j] = np.maximum(hi[:, j], dist[mine == j].max(0))

            for b in batches:
                tree.leaves(tree.raised(_matrix(b.column(0), d)), seen)
            for node, (lo, hi) in found.items():
                at = np.flatnonzero(np.isfinite(lo.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), node, np.int32)), pa.array(at.astype(np.int32)), pa.array(lo.ravel()[at]), pa.array(hi.ravel()[at])], names=["node", "pair", "near", "far"])

        # as many rows as the tree has pairs of split points
        for r in self.rows.select("v").mapInArrow(ranges, "node int, pair int, near double, far double").groupBy("node", "pair").agg(F.min("near").alias("near"), F.max("far").alias("far")).collect():
            node = tree.nodes[r.node]
            node.near.ravel()[r.pair], node.far.ravel()[r.pair] = r.near, r.far
        self.slices = np.zeros(tree.n_leaves, dtype=np.int64)
        size = int(min(SLICE[1], max(SLICE[0], LEAF_ROOTS * n**0.5)))
        for r in self.rows.groupBy("leaf").count().collect():
            self.slices[r.leaf] = -(-r["count"] // size)

    def best(self, anchors: DataFrame, k: int, same_label: bool) -> DataFrame:
        """anchors (c, label, v, norm2, least, most: lists of scores) with the first ``k`` rows of each window: c, w, place, score, vec_id, twin.

        ``same_label``: whether rows of the anchor's label or of others count. The leaf in which an anchor lies is searched first; its
        k-th score, where there is one, is from then on the least that counts.
        """
        home = self._top(self._probe(self._routed(anchors, True), k, same_label), k)
        least = home.groupBy("c", "w").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("s")).where(F.col("n") == k)
        least = least.groupBy("c").agg(F.map_from_entries(F.collect_list(F.struct("w", "s"))).alias("found"))
        raised = F.transform("least", lambda x, i: F.greatest(x, F.coalesce(F.element_at("found", i), x)))
        closer = anchors.join(least.hint("merge"), "c", "left").withColumn("least", F.when(F.col("found").isNull(), F.col("least")).otherwise(raised)).drop("found")
        return self._top(self._probe(self._routed(closer, False), k, same_label), k)

    def _routed(self, anchors: DataFrame, home: bool) -> DataFrame:
        """A row of each anchor for each slice of the leaves that it must visit."""
        tree, d, slices = self.tree, self.d, self.slices

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(0, b.num_rows, 256):
                    part = b.slice(i, 256)
                    x = _matrix(part.column(2), d)
                    q = np.column_stack([x, np.zeros(len(x))])
                    if home:
                        ways = [[leaf] for leaf in tree.leaves(q).tolist()]
                    else:
                        size = np.array([len(w) for w in part.column(4).to_pylist()])
                        lo, hi = np.full((len(x), max(1, size.max())), 1.0), np.full((len(x), max(1, size.max())), 0.0)
                        for into, column in ((lo, part.column(4)), (hi, part.column(5))):
                            for row, w in enumerate(column.to_pylist()):
                                into[row, : len(w)] = w
                        base = (np.array(part.column(3).to_pylist(), dtype=np.float64) + tree.longest)[:, None]
                        near, far = np.sqrt(np.maximum(base - 2 * hi, 0)), np.sqrt(np.maximum(base - 2 * lo, 0))
                        far[lo > hi], near[lo > hi] = -1, 0
                        ways = [np.flatnonzero(row).tolist() for row in tree.left_over(q, near, far)]
                    to = [[{"leaf": leaf, "slice": s} for leaf in way for s in range(slices[leaf])] for way in ways]
                    yield part.append_column("to", pa.array(to, pa.list_(pa.struct([("leaf", pa.int32()), ("slice", pa.int32())]))))

        rows = anchors.select("c", "label", "v", "norm2", "least", "most")
        to = rows.mapInArrow(run, "c long, label long, v binary, norm2 long, least array<long>, most array<long>, to array<struct<leaf:int,slice:int>>")
        return to.select(F.explode("to").alias("to"), "c", "label", "v", "norm2", "least", "most").select("to.leaf", "to.slice", F.lit(1).alias("kind"), F.col("c").alias("id"), "label", "v", "norm2", "least", "most")

    def _probe(self, routed: DataFrame, k: int, same_label: bool) -> DataFrame:
        """c, w, score, vec_id, twin: the first ``k`` of each window among the rows that a task holds; anchors stream past each slice."""
        d, n = self.d, F.element_at(F.array(*[F.lit(int(s)) for s in self.slices]), F.col("leaf") + 1)
        none = F.lit(None).cast("array<long>")
        held = self.rows.select("leaf", F.pmod(F.xxhash64("vec_id", "label"), n).cast("int").alias("slice"), F.lit(0).alias("kind"), F.col("vec_id").alias("id"), "label", "v", "norm2", none.alias("least"), none.alias("most"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, parts, tile, best = None, [], None, {}
            for b in batches:
                t = pa.Table.from_batches([b])
                keys = np.column_stack([t.column(c).to_numpy() for c in ("leaf", "slice", "kind")])
                cuts = np.append(np.flatnonzero(np.any(np.diff(keys, axis=0, prepend=-1), axis=1)), len(keys))
                for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    if at != tuple(keys[lo, :2]):
                        at, parts, tile = tuple(keys[lo, :2]), [], None
                    part = t.slice(lo, hi - lo).combine_chunks()
                    if keys[lo, 2] == 0:
                        parts.append(part)
                    elif parts:
                        tile = tile or _Tile(pa.concat_tables(parts), d)
                        tile.look(part, best, k, same_label, d)
                        if len(best) > HELD:
                            yield _rows(best)
                            best = {}
            yield _rows(best)

        dealt = held.unionByName(routed).repartition("leaf", "slice").sortWithinPartitions("leaf", "slice", "kind")
        return dealt.mapInArrow(run, "c long, w int, score long, vec_id long, twin boolean")

    @staticmethod
    def _top(found: DataFrame, k: int) -> DataFrame:
        w = Window.partitionBy("c", "w").orderBy(F.desc("score"), "vec_id", "twin")
        return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


class _Tile:
    """A slice of a leaf: its rows by id."""

    def __init__(self, rows: pa.Table, d: int):
        rows = rows.sort_by("id").combine_chunks()
        self.ids, self.labels, self.norms = (rows.column(c).to_numpy() for c in ("id", "label", "norm2"))
        self.x = _matrix(rows.column("v").combine_chunks(), d)

    def look(self, anchors: pa.Table, best: dict, k: int, same_label: bool, d: int) -> None:
        step = max(1, SCORES // len(self.ids))
        for i in range(0, anchors.num_rows, step):
            self._look(anchors.slice(i, step), best, k, same_label, d)

    def _look(self, anchors: pa.Table, best: dict, k: int, same_label: bool, d: int) -> None:
        q, norms, labels = _matrix(anchors.column("v").combine_chunks(), d), anchors.column("norm2").to_numpy(), anchors.column("label").to_numpy()
        if float(norms.max()) ** 0.5 * float(self.norms.max()) ** 0.5 < 2.0**53:
            s = (q @ self.x.T).astype(np.int64)  # every partial sum is a whole number that doubles hold
        else:
            s = q.astype(np.int64) @ self.x.astype(np.int64).T
        s[(labels[:, None] == self.labels[None, :]) != same_label] = _NEVER - 1
        for i, (c, least, most) in enumerate(zip(anchors.column("id").to_pylist(), anchors.column("least").to_pylist(), anchors.column("most").to_pylist(), strict=True)):
            had = [best.get((c, w), []) for w in range(len(least))]
            least = [max(lo, -h[-1][0]) if len(h) == k else lo for lo, h in zip(least, had, strict=True)]
            asked = [lo for lo, hi in zip(least, most, strict=True) if lo <= hi]
            if not asked:
                continue
            # few rows pass what has been found so far; ties stay in the order of ids
            rows = np.flatnonzero(s[i] >= min(asked))
            rows = rows[np.argsort(-s[i, rows], kind="stable")]
            down = -s[i, rows]
            for w, (lo, hi) in enumerate(zip(least, most, strict=True)):
                first = int(np.searchsorted(down, -hi))
                new = [(int(x), int(self.ids[r]), bool(-x == norms[i] == self.norms[r])) for x, r in zip(down[first : first + k], rows[first : first + k], strict=True) if -x >= lo]
                if new:
                    best[c, w] = sorted(had[w] + new)[:k]


def _rows(best: dict) -> pa.RecordBatch:
    rows = [(c, w, -s, i, t) for (c, w), found in best.items() for s, i, t in found]
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)], names=["c", "w", "score", "vec_id", "twin"])


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for ``vectors`` (vec_id, label, embedding).

    A score is the inner product of floor(scale * x). An anchor's positives are its first other rows of its label, by score, then smaller id.
    For each, its negatives are the first rows of other labels with low * positive_score <= 100 * negative_score <= high * positive_score. A
    negative of several positives of an anchor is returned for each.

    See ``quantised`` for rows that take no part. Rows equal in id, label and vector are one row; of rows that share an id only, each is a
    row of its own. Shorter vectors count as filled up with zeros. Equal anchors are searched for together. Fewer rows than asked for
    give all there are; no rows give no rows. Extra columns are ignored.
    """
    rows, _ = stored(quantised(vectors.withColumn("anchor", F.coalesce(is_anchor, F.lit(False))), scale), "negatives")
    index = Index(rows, max(positives + 1, negatives))
    wanted = rows.where("anchor").select("vec_id", "label", "v", "norm2").distinct()
    classes, _ = stored(wanted.select("label", "v", "norm2").distinct().withColumn("c", F.monotonically_increasing_id()), "negatives")
    every = [F.array(F.lit(x).cast("long")) for x in (_NEVER, -_NEVER)]
    # one more than asked for, as an anchor is no positive of its own
    near, _ = stored(index.best(classes.withColumns({"least": every[0], "most": every[1]}), positives + 1, True), "negatives")
    listed = near.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score", "twin"))).alias("near"))
    floor = lambda f, s: F.floor(s * f / F.lit(100).cast("decimal(3,0)")).cast("long")
    windows = {
        "least": F.transform("near", lambda p: -floor(F.lit(-low).cast("decimal(4,0)"), p["score"].cast("decimal(20,0)"))),
        "most": F.transform("near", lambda p: floor(F.lit(high).cast("decimal(4,0)"), p["score"].cast("decimal(20,0)"))),
    }
    asked, _ = stored(classes.join(listed.hint("merge"), "c").withColumns(windows), "negatives")
    other = index.best(asked, negatives, False).groupBy("c", "w").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("other"))
    other = other.groupBy("c").agg(F.map_from_entries(F.collect_list(F.struct("w", "other"))).alias("other"))
    told = asked.join(other.hint("merge"), "c").select("label", "v", F.transform("near", lambda p, i: F.struct(p["vec_id"].alias("id"), p["score"].alias("score"), p["twin"].alias("twin"), F.element_at(F.col("other"), i).alias("other"))).alias("near"))
    mine = wanted.select(F.col("vec_id").alias("anchor_id"), "label", "v").join(told.hint("merge"), ["label", "v"])
    own = F.filter("near", lambda p: ~(p["twin"] & (p["id"] == F.col("anchor_id"))))
    each = mine.select("anchor_id", F.explode(F.slice(own, 1, positives)).alias("p"))
    out = each.select("anchor_id", F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"), F.explode("p.other").alias("n"))
    return out.select("anchor_id", "positive_id", F.col("n.place").cast("int").alias("rank"), F.col("n.vec_id").alias("negative_id"), "positive_score", F.col("n.score").alias("negative_score"))
