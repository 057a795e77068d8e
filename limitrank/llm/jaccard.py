"""N-gram Jaccard join with prefix trees.

Documents become sets of hashed word n-grams in one global order, rare ones first. Two sets that are similar enough share
an n-gram within their first few, so only those prefixes are matched across the cluster; how many they must share bounds which pairs stay
together. The groups that remain are joined exactly in prefix trees: sets that begin alike share a path, a probe
carries its overlap down the path, and a subtree is left when the elements that remain cannot reach the threshold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components_of_matrix, connected_components, drop_stored, group_starts, map_texts, possible, stored, tile_keys, values, whole_groups

#: An n-gram is frequent if it is in more than one of this many documents. Frequent ones are ordered last; there are at
#: most FREQUENT_PART times the mean set size of them, whatever the input. Which ones are frequent changes speed only.
FREQUENT_PART = 2000
#: N-grams that a counting task holds at most, twice over.
HELD = 1_000_000
#: Sets of one tile when a group is too large for one task, marks that are compared at once there, and pairs that are looked at together.
TILE, SLAB, PAIRS = 1024, 4096, 1 << 17
#: Elements by which prefixes are longer than they need be to share one, so that similar sets share as many more.
MORE = 4

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15


def _spread(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that leaves no pattern (the finaliser of splitmix64; its constants are fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random number for each place in a word and byte there; places from LONG on are hashed apart.
LONG = 64
_AT = _spread(np.arange(1, LONG * 256 + 1, dtype=np.uint64) * np.uint64(_BASE))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words between ASCII white space, A-Z lower-cased.

    The numbers of a word's bytes at their places are added up and spread; words of LONG bytes or more, which are rare, are digested whole.
    """
    b = _LOWER[np.frombuffer(text, dtype=np.uint8)]
    bounds = np.flatnonzero(np.diff(~_SPACE[b], prepend=False, append=False))
    start, end = bounds[0::2], bounds[1::2]
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    size = end - start
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    at = np.repeat(start, size) + place
    sums = np.add.reduceat(_AT[(place & (LONG - 1)) * 256 + b[at]], first)
    for i in np.flatnonzero(size >= LONG):
        word = b[start[i] : end[i]].tobytes()
        sums[i] = np.uint64(int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little"))
    return _spread(sums + size.astype(np.uint64))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``words`` words of the whole text; fewer words: one run of all; none: empty."""
    w = word_hashes((text or "").encode("utf-8", "replace"))
    n = len(w)
    if not n:
        return w
    size = min(words, n)
    out = np.full(n - size + 1, size, dtype=np.uint64)
    for k in range(size):
        out = _spread(out * np.uint64(31) + w[k : n - size + 1 + k])
    return np.unique(out)


def least_overlap(n: np.ndarray | int, m: np.ndarray | int, percent: int):
    """Smallest intersection of sets of ``n`` and ``m`` elements at which 100 * intersection >= percent * union."""
    return -(-(percent * (n + m)) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    """Elements in order among which a set shares one with any set that is similar enough."""
    return n - -(-percent * n // 100) + 1


def kept_length(n: np.ndarray | int, percent: int):
    """Elements of the prefix that is kept of a set of ``n``: ``prefix_length`` and MORE, or all there are."""
    return np.minimum(n, n + (-percent * n) // 100 + 1 + MORE)


def in_order(s: np.ndarray, frequent: np.ndarray, df: np.ndarray) -> np.ndarray:
    """``s`` in the global order: those that are not frequent by hash, then frequent ones, rarest first."""
    if not len(frequent) or not len(s):
        return s
    at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
    return s[np.lexsort((s, np.where(frequent[at] == s, df[at], 0)))]


class PrefixTree:
    """Sets of integers in a common order, kept as paths; ``link`` joins a set to all similar ones before adding it.

    Runs without branches are one node. A node knows the smallest and largest set below it and whether all sets below were
    seen to be linked together; if they are, with the probe too, nothing below can change the components.
    """

    def __init__(self, percent: int, universe: int):
        self.percent, self.universe = percent, universe
        self.parent: list[int] = []
        self.root = _Node(np.zeros(0, dtype=np.int64), 0)

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def link(self, s: np.ndarray) -> int:
        me = len(self.parent)
        self.parent.append(me)
        if len(s):
            inside = np.zeros(self.universe + 1, dtype=np.int64)
            inside[s] = 1
            self._probe(self.root, me, len(s), inside, np.cumsum(inside))
            self._add(s, me)
        return me

    def _probe(self, root: _Node, me: int, n: int, inside: np.ndarray, passed: np.ndarray) -> None:
        percent, stack = self.percent, [(root, 0)]
        visited = []
        while stack:
            node, overlap = stack.pop()
            if node.joined and self.find(node.first) == self.find(me):
                continue
            if len(node.run):
                overlap += int(inside[node.run].sum())
                # the probe's elements up to here, and those of every set below, that found no partner
                if passed[node.run[-1]] - overlap > n - least_overlap(n, node.least, percent):
                    continue
                if node.depth - overlap > node.most - least_overlap(n, node.most, percent):
                    continue
            visited.append(node)
            if node.ends and overlap >= least_overlap(n, node.depth, percent):
                for e in node.ends:
                    a, b = self.find(e), self.find(me)
                    if a != b:
                        self.parent[max(a, b)] = min(a, b)
            stack.extend((c, overlap) for c in node.children.values())
        for node in reversed(visited):
            if not node.joined:
                top = self.find(node.first) if node.first >= 0 else -1
                node.joined = all(c.joined and self.find(c.first) == top for c in node.children.values()) and all(self.find(e) == top for e in node.ends)

    def _add(self, s: np.ndarray, me: int) -> None:
        node, at, n = self.root, 0, len(s)
        while True:
            node.joined = False
            node.least, node.most = min(node.least, n), max(node.most, n)
            if node.first < 0:
                node.first = me
            if at == n:
                node.ends.append(me)
                return
            child = node.children.get(int(s[at]))
            if child is None:
                new = _Node(s[at:], n)
                new.first, new.least, new.most = me, n, n
                new.ends.append(me)
                new.joined = True
                node.children[int(s[at])] = new
                return
            k = min(len(child.run), n - at)
            differ = np.flatnonzero(child.run[:k] != s[at : at + k])
            same = int(differ[0]) if len(differ) else k
            if same < len(child.run):
                upper = _Node(child.run[:same], child.depth - len(child.run) + same)
                upper.first, upper.least, upper.most, upper.joined = child.first, child.least, child.most, child.joined
                child.run = child.run[same:]
                upper.children[int(child.run[0])] = child
                node.children[int(s[at])] = upper
                child = upper
            node, at = child, at + same


class _Node:
    __slots__ = ("children", "depth", "ends", "first", "joined", "least", "most", "run")

    def __init__(self, run: np.ndarray, depth: int):
        self.run, self.depth = run, depth
        self.children: dict[int, _Node] = {}
        self.ends: list[int] = []
        self.first, self.least, self.most, self.joined = -1, 1 << 60, 0, False


def tree_components(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Component (smallest position) of each set under similarity, by a prefix tree. Sets hold hashes in any order.

    Within the group elements are ordered by how many sets hold them, most first, so that like sets share long paths.
    """
    held = [s for s in sets if len(s)]
    if not held:
        return np.arange(len(sets))
    names, df = np.unique(np.concatenate(held), return_counts=True)
    rank = np.empty(len(names), dtype=np.int64)
    rank[np.lexsort((names, -df))] = np.arange(len(names))
    tree = PrefixTree(percent, len(names))
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), i))
    for i in order:
        tree.link(np.sort(rank[np.searchsorted(names, sets[i])]))
    smallest: dict[int, int] = {}
    for k, i in enumerate(order):
        root = tree.find(k)
        smallest[root] = min(smallest.get(root, i), i)
    out = np.arange(len(sets))
    for k, i in enumerate(order):
        out[i] = smallest[tree.find(k)]
    return out


def _frequent(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent n-grams and their counts, sorted by hash. Tasks count all their documents and report what is common in them.

    A task reports an n-gram held by at least one in twice FREQUENT_PART of its documents (two at least), so sums may fall short
    of true counts; the order is the same for all documents in any case, which is all that correctness needs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, df, total, waiting, held = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), 0, [], 0

        def merged():
            u, at = np.unique(np.concatenate([names, *waiting]), return_inverse=True)
            return u, np.bincount(at, weights=np.concatenate([df, np.ones(len(at) - len(names))]), minlength=len(u)).astype(np.int64)

        for b in batches:
            for text in values(b.column(0)):
                s = shingles(text, words)
                total += 1
                waiting.append(s)
                held += len(s)
                if held > HELD:
                    names, df = merged()
                    if len(names) > HELD:  # bounded memory: what is rare so far starts again from zero
                        names, df = names[df > 1], df[df > 1]
                    waiting, held = [], 0
        if waiting:
            names, df = merged()
        often = df >= max(2, total / (2 * FREQUENT_PART))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(names[often].view(np.int64), 0)), pa.array(np.append(df[often], 0)), pa.array(np.append(np.zeros(int(often.sum()), np.int64), total))],
            names=["gram", "df", "docs"],
        )

    part = map_texts(docs.select("text"), run, "gram long, df long, docs long")
    part, path = stored(part.groupBy("gram").agg(F.sum("df").alias("df"), F.sum("docs").alias("docs")), "grams")
    total = part.agg(F.sum("docs")).first()[0] or 0
    t = part.where(F.col("df") >= max(2, total / FREQUENT_PART)).select("gram", "df").toArrow()
    drop_stored(docs.sparkSession, path)
    names = t.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(names)
    return names[order], t.column("df").to_numpy()[order]


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text) with an id.

    Rows link when 100 * intersection >= percent * union of their sets of word n-grams (``shingles``); component_id is the
    smallest id reachable by links, itself included. Null and empty texts and texts of white space have an empty set and link
    with nothing. N-grams are compared by 64-bit hashes and whole sets by 128 bits. A null id is left out; a repeated id is
    one document with the links of all its rows. Empty docs give an empty result. Extra columns are ignored.

    Equal sets are joined to one class first. A prefix element held by one class is dropped; those
    with the same holders are counted as one mark. Marks bring classes together (``_likely_pairs`` connects the plain cases before), and of each such group only a forest of the pairs that share enough of their prefixes is kept (a pair
    that is similar shares at least that many). What meets by chance alone is left out first (``_with_partners``), and most marks send out pairs, not
    lists (``_meetings``). Classes connected that way are read once more, whole, and joined in prefix trees. Groups above ``TILE`` are cut into tiles that meet pairwise. Work tables are written to the shared folder, and removed once
    no later step reads them; prefixes are the largest. Of the texts only those of connected classes are dealt again (``possible``).
    """
    spark = docs.sparkSession
    docs = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    common = spark.sparkContext.broadcast(_frequent(docs, words))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, df = common.value
        for b in batches:
            n, one, two, prefix, rare = [], [], [], [], []
            for text in values(b.column(1)):
                s = shingles(text, words)
                n.append(len(s))
                one.append(int(s.sum(dtype=np.uint64)))
                two.append(int(_spread(s ^ np.uint64(_BASE)).sum(dtype=np.uint64)))
                prefix.append(in_order(s, frequent, df)[: kept_length(len(s), percent)].view(np.int64) if len(s) else np.zeros(0, np.int64))
                rare.append(min(len(prefix[-1]), len(s) - int(np.isin(s, frequent, assume_unique=True).sum())))
            at = np.cumsum([0, *map(len, prefix)])
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate(prefix) if prefix else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int32()), pa.array(np.array(one, dtype=np.uint64).view(np.int64)), pa.array(np.array(two, dtype=np.uint64).view(np.int64)), lists, pa.array(rare, pa.int32())],
                names=["doc_id", "n", "one", "two", "prefix", "rare"],
            )

    prefixes, prefixes_at = stored(map_texts(docs, sets, "doc_id long, n int, one long, two long, prefix array<long>, rare int"), "sets")
    known, _ = stored(prefixes.drop("prefix", "rare"), "known")
    same = ["n", "one", "two"]
    class_of, _ = stored(known.where("n > 0").groupBy(*same).agg(F.min("doc_id").alias("class_id")), "classes")
    # every class's prefix comes from the row that names it
    firsts = prefixes.where("n > 0").join(class_of.withColumnRenamed("class_id", "doc_id"), [*same, "doc_id"], "left_semi")
    posts = firsts.select(F.col("doc_id").alias("id"), "n", "rare", F.posexplode("prefix").alias("i", "gram")).withColumn("often", F.col("i") >= F.col("rare"))
    # holders of frequent n-grams are summed in each task first and their totals sent to all, as there is a bound on how many are frequent;
    # in the window they are spread, so that no n-gram meets in one task whole
    def holders(over=None) -> dict:
        made = {"first": F.min("id"), "last": F.max("id"), "n_ids": F.count(F.lit(1)), "all": F.bit_xor(F.xxhash64("id"))}
        return {k: c.over(over) if over is not None else c for k, c in made.items()}

    common_posts = prefixes.where("n > 0").select(F.col("doc_id").alias("id"), F.explode(F.slice("prefix", F.col("rare") + 1, F.greatest(F.size("prefix") - F.col("rare"), F.lit(0)))).alias("gram"))
    totals = common_posts.groupBy("gram").agg(*[c.alias(f"t_{k}") for k, c in holders().items()])
    spread = F.when(F.col("often"), F.pmod(F.xxhash64("id"), F.lit(997))).otherwise(0)
    held = posts.withColumn("spread", spread).withColumns(holders(Window.partitionBy("gram", "spread")))
    held = held.join(F.broadcast(totals), F.col("often") & (held.gram == totals.gram), "left")
    held = held.select("id", "n", *[F.when(F.col("often"), F.col(f"t_{k}")).otherwise(F.col(k)).alias(k) for k in holders()])
    # elements with the same holders bring the same classes together, so they are one mark that counts as many; marks are 32 bits, as lists
    # of them travel once per mark: where two agree by chance, their classes meet once more and no pair is lost
    marks = held.where("first <> last").groupBy("id", "n", F.hash("first", "last", "n_ids", "all").alias("mark")).agg(F.count(F.lit(1)).cast("int").alias("times"))
    marks, made_at = stored(marks, "marks")
    drop_stored(spark, prefixes_at)
    first, first_at = stored(_likely_pairs(marks, percent), "likely")
    grouped = connected_components(first).withColumnRenamed("node", "id")
    # a mark whose holders are all connected already adds nothing; the others are all looked at
    marks = marks.join(grouped.hint("merge"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    marks, grouped_at = stored(marks.select("id", "n", "mark", "times", "component"), "marks")
    # a sum and a join, which adaptive execution can split where a mark is hot
    apart = marks.groupBy("mark").agg(F.min("component").alias("first"), F.max("component").alias("last")).where("first <> last").select("mark")
    marks, marks_at = stored(marks.join(apart.hint("merge"), "mark", "left_semi").select("id", "n", "mark", "times", "component"), "marks")
    drop_stored(spark, made_at, grouped_at)
    # what is left by chance goes before anything travels by mark
    hot = lambda d: tile_keys(d.groupBy("mark").agg(F.count(F.lit(1)).alias("n")), ["mark"], TILE)
    fewer, fewer_at = stored(_with_partners(marks, hot(marks), percent), "marks")
    drop_stored(spark, marks_at)
    met, met_at = stored(_meetings(fewer, hot(fewer), percent), "met")
    shared = met.where("other is not null").groupBy("id", "other", "least").agg(F.sum("times").alias("shared")).where("shared >= least")
    own = fewer.groupBy("id", "n").agg(F.collect_list("mark").alias("marks"), F.collect_list("times").alias("times"))
    entries = own.join(met.where("other is null").select("id", "mark"), "id")
    pairs = map_texts(_grouped(entries, hot(fewer), "mark"), _prefix_forest(percent), "a long, b long")
    pairs = pairs.unionByName(shared.select(F.col("id").alias("a"), F.col("other").alias("b")))
    forest, forest_at = stored(pairs.unionByName(first).distinct(), "forest")
    groups = connected_components(forest).withColumnRenamed("node", "doc_id")
    drop_stored(spark, fewer_at, met_at, first_at, forest_at)
    # the groups grow with the documents, so they are never broadcast, at any size
    members = possible(docs, "doc_id", groups).join(groups.hint("merge"), "doc_id").select("component", F.col("doc_id").alias("id"), "text")
    large = tile_keys(groups.groupBy("component").agg(F.count(F.lit(1)).alias("n")), ["component"], TILE)
    links = map_texts(_grouped(members, large, "component"), _exact_links(words, percent), "a long, b long")
    found, _ = stored(links.distinct(), "links")
    # rows of one id with several sets connect their classes
    ids = known.where("n > 0").join(class_of, same).select("doc_id", "class_id")
    edges = found.unionByName(ids.where("doc_id <> class_id").select(F.col("doc_id").alias("a"), F.col("class_id").alias("b")))
    component = connected_components(edges).withColumnRenamed("node", "doc_id")
    out = known.select("doc_id", F.col("n").cast("long").alias("n_shingles")).join(component, "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _likely_pairs(marks: DataFrame, percent: int, sketch: int = 8) -> DataFrame:
    """Pairs (a, b) that are worth connecting before any pair is compared: each class with the smallest one that shares half of a
    sketch of its marks and, of all its marks, as many as similar sets do. Only classes take part that share enough of their prefixes for
    similarity to one of their own size.

    This spares later work in large families of copies. It decides nothing: all pairs that it leaves apart are still
    compared, and what it connects is verified with the rest.
    """
    by_id = Window.partitionBy("id")
    enough = F.lit(100) * F.sum("times").over(by_id) >= F.lit(40) * (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)
    some = marks.withColumns({"enough": enough, "i": F.row_number().over(by_id.orderBy("mark"))}).where(F.col("enough") & (F.col("i") <= sketch))
    some = some.withColumn("k", F.count(F.lit(1)).over(by_id)).select("id", "mark", "k")
    hubs = some.groupBy("mark").agg(F.min("id").alias("hub"))
    met = some.join(hubs, "mark").where("id <> hub").groupBy("id", "hub").agg(F.count(F.lit(1)).alias("n"), F.first("k").alias("k"))
    met = met.where("2 * n >= k").select("id", "hub")
    # whole marks of both, as large groups that only chance connects would be read whole
    hub = marks.select(F.col("id").alias("hub"), F.col("n").alias("m"), "mark", F.col("times").alias("t"))
    both = met.join(marks.select("id", "n", "mark", "times"), "id").join(hub, ["hub", "mark"]).groupBy("id", "hub", "n", "m").agg(F.sum(F.greatest("times", "t")).alias("shared"))
    need, left = (lambda x: F.ceil(F.lit(percent) * x / F.lit(100 + percent))), (lambda x: F.greatest(F.lit(0), F.ceil(x * percent / 100) - 1 - MORE))
    n, m = F.col("n"), F.col("m")
    both = both.where((F.least(n, m) >= need(n + m)) & (F.col("shared") >= need(n + m) - F.greatest(left(n), left(m))))
    return both.select(F.col("id").alias("a"), F.col("hub").alias("b"))


def _may_be_similar(t: pa.Table, keys: list[str], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers a, b of rows in one group of ``t`` (n, w, component) and how many prefix elements they share if they are similar.

    Two classes are similar only if neither is too small for the other and both have marks enough (w) for what such sets share; those of one
    component need not meet. PAIRS at a time.
    """
    starts = group_starts(t, keys)
    n, w, component = (t.column(k).to_numpy() for k in ("n", "w", "component"))
    first, size = (np.repeat(x, np.diff(starts)) for x in (starts[:-1], np.diff(starts)))
    upto, lo = np.cumsum(size), 0
    while lo < t.num_rows:  # some rows at a time, each with all of its group
        hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] - size[lo] + PAIRS, side="right")))
        a = np.repeat(np.arange(lo, hi), size[lo:hi])
        b = np.arange(len(a)) - np.repeat(upto[lo:hi] - size[lo:hi] - upto[lo] + size[lo] - first[lo:hi], size[lo:hi])
        apart = component[a] != component[b]
        a, b = a[apart], b[apart]
        n_a, n_b = n[a].astype(np.int64), n[b].astype(np.int64)
        least = _shared_least(n_a, n_b, percent)
        ok = (np.minimum(n_a, n_b) >= least_overlap(n_a, n_b, percent)) & (np.minimum(w[a], w[b]) >= least)
        yield a[ok], b[ok], least[ok]
        lo = hi


def _with_partners(marks: DataFrame, hot: DataFrame, percent: int) -> DataFrame:
    """Rows of ``marks`` (id, n, mark, times, component) that another class holding the mark may need (``_may_be_similar``).

    A similar pair that is apart passes at each mark that it shares, so none is lost and its marks stay whole.
    """
    names = ["id", "n", "mark", "times", "component"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, KEYS):
            met = np.zeros(t.num_rows, dtype=bool)
            for a, _, _ in _may_be_similar(t, KEYS, percent):
                met[a] = True
            if met.any():
                yield from t.select(["id", "n", "key", "times", "component"]).filter(pa.array(met)).rename_columns(names).to_batches()

    d = marks.withColumn("w", F.sum("times").over(Window.partitionBy("id")))
    # a row of a hot mark is in several pairs of tiles
    return map_texts(_grouped(d, hot, "mark"), run, "id long, n int, mark int, times int, component long").dropDuplicates(["id", "n", "mark"])


def _meetings(marks: DataFrame, hot: DataFrame, percent: int) -> DataFrame:
    """How the classes of each mark meet: as pairs (id, other, mark, times, least), or as rows (id, mark) without other to which lists of marks travel.

    A mark's pairs are written out where they are smaller than the lists of its classes, which is so for all but marks of many. Hot marks are never written
    out. A pair that meets in rows anywhere is counted there by whole lists, and any other meets in pairs at each mark that it shares.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["mark"]):
            a, b, least = (np.concatenate(x) for x in zip(*_may_be_similar(t, ["mark"], percent), strict=True))
            ids, mark, times = (t.column(k).to_numpy() for k in ("id", "mark", "times"))
            group = np.repeat(np.arange(len(s := group_starts(t, ["mark"])) - 1), np.diff(s))
            lists = np.bincount(group, weights=t.column("k").to_numpy())
            # a pair is three numbers of 64 bits, as both directions are here; an element of a list is one
            in_rows = 1.5 * np.bincount(group[a], minlength=len(lists)) > lists
            met = np.zeros(t.num_rows, dtype=bool)
            met[a] = True
            row = np.flatnonzero(met & in_rows[group])
            pair = (a < b) & ~in_rows[group[a]]
            a, b, least, none = a[pair], b[pair], least[pair], np.zeros(len(row), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([ids[a], ids[row]])), pa.array(np.concatenate([ids[b], none]), mask=np.arange(len(a) + len(row)) >= len(a)), pa.array(np.concatenate([mark[a], mark[row]])),
                 pa.array(np.concatenate([np.maximum(times[a], times[b]), times[row]])), pa.array(np.concatenate([least, none]).astype(np.int32))],
                names=["id", "other", "mark", "times", "least"],
            )

    of = Window.partitionBy("id")
    d = marks.withColumns({"w": F.sum("times").over(of), "k": F.count(F.lit(1)).over(of)}).join(hot, "mark", "left_anti")
    d = d.select("id", "n", "mark", "times", "component", "w", "k").repartition("mark").sortWithinPartitions("mark", "id")
    met = map_texts(d, run, "id long, other long, mark int, times int, least int")
    always = marks.join(hot, "mark", "left_semi").select("id", F.lit(None).cast("long").alias("other"), "mark", "times", F.lit(0).alias("least"))
    return met.unionByName(always)


def _grouped(rows: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Rows dealt by ``key`` and, where a key is hot, by pairs of tiles; sorted so that groups are contiguous."""
    d = rows.join(hot, key, "left").withColumn("n_tiles", F.coalesce("n_tiles", F.lit(1)))
    d = d.withColumn("tile", F.pmod(F.xxhash64("id"), F.col("n_tiles")).cast("int"))
    d = d.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1)))
    d = d.withColumns({"ti": F.least("tile", "other"), "tj": F.greatest("tile", "other")}).drop("n_tiles", "other")
    return d.repartition(key, "ti", "tj").sortWithinPartitions(key, "ti", "tj", "id").withColumnRenamed(key, "key")


KEYS = ["key", "ti", "tj"]


def _prefix_forest(percent: int):
    """For classes that share a mark: a forest of the pairs that share as many prefix elements as similarity asks for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, KEYS):
            starts = group_starts(t, KEYS)
            ids, n = t.column("id").to_numpy(), t.column("n").to_numpy().astype(np.int64)
            marks = t.column("marks").combine_chunks()
            offsets, named = marks.offsets.to_numpy(), marks.values.to_numpy()
            times = t.column("times").combine_chunks().values.to_numpy()
            out_a, out_b = [], []
            for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                m = hi - lo
                size = n[lo:hi]
                if m < 2:
                    continue
                of = slice(offsets[lo], offsets[hi])
                row = np.repeat(np.arange(m), np.diff(offsets[lo : hi + 1]))
                names, col, df = np.unique(named[of], return_inverse=True, return_counts=True)
                both = df[col] > 1  # the others are shared with classes elsewhere
                weight = np.zeros(len(names), dtype=np.float32)
                np.maximum.at(weight, col, times[of])
                place = np.cumsum(df > 1) - 1
                weight, row, col = weight[df > 1], row[both], place[col[both]]
                order = np.argsort(col, kind="stable")
                row, col = row[order], col[order]
                shared = np.zeros((m, m), dtype=np.float32)
                for first in range(0, len(weight), SLAB):  # marks a slab at a time, so that memory does not grow with their number
                    one, two = np.searchsorted(col, [first, first + SLAB])
                    held = np.zeros((m, min(SLAB, len(weight) - first)), dtype=np.float32)
                    held[row[one:two], col[one:two] - first] = 1
                    shared += (held * weight[first : first + SLAB]) @ held.T
                linked = (shared >= _shared_least(size[:, None], size[None, :], percent)) & (np.minimum.outer(size, size) >= least_overlap(size[:, None], size[None, :], percent))
                np.fill_diagonal(linked, False)
                if linked.any():
                    root = components_of_matrix(linked)
                    away = np.flatnonzero(root != np.arange(m))
                    out_a.append(ids[lo:hi][away])
                    out_b.append(ids[lo:hi][root[away]])
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], names=["a", "b"])

    return run


def _shared_least(n, m, percent: int):
    """Elements that the prefixes of two similar sets of ``n`` and ``m`` elements share at least.

    The prefix that ends first in the order lacks at most n - overlap of its elements in the other set, and what it shares lies in the
    other's prefix too; which of the two ends first is not known here, so the weaker bound holds.
    """
    need = least_overlap(n, m, percent)
    return np.maximum(1, need - np.maximum(n - kept_length(n, percent), m - kept_length(m, percent)))


def _exact_links(words: int, percent: int):
    """For whole texts of a group: pairs that connect each document with the smallest of its component under similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, KEYS):
            starts = group_starts(t, KEYS)
            ids, texts = t.column("id").to_numpy(), t.column("text")
            a, b = [], []
            for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                root = tree_components([shingles(x, words) for x in texts.slice(lo, hi - lo).to_pylist()], percent)
                for i in np.flatnonzero(root != np.arange(hi - lo)):
                    a.append(int(ids[lo + i]))
                    b.append(int(ids[lo + root[i]]))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run
