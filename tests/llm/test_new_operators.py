"""Operators 11 to 13 against brute force, and their edge cases: nulls, empty tables, ties, repeated rows, hot groups, clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from limitrank.llm import hard_negatives, recompress, resample


# 11
def test_xxhash_of_slices():
    chance = random.Random(1)
    data = bytes(chance.randrange(256) for _ in range(3000)) + bytes(8)
    start = np.array([chance.randrange(2000) for _ in range(2000)])
    size = np.array([chance.randrange(1, 80) for _ in range(2000)])
    assert resample.xxhash64(data, start, size).tolist() == [xxhash.xxh64_intdigest(data[a : a + n]) for a, n in zip(start.tolist(), size.tolist(), strict=True)]


@pytest.mark.parametrize("collide", [False, True])
def test_slots_tell_bytes_apart(monkeypatch, collide):
    """Also where every key is the same, so that only the bytes tell slices apart."""
    if collide:
        monkeypatch.setattr(resample, "xxhash64", lambda data, start, size: np.full(len(start), 7, dtype=np.uint64))
    monkeypatch.setattr(resample, "SLAB", 16)
    words = [random.Random(i).choice(["a", "b", "ab", "ba", "abcdefgh", "abcdefghi", "abcdefgi", "x" * 40, "x" * 41, f"w{i % 30}"]) for i in range(300)]
    data, start, size, _, _ = resample._features([" ".join(words).encode()], 1, 2)
    table = resample.NgramTable(data)
    slots = table.intern(start, size)
    made = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    seen = defaultdict(set)
    for s, w in zip(slots.tolist(), made, strict=True):
        seen[s].add(w)
    assert all(len(x) == 1 for x in seen.values()) and len(seen) == len(set(made)) == table.used
    assert {seen[s].pop(): int(table.count[s]) for s in list(seen)} == Counter(made)


def resampled_by_hand(docs, target, least, most, buckets, percent, least_words):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    grams = lambda w: [" ".join(w[i : i + n]) for n in range(least, most + 1) for i in range(len(w) - n + 1)]
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = (Counter(bucket(g) for _, x in rows for g in grams(words(x))) for rows in (docs, target))
    n, m = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n + buckets) / ((s[b] + 1) * (m + buckets))))
    out = []
    for i, x in docs:
        g = grams(words(x))
        w = sum(gain(bucket(y)) for y in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(words(x)), len(g), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= least_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, -r[3], -r[2]))
    rank = {id(r): k + 1 for k, r in enumerate(able[: len(able) * percent // 100])}
    return sorted(((r[0], r[2], r[3], r[4], rank.get(id(r))) for r in out), key=repr)


@pytest.mark.parametrize(("least", "most", "size"), [(1, 1, 8_000_000), (1, 3, 50), (2, 2, 1)])
def test_resampling_against_brute_force(spark, monkeypatch, least, most, size):
    monkeypatch.setattr(resample, "TABLE_BYTES", size)
    chance = random.Random(2)
    some = ["The", "cat", "ÉTÉ", "été", "дом", "a1", "x" * 50, "Z"]
    docs = [(i, " ".join(chance.choice(some) for _ in range(chance.randrange(0, 40)))) for i in range(120)]
    docs += [(120 + i, "same same same same words") for i in range(60)] + [(5, docs[5][1]), (None, "the cat the cat"), (7, None), (8, ""), (9, "-- __ \x7f"), (10, "long " * 30000)]
    target = [(1, "the cat the cat été"), (2, None)]
    got = resample.resample(
        spark.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit("x"), "rank": F.lit(1)}).repartition(3),
        spark.createDataFrame(target, "item_id long, text string"), (least, most), 97, 25, 3)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == resampled_by_hand(docs, target, least, most, 97, 25, 3)


def test_resampling_of_nothing(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert resample.resample(d.limit(0), d).count() == 0
    assert [r.rank for r in resample.resample(d, d.limit(0), percent=100, least_words=1).collect()] == [1]


# 12
def negatives_by_hand(rows, positives, negatives):
    """rows: (id, label, vector, anchor) that take part, each once."""
    v = [(i, y, [math.floor(256 * float(np.float32(x))) for x in e], a) for i, y, e, a in rows]
    score = lambda a, b: sum(x * y for x, y in zip(a, b))  # noqa: E731  shorter ones end early, as if filled up with zeros
    out = []
    for i, y, e, a in v:
        if not a:
            continue
        others = [(-score(e, f), j, z) for j, z, f, _ in v if not (j == i and z == y and f == e)]
        for s, j, _ in sorted(x for x in others if x[2] == y)[:positives]:
            near = sorted((t, k) for t, k, z in others if z != y and 50 * -s <= 100 * -t <= 95 * -s)[:negatives]
            out += [(i, j, n + 1, k, -s, -t) for n, (t, k) in enumerate(near)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame([(i, y, e, a) for i, y, e, a in rows], "vec_id long, label int, embedding array<float>, wanted boolean").withColumns({"c": F.lit(1), "leaf": F.lit("x"), "score": F.lit(0)})


@pytest.mark.parametrize(("shape", "slice_", "held"), [("sphere", (512, 65_536), 20_000), ("sphere", (7, 9), 3), ("clusters", (16, 16), 20_000), ("hot", (16, 40), 50)])
def test_negatives_against_brute_force(spark, monkeypatch, shape, slice_, held):
    monkeypatch.setattr(hard_negatives, "SLICE", slice_)
    monkeypatch.setattr(hard_negatives, "HELD", held)
    monkeypatch.setattr(hard_negatives, "SCORES", held)
    chance = np.random.default_rng(5)
    n = 400
    x = chance.normal(size=(n, 6))
    if shape == "clusters":
        x = chance.normal(size=(12, 6))[chance.integers(0, 12, n)] * 3 + chance.normal(size=(n, 6)) * 0.3
    if shape == "hot":
        x[: n // 3] = x[0]  # a third of all rows are one vector, under two labels
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    rows = [(i, int(chance.integers(0, 4)) if shape != "hot" or i >= n // 3 else i % 2, x[i].tolist(), i % 10 == 0) for i in range(n)]
    rows += [(1000, 1, x[3].tolist()[:3], True), (1001, 2, [], True), (1002, 1, [0.0] * 6, True), (10, 3, x[9].tolist(), True)]
    odd = [(2000, None, x[1].tolist(), True), (2001, 1, None, True), (2002, 1, [1.0, None] + [0.0] * 4, True), (2003, 1, [float("nan")] * 6, True), (2004, 1, [float("inf")] * 6, False), (None, 1, x[2].tolist(), True), rows[20]]
    got = hard_negatives.hard_negatives(vectors(spark, rows + odd).repartition(3), F.col("wanted"))
    assert sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()) == negatives_by_hand(rows, 5, 3)


def test_negatives_of_large_numbers_and_of_nothing(spark):
    rows = [(1, 0, [3e4, 1.0], True), (2, 0, [3e4, 2.0], False), (3, 1, [2.8e4, 1.0], False), (4, 1, [2.8e4, 3.0], False), (5, 1, [1e30, 0.0], False)]
    got = hard_negatives.hard_negatives(vectors(spark, rows), F.col("wanted"))
    assert sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()) == negatives_by_hand(rows[:4], 5, 3)
    empty = hard_negatives.hard_negatives(vectors(spark, rows).limit(0), F.col("wanted"))
    assert empty.count() == 0
    assert hard_negatives.hard_negatives(vectors(spark, rows), F.lit(None).cast("boolean")).count() == 0


def test_the_tree_leaves_out_what_it_may(spark):
    """Annuli of clustered points leave few leaves over, and never one that holds a point within."""
    chance = np.random.default_rng(1)
    x = np.floor(256 * (chance.normal(size=(40, 16))[chance.integers(0, 40, 2000)] * 2 + 0.05 * chance.normal(size=(2000, 16))))
    tree = hard_negatives.fit_tree(x[:1000], (x * x).sum(1).max(), 30)
    raised = tree.raised(x)
    assert np.allclose((raised * raised).sum(1), tree.longest)

    def seen(node, mine, d):
        for j in np.unique(mine):
            node.near[:, j] = np.minimum(node.near[:, j], d[mine == j].min(0))
            node.far[:, j] = np.maximum(node.far[:, j], d[mine == j].max(0))

    leaf = tree.leaves(raised, seen)
    q = x[::50]
    d = hard_negatives._distances(np.column_stack([q, np.zeros(len(q))]), raised)
    near, far = np.sort(d, 1)[:, [0]] * 0.999, np.sort(d, 1)[:, [20]]
    over = tree.left_over(np.column_stack([q, np.zeros(len(q))]), near, far)
    for i in range(len(q)):
        assert over[i, leaf[(d[i] >= near[i, 0]) & (d[i] <= far[i, 0])]].all()
    assert over.mean() < 0.5 and tree.n_leaves > 10


# 13
def removed_by_hand(rows, window):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    key = lambda i, w: (i is None, i or 0, recompress._digest(" ".join(w).encode()))
    first = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            at = (key(i, w), k)
            first[tuple(w[k : k + window])] = min(first.get(tuple(w[k : k + window]), at), at)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < (key(i, w), k):
                gone |= set(range(k, k + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("window", "chunk", "range_"), [(20, 500_000, 2_000_000), (20, 60, 50), (6, 200, 300), (4, 30, 20)])
def test_repeats_against_brute_force(spark, monkeypatch, window, chunk, range_):
    monkeypatch.setattr(recompress, "CHUNK", chunk)
    monkeypatch.setattr(recompress, "RANGE", range_)
    chance = random.Random(window + chunk)
    word = lambda: chance.choice(["the", "a", "é", "w", f"u{chance.randrange(400)}", f"v{chance.randrange(40)}"])
    passages = [[word() for _ in range(chance.randrange(3, 70))] for _ in range(12)]
    rows = []
    for i in range(90):
        w = []
        for _ in range(chance.randrange(0, 4)):
            p = chance.choice(passages)
            a = chance.randrange(0, len(p))
            w += chance.choice([p, p[a:], p[:a], [word() for _ in range(chance.randrange(1, 30))]])
        rows.append((i, chance.choice([" ", "\n", " \t"]).join(w)))
    rows += [(200 + i, " ".join(passages[0] + passages[1])) for i in range(40)]  # a hot group of copies
    rows += [(300, "go " * 90), (301, "x " + "go " * 60 + "y"), (302, "a b " * 50), (303, "a b c " * 30), (304, "no no yes " * 40), (305, "go go " + "s " * 25)]
    rows += [(400, None), (401, ""), (402, " \n\t"), (None, " ".join(passages[2] * 2)), (None, " ".join(passages[3])), (5, rows[5][1]), (6, " ".join(passages[4])), (403, "é x " * 30)]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"chunk": F.lit(1), "kept": F.lit("x")}).repartition(4)
    got = recompress.remove_repeats(d, window)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()), key=repr) == removed_by_hand(rows, window)
    assert all(sum(s["last"] - s["first"] + 1 for s in r.removed) == r.n_removed for r in got.collect())


def test_repeats_of_nothing_and_of_long_texts(spark):
    d = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(40_000))), (2, " ".join(f"w{i}" for i in range(100, 39_000)))], "doc_id int, text string")
    assert recompress.remove_repeats(d.limit(0)).count() == 0
    assert [(r.n_removed, r.kept) for r in recompress.remove_repeats(d).orderBy("doc_id").select("n_removed", "kept").collect()][1] == (38_900, "")
    with pytest.raises(ValueError, match="four words"):
        recompress.remove_repeats(d, 3)


def test_equal_passages_hold_equal_symbols():
    """Every window that occurs twice either holds a symbol that its words decide, the same in both places, or none in either."""
    chance = random.Random(9)
    passage = [f"w{chance.randrange(50)}" for _ in range(60)]
    texts = [[f"a{i}" for i in range(30)] + passage + ["end"] * 7, ["go"] * 9 + passage + [f"b{i}" for i in range(30)]]
    index = {}
    tokens = [index.setdefault(w, len(index)) for t in texts for w in t]
    row = {"sizes": np.array([len(t) for t in texts]), "ids": [1, 2], "digests": np.array([1, 2]), "words": np.array([recompress._digest(w.encode()) for w in index]), "tokens": recompress._packed(np.array(tokens)), "told": None}
    p = recompress._Parse(row, 20)
    for step in range(4):
        p.pair(step)
    held = defaultdict(set)
    for s, n, left, right, name in zip(p.start, p.size, p.left, p.right, p.name, strict=True):
        for w in range(max(0, s + n + right - 20), s - left + 1):
            held[int(w)].add((int(s - w), int(n), int(name)))
    for k in range(len(passage) - 19):
        assert held[30 + k] and held[30 + k] == held[len(texts[0]) + 9 + k]
