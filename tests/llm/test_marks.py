"""Marks of the near-duplicate join that meet by chance, and shuffle files of what is stored."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from limitrank.llm import common, jaccard


def _texts(n=160, seed=5):
    """Texts of common sentences, which share many runs of words by chance, and near copies of some."""
    pick = random.Random(seed)
    pool = [" ".join(f"w{pick.randrange(5000)}" for _ in range(12)) for _ in range(300)]
    rows = [(i, " ".join(pick.choice(pool) for _ in range(pick.randrange(20, 26)))) for i in range(n)]
    return rows + [(1000 + i, f"{t} and a tail") for i, t in rows[::8]] + [(2000 + i, " ".join(t.split()[:-8])) for i, t in rows[::16]]


def _brute(rows, words, percent):
    sets = [set(jaccard.shingles(t, words).tolist()) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}


@pytest.mark.parametrize("tile", [1024, 4])
def test_lists_of_marks_do_not_travel_where_classes_meet_by_chance(spark, monkeypatch, tile):
    rows, sent, grouped = _texts(), [], jaccard._grouped

    def counted(d, hot, key):
        if "marks" in d.columns:
            sent.append(d.agg(F.coalesce(F.sum(F.size("marks")), F.lit(0))).first()[0])
        return grouped(d, hot, key)

    monkeypatch.setattr(jaccard, "_grouped", counted)
    monkeypatch.setattr(jaccard, "TILE", tile)
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()}
    assert got == _brute(rows, 4, 85) and len(set(got.values())) < len(rows)
    assert tile < 1024 or sum(sent) < 100


def test_similar_sets_share_as_many_kept_elements():
    pick = np.random.default_rng(3)
    for percent in (50, 80, 85, 100):
        for _ in range(400):
            a = pick.choice(10_000, int(pick.integers(1, 60)), replace=False)
            b = np.unique(np.concatenate([a[int(pick.integers(0, 4)) :], pick.choice(10_000, int(pick.integers(0, 6)))]))
            both = len(np.intersect1d(a, b))
            if not both or 100 * both < percent * len(np.union1d(a, b)):
                continue
            one, two = (np.sort(x)[: jaccard.kept_length(len(x), percent)] for x in (a, b))
            assert len(np.intersect1d(one, two)) >= jaccard._shared_least(len(a), len(b), percent) >= 1


def test_shuffle_files_of_a_stored_table_go_with_its_run(spark):
    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = files(), spark.conf.get(name)
    kept, _ = common.stored(spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count(), "test")
    end = time.time() + 5
    while files() - before and time.time() < end:
        time.sleep(0.1)
    assert not files() - before and spark.conf.get(name) == was
    assert kept.count() == 700
