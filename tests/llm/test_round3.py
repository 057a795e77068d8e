"""Disk of the near-duplicate join, filters of ids, scores of large cross-sections."""

import os

from pyspark.sql import functions as F

from limitrank.llm import common, jaccard, url_filter


def test_possible_keeps_every_match(spark, monkeypatch):
    ids = spark.range(0, 3000, 7).withColumnRenamed("id", "doc_id")
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    for most in (1 << 25, 1000, 1):
        monkeypatch.setattr(common, "FILTER_MOST", most)
        got = {r.doc_id for r in common.possible(rows, "doc_id", ids).collect()}
        assert set(range(0, 3000, 7)) <= got
        assert most < 1 << 25 or len(got) < 700
    assert common.possible(rows, "doc_id", ids.where("doc_id < 0")).count() == 0


def test_jaccard_removes_prefixes_and_moves_few_texts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "scratch_dir", lambda spark: str(tmp_path))
    given = []
    monkeypatch.setattr(jaccard, "possible", lambda *a: given.append(common.possible(*a)) or given[-1])
    words = [[f"w{(i * 7919 + k * 104729) % 100003}" for k in range(60)] for i in range(200)]
    rows = [(i, " ".join(w)) for i, w in enumerate(words)] + [(1000 + i, " ".join([*words[i][:-1], "other"])) for i in range(20)]
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: i for i in range(200)} | {1000 + i: i for i in range(20)}
    assert not [x for x in os.listdir(tmp_path) if x.startswith(("sets-", "marks-", "forest-", "likely-"))]
    assert 40 <= given[0].count() < 80


def test_link_expressions_stay_small(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x/", '<link rel="canonical" href="../y?q=1#z">')], "page_id long, url string, html string")
    edges = url_filter.page_links(pages)
    assert [tuple(r) for r in edges.collect()] == [("http://a.org/x/", "http://a.org/y?q=1")]
    assert len(edges._jdf.queryExecution().optimizedPlan().toString()) < 200_000
