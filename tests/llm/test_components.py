"""Components: steps end when edges are stars, and later links join components alone."""

import random

from pyspark.sql import functions as F

from unisono.llm import jaccard_join as J


def _plain(pairs, ids):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {i: find(i) for i in ids}


def _written(monkeypatch):
    calls = []
    monkeypatch.setattr(J, "materialize", lambda df, real=J.materialize: calls.append(1) or real(df))
    return calls


def test_stars_take_no_step(spark, monkeypatch):
    calls = _written(monkeypatch)
    stars = [(1, i) for i in range(2, 30)] + [(i, 50) for i in range(51, 60)]
    got = J.connected_components(spark.createDataFrame(stars, "a long, b long")).collect()
    assert {r.id: r.component for r in got} == {i: 1 for i in range(2, 30)} | {i: 50 for i in range(51, 60)}
    assert len(calls) == 1


def test_chains_two_parents_and_no_edges(spark):
    ids = range(40)
    for pairs in ([], [(3, 3)], [(i, i + 1) for i in range(20)], [(5, 1), (5, 2), (2, 9)], [(7, 3), (3, 1), (7, 1)]):
        got = {r.id: r.component for r in J.connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
        assert {i: got.get(i, i) for i in ids} == _plain(pairs, ids)


def test_later_links_join_components(spark, monkeypatch):
    rng = random.Random(3)
    ids = list(range(60))
    made = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    pairs, label = [], None
    for _ in range(3):
        new = [tuple(rng.sample(ids, 2)) for _ in range(14)]
        pairs += new
        label = J._merged(label, made, spark.createDataFrame(new, "a long, b long"))
        assert {r.doc_id: r.component for r in label.collect()} == _plain(pairs, ids)
    calls = _written(monkeypatch)
    assert J._merged(label, made, spark.createDataFrame([], "a long, b long")) is label and not calls
    assert label.select(F.count_distinct("doc_id")).first()[0] == 60
