"""Families and pairs exchange what may be similar, not every set with every pair."""

import datetime as dt
import random

from pyspark.sql import functions as F

from unisono.operators import families as FA
from unisono.operators import identity as I

DAY = dt.date(2024, 1, 1)


def _rows(n=60, seed=3):
    """Versions of a few texts, more and less changed, and texts of their own, some short, one without words, one null."""
    rng = random.Random(seed)
    base = [[f"B{g}ä{k}" for k in range(rng.randint(40, 400))] for g in range(5)]
    rows = []
    for i in range(n):
        w = list(rng.choice(base)) if rng.random() < 0.7 else [f"n{i}x{k}" for k in range(rng.randint(1, 90))]
        for _ in range(rng.choice([0, 1, 3, 8]) if len(w) > 8 else 0):
            w[rng.randrange(len(w))] = f"c{rng.randrange(10**6)}"
        rows.append((i, DAY + dt.timedelta(days=i % 2), f"o{i % 4}", " ".join(w)))
    return [*rows, (n, DAY, "o1", "..."), (n + 1, DAY, "o2", None)]


def _docs(spark, rows):
    return spark.createDataFrame(rows, "id long, day date, bioguide string, text string").repartition(3)


def test_sets_equal_the_columns(spark):
    docs = _docs(spark, _rows())
    got = {r.id: (r.n, r.sh, r.mh) for r in I.shingle_sets(docs, ["id"]).collect()}
    text = F.col("text")
    plain = docs.where(F.size(I.word_tokens(text)) >= 24).select("id", F.array_sort(I.shingles(text)).alias("sh")).select("id", "sh", I.minhash(F.col("sh")).alias("mh"))
    assert got == {r.id: (len(r.sh), r.sh, r.mh) for r in plain.collect()} and got


def test_sketches_lose_no_pair(spark):
    sets = I.shingle_sets(_docs(spark, _rows()), ["id"]).cache()
    have = {r.id: set(r.sh) for r in sets.collect()}
    pairs = sets.select(F.col("id").alias("a")).crossJoin(sets.select(F.col("id").alias("b"))).where("a < b")
    for t in (0.3, 0.72, 1.0):
        got = {(r.a, r.b): r.similarity for r in I.scored_pairs(pairs, sets, t).collect()}
        want = {(a, b): len(x & y) / len(x | y) for a, x in have.items() for b, y in have.items() if a < b}
        assert got == {k: v for k, v in want.items() if v >= t} and got


def test_statements_that_meet_none_fill_no_bucket(spark):
    alone = [(i, DAY, "o1", " ".join(f"q{i}w{k}" for k in range(50))) for i in range(20)]
    assert FA._buckets(FA.retrieval(_docs(spark, alone))).count() == 0


def test_pairs_need_the_texts_once(spark):
    docs = _docs(spark, _rows()).withColumnRenamed("id", "key")
    sets = I.shingle_sets(docs, ["key", "day"])
    once = sorted(map(tuple, I.similar_pairs(sets, sets=sets).collect()))
    assert once == sorted(map(tuple, I.similar_pairs(docs).collect())) and once
