"""Counting n-grams holds what a bound allows: longer ones within frequent short ones, filters of fixed size, bounded splits."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from unisono.operators import grams as GR
from unisono.operators import ledger as L
from unisono.sources.shared import cut, splits


class Sent:
    def __init__(self, hashes):
        self.value = np.sort(np.array(hashes, np.int64).view(np.uint64))


def _told(texts):
    return [pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["k", "_t"])]


def _made(texts, lo, hi, strings=True, **more):
    out = [r for b in GR._rows(["k"], lo, hi, 2, strings, None, **more)(GR._unfolded(_told(texts))) for r in b.to_pylist()]
    return {(r["k"], r["ngram"]): r["h"] for r in out}


def test_longer_ngrams_are_made_where_their_short_runs_are_frequent():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(5)] + ["the", "of"]
    texts = ["\n".join(" ".join(rng.choices(words, k=rng.randint(1, 12))) for _ in range(3)) for _ in range(60)]
    short, every = _made(texts, 3, 3), _made(texts, 3, 6)
    kept = {g for _, g in short if hash(g) % 3 or "w1" in g}
    got = _made(texts, 3, 6, within=Sent([h for (_, g), h in short.items() if g in kept]))

    def passes(gram):
        toks = gram.split()
        runs = [toks[i : i + 3] for i in range(len(toks) - 2)]
        return len(toks) > 3 and all(" ".join(r) in kept or sum(w not in GR._STOP for w in r) < 2 for r in runs)

    want = {k: h for k, h in every.items() if passes(k[1])}
    assert got == want and 0 < len(want) < sum(len(g.split()) > 3 for _, g in every)


def _docs(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(9)] + ["the", "of"]
    texts = [None, ""] + [". ".join(" ".join(rng.choices(words, k=rng.randint(1, 14))) for _ in range(rng.randint(1, 5))) for _ in range(90)]
    rows = [(i, t, i % 3, "DR"[i % 2], f"u{i % 7}", f"u{i % 7}", 118) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, d int, party string, unit string, bioguide string, congress int").withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")))


def test_beyond_the_hashes_that_are_sent_a_filter_keeps_strings_few(spark, monkeypatch):
    docs = _docs(spark)
    calls = []
    monkeypatch.setattr(GR, "_folded_grams", lambda *a, real=GR._folded_grams, **b: calls.append((a, b)) or real(*a, **b))
    want = sorted(map(tuple, L.frequent_occurrences(docs, 3).collect()))
    monkeypatch.setattr(GR, "BROADCAST_HASHES", 0)
    monkeypatch.setattr(GR, "FILTER_BITS", 1 << 16)
    assert sorted(map(tuple, L.frequent_occurrences(docs, 3).collect())) == want and want
    made = [a[5] for a, _ in calls if a[4]]  # what is kept of the n-grams of which strings are made
    assert len(made) == 2 and made[1].value.nbytes == 1 << 13
    exact = L.occurrences(docs)
    assert {r[1] for r in want} and {tuple(r) for r in exact.join(L.candidates(exact, 3), "ngram", "left_semi").select("doc_id", "ngram").collect()} <= {(r[0], r[-1]) for r in want}


def test_folded_texts_are_read_in_bounded_splits(spark):
    rng = random.Random(10)
    texts = spark.createDataFrame([(" ".join(f"{rng.getrandbits(40):x}" for _ in range(200)),) for _ in range(1500)], "_t string").coalesce(1)
    told = cut(texts, 1 << 18)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with splits(spark, 1 << 18):
        rows = told.select("_t").mapInArrow(lambda bs: [pa.RecordBatch.from_pydict({"n": [sum(b.num_rows for b in bs)]})], "n long").collect()
    assert max(r.n for r in rows) < 750 and sum(r.n for r in rows) == 1500
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
