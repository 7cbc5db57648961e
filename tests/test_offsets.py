"""Tokens with places, held spans, sentences with abbreviations, speakers; the vectorised n-grams against the column version."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from unisono.functions import offsets
from unisono.functions import text as X
from unisono.operators import grams, ledger
from unisono.sources import tables

SF = "/root/testdata/sf0.001"


def test_held_before_answers_like_a_scan_of_the_spans():
    rng = random.Random(1)
    for _ in range(300):
        length = rng.randint(1, 80)
        spans = [(a, a + rng.randint(1, 12)) for a in (rng.randint(-3, length + 3) for _ in range(rng.randint(0, 6)))]
        before = offsets.held_before(length, spans)
        for _ in range(30):
            a = rng.randint(0, length - 1)
            b = rng.randint(a + 1, length)
            assert (before[b] > before[a]) == any(s < b and a < e for s, e in spans)


TEXT = "WASHINGTON - Contact me at a.b@example.test today. We will protect İstanbul workers' rights now!\nSee https://x.test/y and Jane Roe said so.\n###\nnotes"


def test_places_point_into_the_unchanged_text():
    sents = offsets.sentence_tokens(TEXT)
    assert [[t for t, _, _ in s] for s in sents][0] == ["contact", "me", "at", "today"]
    for token, a, b in (x for s in sents for x in s):
        assert offsets.lower_in_place(TEXT)[a:b] == token
    assert offsets.sentence_tokens(None) == [] and offsets.sentence_tokens(" \n") == []


def _by_scan(text, spans, lo, hi):
    """Each occurrence against each span."""
    out = set()
    for s in offsets.sentence_tokens(text):
        for n in range(lo, hi + 1):
            for i in range(len(s) - n + 1):
                if not any(a < s[i + n - 1][2] and s[i][1] < b for a, b in spans):
                    out.add(" ".join(t for t, _, _ in s[i : i + n]))
    return out


def test_free_runs_hold_the_ngrams_that_touch_no_span():
    rng = random.Random(2)
    words = ["alpha", "b-c", "don’t", "Ünit", "x", "now.", "Then!", "and", "42", " - "]
    for _ in range(200):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 25)))
        spans = [(a, a + rng.randint(1, 9)) for a in (rng.randint(0, max(1, len(text))) for _ in range(rng.randint(0, 3)))]
        runs = offsets.free_token_runs(text, spans)
        got = {" ".join(r[i : i + n]) for r in runs for n in range(1, 5) for i in range(len(r) - n + 1)}
        assert got == _by_scan(text, spans, 1, 4)


def test_ledger_drops_ngrams_over_held_spans(spark):
    d = dt.date(2024, 1, 1)
    text = "We must protect clean water and free Jane Roe from prison today."
    at = text.index("Jane Roe")
    rows = [(i, d, "D", 118, f"u{i}", f"u{i}", 1, False, text, [(at, at + 8)]) for i in range(4)]
    stm = spark.createDataFrame(rows, "doc_id long, day date, party string, congress int, unit string, bioguide string, lane int, syndicated boolean, text string, held array<struct<start:int,end:int>>")
    plain = {r.ngram for r in ledger.ledger(stm.drop("held"), df_max=1.0)[0].collect()}
    free = {r.ngram for r in ledger.ledger(stm, df_max=1.0)[0].collect()}
    assert "free jane roe" in plain and "protect clean water" in free
    assert free == {g for g in plain if not {"jane", "roe"} & set(g.split())}


@pytest.mark.parametrize("lo", [1, 3])
def test_grams_equal_the_column_version(spark, lo):
    """Nulls, no tokens, repeats, long and short texts; a second text of the same n-grams; hashes tell n-grams apart."""
    rows = [(1, None), (2, ""), (3, "The committee on rules met today. A quiet war in iran goes on and on. A quiet war in iran goes on."), (4, "one two"), (5, "water " * 30 + ". rights and clean water for all")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    got = {(r.doc_id, r.ngram) for r in grams.grams(df, ["doc_id"], lo, 6).collect()}
    kept = X.kept_ngrams(X.sentences(F.col("text")), lo, 6)
    want = {(r.doc_id, r.g) for r in df.select("doc_id", F.explode(kept).alias("g")).where(~X.is_low_content(F.col("g"))).collect()}
    assert got == want
    h = grams.grams(df, ["doc_id"], lo, 6)
    assert h.select("h").distinct().count() == h.select("ngram").distinct().count()
    assert grams.grams(df.where("false"), ["doc_id"], lo, 6).count() == 0


@pytest.mark.parametrize("limit", [0, 4_000_000])
def test_frequent_holds_all_that_reach_the_quorum(spark, limit, monkeypatch):
    """By broadcast and by a join."""
    monkeypatch.setattr(grams, "BROADCAST_HASHES", limit)
    stm = ledger.eligible(tables.statements(spark, SF).withColumn("unit", F.col("bioguide")))
    every = ledger.occurrences(stm)
    want = {tuple(r) for r in every.join(ledger.candidates(every, 2), "ngram", "left_semi").select("ngram", "doc_id").collect()}
    got = ledger.frequent_occurrences(stm, 2)
    exact = {tuple(r) for r in got.join(ledger.candidates(got, 2), "ngram", "left_semi").select("ngram", "doc_id").collect()}
    assert exact == want and want
