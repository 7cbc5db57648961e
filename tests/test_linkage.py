"""Contests, tiers of links and nested phrases: known answers."""

import datetime as dt
import random

from pyspark.sql import functions as F

from unisono.operators import linkage

ROW = "cycle int, state string, district int, special boolean, stage string, candidate string, party string, votes long"


def _contests(spark, rows):
    return {(r.cycle, r.state, r.special): r for r in linkage.contests(spark.createDataFrame(rows, ROW)).collect()}


def test_contests(spark):
    rows = [
        (2014, "OK", 0, False, "GEN", "Jim Roe", "R", 60), (2014, "OK", 0, False, "gen", "jim roe ", "C", 10), (2014, "OK", 0, False, "", "Ann Doe", "D", 30),
        (2014, "OK", 0, True, "gen", "Lee", "R", 5),
        (2014, "GA", 0, False, "gen", "A", "D", 50), (2014, "GA", 0, False, "gen", "B", "R", 49), (2014, "GA", 0, False, "gen runoff", "B", "R", 30), (2014, "GA", 0, False, "gen runoff", "A", "D", 10),
        (2014, "TX", 0, False, "primary", "P", "R", 9), (None, "TX", 0, False, "gen", "P", "R", 9), (2014, "NV", 0, False, "gen", None, "R", 9), (2014, "UT", 0, False, "gen", "Z", None, 0),
    ]
    got = _contests(spark, rows)
    assert set(got) == {(2014, "OK", False), (2014, "OK", True), (2014, "GA", False)}
    ok = got[2014, "OK", False]
    assert (ok.winner, ok.party, ok.winner_votes, ok.runnerup_votes, ok.mov) == ("JIM ROE", "R", 70, 30, 0.4)
    assert got[2014, "GA", False].winner == "B" and got[2014, "OK", True].mov == 1.0
    assert _contests(spark, rows[:0]) == {}


def test_links_by_tier(spark):
    d = dt.date
    one = lambda cycle, special=False, winner="ANN DOE", party="D": (cycle, "S", 1, special, winner, party)
    contests = spark.createDataFrame([one(y) for y in range(2000, 2016, 2)] + [one(2020, True)], "cycle int, state string, district int, special boolean, winner string, party string")
    t = lambda bio, start, party, *names: (bio, "S", 1, party, start, list(names))
    terms = spark.createDataFrame(
        [
            t("only", d(2001, 1, 3), "R", "X"),
            t("named", d(2003, 1, 3), "R", "ANN", "DOE"), t("other", d(2003, 1, 3), "D", "X"),
            t("np", d(2005, 1, 3), "D", "DOE"), t("nr", d(2005, 1, 3), "R", "DOE"),
            t("late", d(2007, 6, 1), "D", "DOE"), t("seat", d(2007, 1, 3), "D", "DOE"),
            t("p", d(2009, 1, 3), "D", "X"), t("q", d(2009, 1, 3), "R", "X"),
            t("r1", d(2011, 1, 3), "R", "X"), t("r2", d(2011, 2, 3), "I", "X"),
            t("t1", d(2013, 1, 3), "R", "X"), t("t2", d(2013, 1, 3), "R", "X"),
            t("sp", d(2020, 11, 20), "D", "X"),
        ],
        "bioguide string, state string, district int, party string, start date, names array<string>",
    )
    got = {r.cycle: (r.bioguide, r.matched_via, r.reason) for r in linkage.link(contests, terms).collect()}
    assert got == {
        2000: ("only", "exact", None), 2002: ("named", "name", None), 2004: ("np", "name+party", None), 2006: ("seat", "name+date", None), 2008: ("p", "exact", None),
        2010: ("r1", "relaxed+date", None), 2012: (None, None, "ambiguous"), 2014: (None, None, "no_term"), 2020: ("sp", "exact", None),
    }
    cover = linkage.coverage(linkage.link(contests, terms), "special").orderBy("special").collect()
    assert [(r.matched, r.unmatched, r.relaxed, r.match_pct) for r in cover] == [(6, 2, 1, 75.0), (1, 0, 0, 100.0)]


def _collapsed(rows, most):
    """Longest first: kept unless a kept longer phrase contains it with all its members."""
    kept = []
    for g, peak, m in sorted(rows, key=lambda r: -len(r[0])):
        if not any(f" {g} " in f" {h} " and m and m <= n for h, _, n in kept):
            kept.append((g, peak, m))
    return [g for g, _, _ in sorted(kept, key=lambda r: (r[1], r[0]), reverse=True)][:most]


def test_nested_phrases_equal_the_ordered_walk(spark):
    rng = random.Random(8)
    rows = {}
    for group in "ab":
        text = [rng.choice("abc") for _ in range(60)]
        for _ in range(150):
            i, n = rng.randrange(55), rng.randint(1, 6)
            rows.setdefault((group, " ".join(text[i : i + n])), (rng.randint(1, 9), frozenset(rng.sample("uvwxyz", rng.randint(0, 3)))))
    df = spark.createDataFrame([(g, p, k, sorted(m)) for (g, p), (k, m) in rows.items()], "era string, ngram string, peak int, members array<string>")
    got = {g: [r.ngram for r in linkage.nested(df, ["era"], 20).where(F.col("era") == g).orderBy("rank").collect()] for g in "ab"}
    for g in "ab":
        assert got[g] == _collapsed([(p, k, m) for (h, p), (k, m) in rows.items() if h == g], 20)
