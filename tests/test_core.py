"""Known answers of the operators, and queries against their SQL."""

import datetime as dt

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from unisono.functions import stats
from unisono.functions import text as X
from unisono.operators import goldset, health, identity, ranking, ranks, research, spans, vectors, waves
from unisono.plans.catalogue import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
FAST = ["normalize_dedupe", "text_features", "sentence_token_counts", "surge_bh", "overdispersion", "kappa_alpha", "streak_runs", "readiness_same_weekday", "strat_sample_hash", "vector_topk", "redact_spans", "ignition_widths", "lifespans", "sync_ceiling", "month_effect", "anchor_snap", "gravity_half_life", "statement_meta", "phrase_persistence", "style_rates", "first_capitals", "bootstrap_gap", "contest_terms", "contest_coverage", "sentence_places", "held_ngrams", "phrase_occurrences", "gold_seal", "density_matched", "redacted_records", "correction_table", "surge_rankings", "spearman_p", "era_top_phrases", "spearman_rho", "mann_whitney", "gini_top_decile", "quintile_slices"]


def _rows(df):
    def v(x):
        x = None if x is None or x != x else x
        return round(x, 5) if isinstance(x, float) else str(x).removesuffix(" 00:00:00")

    return sorted(tuple(v(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in "customer orders lineitem nation events documents embeddings pages labels part".split():
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF).toPandas(), con.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_phrase_predicates(spark):
    df = spark.createDataFrame([("at the same time",), ("war in iran",), ("and the trump administration's",), ("colleagues in demanding the",), ("committee on rules",)], "g string")
    rows = {r.g: r for r in df.select("g", X.is_low_content(F.col("g")).alias("low"), X.is_weak_label(F.col("g")).alias("weak"), X.scaffold_reason(F.col("g")).alias("why"), X.is_template(F.col("g")).alias("t")).collect()}
    assert rows["at the same time"].low and not rows["war in iran"].low
    assert rows["and the trump administration's"].weak and rows["colleagues in demanding the"].why == "REJECT_ATTRIBUTION_FRAME"
    assert rows["committee on rules"].t


def test_kept_ngrams_equal_filtered_ngrams(spark):
    df = spark.createDataFrame([("The committee on rules met today. A quiet war in iran goes on and on.",), ("",), (None,)], "t string")
    s = X.sentences(F.col("t"))
    a = df.select(F.array_sort(X.kept_ngrams(s, 3, 6)).alias("x"), F.array_sort(F.filter(X.doc_ngrams(F.col("t"), 3, 6), lambda g: ~X.is_template(g))).alias("y")).collect()
    assert all(r.x == r.y for r in a)


def test_binomial_tail(spark):
    df = spark.createDataFrame([(3, 10, 0.2), (0, 5, 0.1), (5, 5, 0.5)], "k int, n int, p double")
    got = [r[0] for r in df.select(stats.binomial_tail(F.col("k"), F.col("n"), F.col("p"))).collect()]
    assert got[0] == pytest.approx(0.3222004736) and got[1] == 1.0 and got[2] == pytest.approx(0.03125)


def test_p_of_a_correlation(spark):
    df = spark.createDataFrame([(2.228139, 10.0), (1.0, 1.0), (-4.302653, 2.0), (1.959966, 1e7), (0.0, 5.0), (60.0, 40.0), (None, 3.0)], "t double, df double")
    got = [r[0] for r in df.select(stats.t_tails("t", "df")).collect()]
    assert got[:5] == pytest.approx([0.05, 0.5, 0.05, 0.05, 1.0], abs=1e-6) and got[5] < 1e-30 and (got[6] is None or got[6] != got[6])
    df = spark.createDataFrame([(0.5, 12), (-1.0, 9), (0.3, 2), (None, 9), (0.0, 9)], "rho double, n long")
    got = [r[0] for r in df.select(stats.correlation_p(F.col("rho"), F.col("n"))).collect()]
    assert got[0] == pytest.approx(0.097850, abs=1e-5) and got[1] == 0.0 and got[2] is None and got[3] is None and got[4] == pytest.approx(1.0)


def test_joint_groups_and_units(spark):
    d = dt.date(2024, 1, 1)
    df = spark.createDataFrame([("1", "A", d, "Same  text"), ("2", "B", d, "same text"), ("3", "C", d, "other"), ("4", None, d, "x")], "id string, bioguide string, day date, text string")
    got = {r.id: r for r in identity.with_joint_groups(df).collect()}
    assert got["1"].unit == got["2"].unit and got["1"].joint_group.startswith("joint:")
    assert got["3"].unit == "C" and got["4"].unit == "4"


def test_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (9, 8)], "a long, b long")
    assert {r.id: r.component for r in identity.components(e).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8}


def test_bursts(spark):
    days = [("2019-03-01", 2), ("2019-03-02", 8), ("2019-03-04", 20), ("2019-05-10", 3), ("2019-05-16", 9), ("2019-05-22", 18)]
    df = spark.createDataFrame([("g", dt.date.fromisoformat(a), n) for a, n in days], "ng string, day date, count long")
    assert [(r.burst, r.width) for r in research.bursts(df, "ng", 14).orderBy("burst").collect()] == [(1, 3), (2, 12)]


def test_collapse():
    rows = [{"ngram": "war in iran now", "peak": 10}, {"ngram": "war in iran", "peak": 11}, {"ngram": "the war in iran", "peak": 12}]
    assert [r["ngram"] for r in ranking.collapse(rows)] == ["war in iran now"]


def test_apportionment():
    got = goldset.largest_remainder({"a": 5, "b": 3, "c": 2}, 7, {"a": 3, "b": 3, "c": 3})
    assert sum(got.values()) == 7 and got["a"] == 3
    assert goldset.largest_remainder({"a": 0.7375, "b": 0.2, "c": 0.0625}, 8, {"a": 9, "b": 9, "c": 9}) == {"a": 6, "b": 2, "c": 0}


def test_select_target_day():
    p = dt.date(2024, 1, 10)
    days = {p - dt.timedelta(days=k): (True, 5) for k in range(6)}
    assert health.select_target_day(days, set(), p) == (p - dt.timedelta(days=5), "ready")
    done = {p - dt.timedelta(days=k) for k in range(1, 6)}
    assert health.select_target_day({p: (False, 1)}, done, p) == (None, "held")


def test_name_runs():
    index = {"clean": [(["clean", "water", "act"], "c1")]}
    assert spans.name_runs("the clean water act of 1972 passed".split(), index) == [(1, 5, "c1")]
    toks = "the clean water act would".split()
    assert spans.covered(0, toks, [(1, 3, "c1")]) is None  # begins with the run and goes beyond it
    assert spans.covered(1, toks[1:4], [(1, 3, "c1")]) == "A" == spans.covered(0, toks[:4], [(1, 3, "c1")])
    assert spans.covered(2, toks[2:], [(1, 3, "c1")]) == "B" == spans.covered(9, ["past", "clean"], [(10, 12, "c1")])
    assert spans.covered(2, toks[2:4], [(0, 2, "x"), (1, 3, "c1")]) == "A"


def test_redaction_is_idempotent(spark):
    df = spark.createDataFrame([("mail a.b@c.de or 10.0.0.1 or (743) 555-3824",)], "t string")
    once = df.select(spans.redact(F.col("t")).alias("t"))
    assert once.first() == once.select(spans.redact(F.col("t")).alias("t")).first()


def test_source_state_knows_all_orders(spark):
    own = """select c_custkey, coalesce((select max(o_orderpriority) from o where o_custkey = c_custkey and day = last), 'unattestable') as state
      from (select c_custkey, (select max(day) from o where o_custkey = c_custkey and day <= date '1997-06-01' and day > date '1997-06-01' - 365) as last from customer)"""
    con = duckdb.connect()
    con.sql(f"create view customer as select * from '{SF}/customer.parquet'")
    con.sql(f"create view o as select *, cast(o_orderdate as date) as day from '{SF}/orders.parquet'")
    want = dict(con.sql(own).fetchall())
    got = {r.office: r.state for r in QUERIES["source_state_asof"](spark, SF).collect()}
    assert got == want and any(v != "unattestable" for v in got.values())


def test_resamples_are_the_references(spark):
    customer, nation = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("customer", "nation"))
    states = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    cells = customer.select("c_custkey", (F.col("c_nationkey") % 2 == 0).alias("cell"), "c_acctbal")
    want = research.permuted_pairs(states, "n_regionkey", "n_nationkey", "c_custkey", 50), research.bootstrap_gap(cells, "cell", "c_acctbal", "c_custkey", 500)
    for name, df in zip(("permuted_state_pairs", "bootstrap_gap"), want, strict=True):
        assert tuple(QUERIES[name](spark, SF).first()) == pytest.approx(tuple(df.first()))


def test_weekly_jaccard_takes_all_events(spark):
    rows = spark.read.parquet(f"{SF}/events.parquet").select(F.to_date(F.date_trunc("week", "ts")), F.col("user_id") % 2, "user_id", "event_type").collect()
    sets = {}
    for week, party, user, kind in rows:
        sets.setdefault((week, party), {}).setdefault(user, set()).add(kind)
    want = {}
    for cell, of in sets.items():
        pairs = [(a, b) for i, a in of.items() for j, b in of.items() if i < j]
        if pairs:
            want[cell] = (len(pairs), pytest.approx(sum(len(a & b) / len(a | b) for a, b in pairs) / len(pairs), abs=2e-6))
    got = {(r.week, r.party): (r.pairs, r.mean_jaccard) for r in QUERIES["pairwise_jaccard_weekly"](spark, SF).collect()}
    assert got == want


def test_forms_with_apostrophes_are_suppressed(spark):
    """A listed form is found whether its parts are joined by an apostrophe, a hyphen or a space."""
    digests = {spans.form_digest("Pat O'Brien", "salt")}
    rows = spark.createDataFrame([("Then Pat O'Brien spoke",), ("pat o brien",), ("Pat O-Brien",), ("Pat Brien",), ("",), (None,)], "t string")
    got = [[(x.start, x.end) for x in r.s] for r in rows.select(spans.suppressed_spans(F.col("t"), digests, "salt").alias("s")).collect()]
    assert got == [[(5, 16)], [(0, 11)], [(0, 11)], [], [], []]


def test_person_spans_know_all_letters(spark):
    rows = spark.createDataFrame([("Heute sprach Jörg Müller dort",), ("Élodie de Tour kam",), ("nobody here",)], "t string")
    got = [[(r.t[x.start : x.end], x.kind) for x in r.s] for r in rows.select("t", spans.person_spans(F.col("t"), {"jörg müller"}).alias("s")).collect()]
    assert got[0] == [("Jörg Müller", "official")] and got[2] == []
    assert got[1] == [("Élodie de Tour", "quarantine")]


def test_gravity_ends_at_a_missing_day(spark):
    days = [("2020-03-01", 10), ("2020-03-02", 6), ("2020-03-03", 5), ("2020-03-05", 9), ("2021-01-01", 4), ("2021-01-02", 1)]
    got = waves.gravity(spark.createDataFrame(days, "day string, n long").select(F.to_date("day").alias("day"), "n")).orderBy("year").collect()
    assert [(r.year, r.peak, r.half_life) for r in got] == [(2020, 10, 3), (2021, 4, 1)]
    assert waves.gravity(spark.createDataFrame([], "day date, n long")).count() == 0


@pytest.mark.parametrize("limit", [0, 32 << 20])
def test_nearest_vectors(spark, limit, monkeypatch):
    """By broadcast and on a grid of groups; ties, a repeated row, vectors that take no part."""
    monkeypatch.setattr(vectors, "BROADCAST_BYTES", limit)
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(60)]
    rows += [rows[5], (100, None), (101, []), (102, [0.0] * 4), (103, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(5)
    got = {}
    for r in vectors.nearest(df, df.where("id % 10 = 0"), 4).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.cosine))
    usable = [(i, np.array(v)) for i, v in rows if v and len(v) == 4 and any(v)]
    for q, v in usable:
        if q % 10 == 0:
            score = sorted((-round(float(v @ w / np.sqrt((v @ v) * (w @ w))), 6), i) for i, w in usable if i != q)
            assert [(i, -s) for s, i in score[:4]] == [(i, pytest.approx(c, abs=2e-6)) for i, c in got[q]]
    assert set(got) == {q for q, _ in usable if q % 10 == 0}


def test_running_sums_and_ranks(spark):
    rng = np.random.default_rng(2)
    rows = [(int(g), int(v)) for g, v in zip(rng.integers(0, 3, 300), rng.integers(0, 20, 300), strict=True)] + [(1, None)]
    df = spark.createDataFrame(rows, "g int, v int").repartition(6)
    ranks_of = {(r.g, r.v): (r.n, r.before) for r in ranks.value_ranks(df, "v", ("g",)).collect()}
    for (g, v), (n, before) in ranks_of.items():
        mine = [b for a, b in rows if a == g and b is not None]
        assert (n, before) == (mine.count(v), sum(b < v for b in mine))
    assert len(ranks_of) == len({r for r in rows if r[1] is not None})
    numbered = ranks.row_numbers(df.where("v is not null"), ["v", "g"], "i").orderBy("i").collect()
    assert [r.i for r in numbered] == list(range(1, 301)) and [(r.v, r.g) for r in numbered] == sorted((v, g) for g, v in rows if v is not None)
    assert ranks.value_ranks(df.where("false"), "v").count() == 0


def test_eligible_offices_by_month(spark):
    """Against a scan: intervals within a month, over years, open ones, non-voting ones, days at their edges."""
    from unisono.operators import measures

    d = dt.date
    spans_ = [("a", d(2020, 1, 1), d(2020, 1, 31)), ("b", d(2019, 5, 3), d(2021, 2, 1)), ("c", d(2020, 1, 31), d(2020, 2, 1)), ("e", None, d(2021, 1, 1)), ("f", d(2020, 1, 1), None), ("g", d(2020, 2, 1), d(2020, 2, 1)), ("h", d(2020, 1, 1), d(2022, 1, 1))]
    iv = spark.createDataFrame([(o, s, e, "D", "none" if o == "h" else None) for o, s, e in spans_], "bioguide string, start date, end_exclusive date, party string, voting_status string")
    days = [d(2019, 5, 2), d(2020, 1, 30), d(2020, 1, 31), d(2020, 2, 1), d(2021, 1, 31), d(2021, 2, 1)]
    got = {r.day: r.eligible for r in measures.eligible_offices(spark.createDataFrame([(x,) for x in days], "day date"), iv).collect()}
    want = {x: sum(1 for o, s, e in spans_ if s and e and o != "h" and s <= x < e) for x in days}
    assert got == {k: v for k, v in want.items() if v}
    assert measures.eligible_offices(spark.createDataFrame([], "day date"), iv).count() == 0
