"""What many rows share is done once: sets of items, texts of many claims and phrases, the ledger that a ranking reads."""

import random
from contextlib import contextmanager

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from unisono.functions.text import contains_gram
from unisono.operators import claims as CL
from unisono.operators import contract as CO
from unisono.operators import fragments as FG
from unisono.operators import grams as GR
from unisono.operators import ledger as L
from unisono.operators import research as S
from unisono.operators.spans import phrase_occurrences, phrases_found


@contextmanager
def _plain(spark):
    """Plans that keep their nodes, and joins that show what they make."""
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _joined(df):
    """(rows, columns) of each join of a plan that has run."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if "Join" in node.nodeName():
            out.append((node.metrics().apply("numOutputRows").value(), {node.output().apply(i).name() for i in range(node.output().size())}))
    return out


def test_units_with_the_same_items_are_one_set(spark):
    rng = random.Random(1)
    rows = [("w", u, i) for u in range(300) for i in "abcd" if rng.random() < 0.5 or i == "a"] + [("x", 1, "a"), ("x", 2, "b"), ("y", 1, "a"), ("z", 1, None), ("z", 2, "a")]
    sets = spark.createDataFrame(rows, "week string, unit int, item string")
    with _plain(spark):
        df = S.pairwise_jaccard(sets, ["week"], "unit", "item")
        got = {r.week: (r.pairs, r.mean_jaccard) for r in df.collect()}
        assert max(n for n, _ in _joined(df)) < 1000
    of = {}
    for w, u, i in rows:
        of.setdefault(w, {}).setdefault(u, set()).add(i)
    want = {}
    for w, units in of.items():
        v = list(units.values())
        j = [len((a & b) - {None}) / (len(a) + len(b) - len((a & b) - {None})) for k, a in enumerate(v) for b in v[:k]]
        if j:
            want[w] = (len(j), pytest.approx(sum(j) / len(j), abs=1e-6))
    assert got == want


TEXTS = ["The old red fox. The old, \"RED fox's\" den; old red", None, "", "İ the old red fox — “the old red” fox", "old old red red fox fox old old red"]


def test_phrases_of_a_text_are_found_together(spark):
    phrases = ["old red", "the old red", "red", "fox's", "old old", "", None, "none such", "red  fox"]
    rows = spark.createDataFrame([(i, t, phrases) for i, t in enumerate(TEXTS)], "i int, text string, phrases array<string>")
    one = rows.withColumn("p", F.explode("phrases")).select("i", "p", "text", F.explode(phrase_occurrences(F.col("text"), F.col("p"))).alias("o"))
    want = one.select("i", "p", "o.start", "o.end", "o.quoted", F.substr("text", F.col("o.start") + 1, F.col("o.end") - F.col("o.start"))).collect()
    got = rows.select("i", F.explode(phrases_found(F.col("text"), F.col("phrases"))).alias("o")).select("i", "o.phrase", "o.start", "o.end", "o.quoted", "o.surface").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and want


def test_texts_are_not_copied_for_claims(spark):
    rows = [(i, f"id{i}", t, f"o{i % 3}", None) for i, t in enumerate(TEXTS)]
    stm = spark.createDataFrame(rows, "doc_id int, id string, text string, bioguide string, joint_group string")
    phrases = ["old red", "the old red", "red fox", "old old red", "fox", "old", "", "red \n fox"]
    members = spark.createDataFrame([(f"{p}|{k}", p, i) for p in phrases for k in range(3) for i in range(len(TEXTS))], "claim_id string, phrase string, doc_id int")
    with _plain(spark):
        for df in (CO.occurrences(members, stm), CO.carrying_units(members, stm)):
            assert df.collect()
            assert all(n <= len(TEXTS) for n, names in _joined(df) if names & {"text", "_told"})
    held = members.where("phrase <> ''").join(stm, "doc_id").where(contains_gram(F.col("text"), F.col("phrase")))
    want = {r.claim_id: r.n for r in held.groupBy("claim_id").agg(F.count_distinct("bioguide").alias("n")).collect()}
    assert {r.claim_id: r.carrying for r in CO.carrying_units(members, stm).collect()} == want


def test_sentences_do_not_meet_each_phrase(spark):
    text = " ".join(f"The old red fox number {'x' * (9 - k)} of the old house came home." for k in range(9))
    stm = spark.createDataFrame([(1, text, ""), (2, text.upper(), "")], "doc_id int, text string, speaker string")
    grams = ["old red fox", "the old house", "old house came", "red fox number", "xxx of the", "not there now"]
    wanted = spark.createDataFrame([(i, g) for i in (1, 2) for g in grams], "doc_id int, ngram string")
    with _plain(spark):
        df = FG.quotes(stm, wanted)
        got = {(r.doc_id, r.ngram): r.quote for r in df.collect()}
        assert max(n for n, _ in _joined(df)) == 2
        frags = FG.fragments(stm, spark.createDataFrame([(g,) for g in grams], "ngram string"))
        assert frags.count() and all(n <= 2 for n, names in _joined(frags) if "text" in names or "_form" in names)
    shortest = lambda g: min((s for s in text[:-1].split(". ") if g in s.lower()), key=len) + "."
    assert got == {(i, g): shortest(g) if i == 1 else shortest(g).upper() for i in (1, 2) for g in grams[:-1]}


def test_counts_of_ngrams_are_a_row_for_each_text():
    sents = [[{"toks": "a red fox came home with us".split(), "templated": False}] * 2, [{"toks": "the office of old cats".split(), "templated": True}], []]
    kind = pa.list_(pa.struct([("toks", pa.list_(pa.string())), ("templated", pa.bool_())]))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(sents, kind)], ["k", "_s"])
    rows = [r for b in GR._counted(["k"], 3, 6, 2)([batch]) for r in b.to_pylist()]
    every = [r for b in GR._rows(["k"], 3, 6, 2, True, None)([batch]) for r in b.to_pylist()]
    assert [(r["k"], r["grams"]) for r in rows if r["ngram"] is None] == [(1, sum(r["k"] == 1 for r in every))]
    assert {(r["k"], r["ngram"], r["grams"]) for r in rows if r["ngram"]} == {(2, r["ngram"], 1) for r in every if r["k"] == 2}


def _statements(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(9)] + ["the", "of"]
    rows = []
    for i in range(120):
        office = None if i % 11 == 0 else f"u{i % 7}"
        rows.append((i, ". ".join(" ".join(rng.choices(words, k=rng.randint(3, 9))) for _ in range(3)), i % 4, "DR"[i % 2], office or f"id{i}", office, 118, 1, False))
    stm = spark.createDataFrame(rows, "doc_id long, text string, d int, party string, unit string, bioguide string, congress int, lane int, syndicated boolean")
    return stm.withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")))


def test_a_ledger_is_made_once_and_keeps_its_ties(spark):
    stm = _statements(spark)
    occ = L.occurrences(stm).persist()
    phrases, daily = L.ledger_of(stm, occ, 2, 1.0, 2)
    for df in (phrases, daily.select("ngram", "units")):
        assert all("HashAggregate" not in line for line in df._jdf.queryExecution().executedPlan().toString().splitlines())
    of = {}
    for r in occ.collect():
        of.setdefault(r.ngram, []).append((r.day, r.doc_id, r.bioguide))
    got = {r.ngram: (r.first_day, r.first_bioguide, r.ties) for r in phrases.collect()}
    want = {}
    for g in got:
        day, _, office = min(of[g], key=lambda r: (r[0], r[1]))
        want[g] = (day, office, sorted({b for d, _, b in of[g] if d == day and b and b != office}) if office else [])
    assert got == want and any(t for _, _, t in got.values())


def test_shared_grams_decide_their_components(spark):
    stm = _statements(spark)
    shared = CL.shared_grams(stm, "doc_id")
    comp = CL.fragment_components(shared, "doc_id").persist()
    want = CL.support_phrase(CL.cluster_grams(stm, "doc_id"), comp, stm, "doc_id", 2).collect()
    best, rest = CL.support_of_shared(shared, comp, stm, "doc_id", 2)
    other = CL.support_phrase(CL.cluster_grams(stm, "doc_id"), rest, stm, "doc_id", 2).collect()
    assert sorted(map(tuple, [*best.collect(), *other])) == sorted(map(tuple, want)) and best.count()
