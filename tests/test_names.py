"""Names in texts: the walk over tokens against windows and joins, their SQL, many names, rules beside them."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from unisono.operators import names as N
from unisono.operators.spans import covered, name_runs
from unisono.plans.catalogue import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def _walk(texts, table):
    index = {}
    for name, cite in table:
        t = name.split()
        index.setdefault(t[0], []).append((t, cite))
    out = {}
    for k, t in texts:
        runs = name_runs((t or "").lower().split(), index)
        if runs:
            out[k] = runs
    return out


def _got(df):
    return {r.doc_id: [(x["first"], x["last"], x["cite"]) for x in r.runs] for r in df.collect()}


@pytest.fixture(scope="module")
def planted():
    rnd = random.Random(7)
    words = ["act", "of", "clean", "water", "air", "1972", "2001", "fund", "the", "state"]
    table = sorted({" ".join(rnd.choices(words, k=rnd.randint(1, 5))): None for _ in range(60)})
    table = [(n, f"c{i}") for i, n in enumerate(table)]
    texts = [(i, " ".join(rnd.choices(words + ["x", "y"], k=rnd.randint(0, 60)))) for i in range(300)]
    return table, [*texts, (300, None), (301, ""), (302, "clean water " * 4000), (303, texts[0][1])]


@pytest.mark.parametrize("limit", [N.BROADCAST_NAMES, 0])
def test_runs_equal_the_walk(spark, planted, limit):
    table, texts = planted
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("name", F.lit("clash")).withColumn("toks", F.lit(1))
    assert _got(N.name_runs(docs, spark.createDataFrame(table, "name string, cite string"), limit)) == _walk(texts, table)


def test_full_filter_changes_nothing(spark, planted, monkeypatch):
    table, texts = planted
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    monkeypatch.setattr(N, "window_filter", lambda names: (N.np.full(4096, 255, N.np.uint8), [1, 2, 3, 4, 5]))  # every window passes
    assert _got(N.name_runs(docs, spark.createDataFrame(table, "name string, cite string"))) == _walk(texts, table)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "clean water act")], "doc_id long, text string")
    none = spark.createDataFrame([], "name string, cite string")
    assert N.name_runs(docs, none).count() == 0
    assert N.name_runs(docs.limit(0), spark.createDataFrame([("clean water act", "c")], "name string, cite string")).count() == 0


def test_a_million_names(spark):
    names = spark.range(1_000_000).select(F.format_string("act %d of item %d", F.col("id"), F.col("id") % 7).alias("name"), F.col("id").cast("string").alias("cite"))
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.format_string("we passed the act %d of item %d of 1999 and act %d of item 9", F.col("id") * 611, F.col("id") * 611 % 7, F.col("id")).alias("text"))
    got = _got(N.name_runs(docs, names, 100))
    bits, lengths = N.window_filter(names)
    assert len(bits) * 8 <= N.FILTER_BITS and lengths == [5]
    assert len(got) == 1637 and all(r == [(3, 9, str(k * 611))] for k, r in got.items())  # ids below 1,000,000 are names


def test_dictionary_and_glosses(spark):
    rows = [(117, "Clean  Water, Act", "b"), (117, "clean water act", "a"), (118, "clean water act", "0"), (119, "Later Act", "z"), (117, "!!", "q"), (117, "No Cite Act", None)]
    got = N.dictionary(spark.createDataFrame(rows, "congress int, name string, cite string"), 118).collect()
    assert [tuple(r) for r in got] == [("clean water act", "a")]
    titles = [("hr1", "Safeguard Every Voter Eligibility Act"), ("hr1", "SAVE Act"), ("hr1", "Save Act"), ("hr2", "TEST Act"), ("hr2", None), ("hr1", "SAVE Fund")]
    got = N.glosses(spark.createDataFrame(titles, "bill string, title string")).collect()
    assert [tuple(r) for r in got] == [("hr1", "Safeguard Every Voter Eligibility SAVE Act")]


def test_verdicts_equal_every_window(spark, planted):
    table, texts = planted
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    wanted = [(k, g) for k, t in texts for g in ("clean water act", "act of", "x y state", "the fund") if t]
    runs = _walk(texts, table)
    want = {}
    for k, g in wanted:
        toks, p = dict(texts)[k].split(), g.split()
        at = [i for i in range(len(toks) - len(p) + 1) if toks[i : i + len(p)] == p]
        if at:
            a = want.setdefault(g, [0, 0])
            a[0] += 1
            a[1] += all(covered(i, p, runs.get(k, [])) for i in at)
    named = N.name_runs(docs, spark.createDataFrame(table, "name string, cite string"))
    got = N.verdicts(docs, spark.createDataFrame(wanted, "doc_id long, ngram string"), named)
    assert {r.ngram: [r.docs, r.name_docs] for r in got.collect()} == want
    assert all(r.tagged == (r.name_docs / r.docs >= 0.8) and (r.cite is not None) == (r.name_docs > 0) for r in got.collect())


def test_procedural_phrases(spark):
    rows = [("whole house on the",), ("the state of the union",), ("state of the union",), ("i yield back today",), ("clean water",), ("house",), ("",), (None,), ("yield backs",)]
    df = spark.createDataFrame(rows, "g string")
    f = N.is_procedural(F.col("g"), ("committee of the whole house on the state of the union",), ("yield back",), ("state of the union",))
    got = {r.g: r.p for r in df.select("g", f.alias("p")).collect()}
    assert [g for g, p in got.items() if p] == ["whole house on the", "the state of the union", "i yield back today", "house"]


@pytest.mark.parametrize("name", ["name_runs", "name_verdicts"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF).toPandas(), con.sql(ORACLE_SQL[name]).df()[sorted(con.sql(ORACLE_SQL[name]).columns)]
    got = got[sorted(got.columns)]
    assert len(want) and list(got.columns) == list(want.columns)
    assert sorted(map(tuple, got.astype(str).to_numpy())) == sorted(map(tuple, want.astype(str).to_numpy()))
