"""Lanes and seams, candidates of a gold set, batches of annotations: known answers."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from unisono.operators import goldset as G
from unisono.operators import provenance as PR
from unisono.plans.catalogue import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
D = dt.date
SEAM = "2021-01-03"


def test_instruments_have_no_default(spark):
    df = spark.createDataFrame([("legacy",), ("page",), ("other",), (None,)], "s string")
    got = [r.i for r in df.select(PR.instrument(F.col("s"), {"legacy": "imported", "page": "scraped"}).alias("i")).collect()]
    assert got == ["imported", "scraped", None, None]
    assert [r.i for r in df.select(PR.instrument(F.col("s"), {}).alias("i")).collect()] == [None] * 4


def test_lanes_and_guard(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x"), ("b", "y"), ("c", "x"), ("c", None), ("d", None)], "g string, lane string")
    rep = PR.lanes(rows, ["g"])
    assert {r.g: (r.n, r.untagged, r.lanes, r.lane) for r in rep.collect()} == {"a": (2, 0, 1, "x"), "b": (2, 0, 2, None), "c": (2, 1, 1, None), "d": (1, 1, 0, None)}
    assert PR.require(rep.where("g = 'a'"), F.col("lane").isNotNull(), "lanes").count() == 1
    with pytest.raises(PR.LaneError, match="series.*'g': 'b'"):
        PR.require(rep.where("g = 'b'"), F.col("lane") == "x", "series")
    assert PR.lanes(rows.limit(0), ["g"]).count() == 0


def test_seam_belongs_to_what_ends_there(spark):
    days = {"on and after": [D(2021, 1, 3), D(2021, 1, 4)], "to it": [D(2020, 1, 1), D(2021, 1, 3)], "after": [D(2021, 1, 4), D(2021, 1, 5)], "null": [None, D(2021, 1, 3)], "nulls": [None]}
    rows = spark.createDataFrame([(g, d) for g, ds in days.items() for d in ds], "g string, day date")
    assert {r.g for r in PR.seam_spans(rows, ["g"], SEAM).where("spans").collect()} == {"on and after"}


def test_verdicts_of_comparisons(spark):
    a, b = D(2020, 5, 1), D(2020, 6, 1)
    cases = {
        "ok": [("x", a, True)] * 2 + [("x", b, False)] * 2,
        "underpowered": [("x", a, True)] * 2 + [("x", b, False), ("x", b, None)],
        "two_instruments": [("x", a, True)] * 2 + [("y", b, False)],
        "mixed": [("x", a, True), ("y", a, True), ("z", b, False)],
        "untagged": [("x", a, True), (None, b, False)],
        "empty": [(None, a, True)] * 2,
    }
    rows = spark.createDataFrame([(g, *r) for g, rs in cases.items() for r in rs], "g string, lane string, day date, h boolean")
    got = PR.comparisons(rows, ["g"], F.col("h"), "2020-05-15", 2).collect()
    assert all(r.g == r.verdict for r in got) and len(got) == len(cases)
    assert {r.g for r in got if r.spans_seam} == set(cases) - {"empty"}


def test_universe_and_impact(spark):
    d = [D(2024, 1, i) for i in range(1, 5)]
    daily = spark.createDataFrame([("p", d[0], "D", 9), ("p", d[1], "D", 3), ("p", d[2], "D", 3), ("p", d[3], "R", 5), ("p", d[3], "I", 7), ("q", d[1], "R", 1), ("r", d[1], "R", 0)], "ngram string, day date, party string, units long")
    offices = spark.createDataFrame([("p", d[1], "D", 6), ("p", d[3], "R", 5)], "ngram string, day date, party string, headcount long")
    uni = G.universe(daily, offices, F.when(F.col("ngram") == "q", "private").otherwise("message"), "2024-01-02")
    got = {(r.ngram, r.party): (r.day, r.units, r.headcount, r.impact_tags, r.priority) for r in G.impact(uni, spark.createDataFrame([("p",), ("p",)], "ngram string")).collect()}
    assert got == {
        ("p", "D"): (d[1], 3, 6, ["public_surface", "family_collapse", "boundary_quorum"], 13),  # the ninth unit is before the epoch; ties: the earlier day
        ("p", "R"): (d[3], 5, 5, ["public_surface"], 8),
        ("q", "R"): (d[1], 1, 1, ["private", "rare_class"], 10),
    }
    assert uni.select("candidate_id").distinct().count() == 3 and G.universe(daily, offices, F.lit("message"), "2024-01-02", 4).count() == 1
    assert G.impact(uni.limit(0), offices.select("ngram")).count() == 0


def test_annotation_issues(spark):
    rows = [("1", "a", "message", "f"), ("2", "a", "message", "f"), ("2", "a", "message", "f"), ("3", "b", "toxic", None), ("4", " ", None, ""), (None, "a", "message", "f"), (" ", None, None, None)]
    df = spark.createDataFrame(rows, "candidate_id string, annotator_id string, gold_class string, gold_family_id string")
    got = sorted((r.candidate_id or "", r.issue) for r in G.annotation_issues(df, "a").collect())
    assert got == [("", "no_candidate"), (" ", "no_candidate"), ("2", "duplicate"), ("3", "class"), ("3", "no_family"), ("3", "wrong_annotator"), ("4", "class"), ("4", "no_annotator"), ("4", "no_family")]
    assert G.annotation_issues(df.where("candidate_id = '3'").withColumn("gold_class", F.lit("message")).withColumn("gold_family_id", F.lit("f"))).count() == 0
    assert G.annotation_issues(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["comparison_lanes", "annotation_issues", "gold_universe"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = QUERIES[name](spark, SF).toPandas(), con.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    assert sorted(map(tuple, got[cols].astype(str).to_numpy())) == sorted(map(tuple, want[cols].astype(str).to_numpy()))
