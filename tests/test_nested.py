"""Nested redaction, purging and the SQL surface: known answers."""

import os

import pytest
from pyspark.sql import functions as F

from unisono import sql
from unisono.operators import nested
from unisono.operators.spans import redact

SF = "/root/testdata/sf0.001"
KIND = "id long, `a.b` string, s struct<t:string,n:int,l:array<struct<u:string>>>, m map<string,map<string,string>>, d array<double>"
ROWS = [
    (1, "mail a@b.test", ("x", 1, [("call 555-123-4567",), (None,)]), {"c@d.test": {"k": "e@f.test"}}, [1.0]),
    (2, "nothing", (None, None, None), {"k": None}, None),
    (3, None, None, None, []),
]


def test_strings_at_any_depth_and_keys(spark):
    df = spark.createDataFrame(ROWS, KIND)
    got = {r.id: r for r in nested.redact_rows(df, redact).collect()}
    assert got[1]["a.b"] == "mail [email]" and got[1].s.l[0].u == "call [phone]" and got[1].s.l[1].u is None
    assert got[1].m == {"[email]": {"k": "[email]"}} and got[1].changed
    assert [tuple(got[i])[:-1] for i in (2, 3)] == [tuple(r) for r in df.where("id > 1").orderBy("id").collect()]
    assert not got[2].changed and not got[3].changed
    out = nested.redact_rows(df, redact)
    assert out.drop("changed").schema.simpleString() == df.schema.simpleString()
    again = nested.redact_rows(out.drop("changed"), redact)
    assert again.where("changed").count() == 0


def test_keys_that_would_become_one_are_an_error(spark):
    df = spark.createDataFrame([(1, {"a@b.test": "1", "c@d.test": "2"})], "id long, m map<string,string>")
    with pytest.raises(Exception, match="two keys would become one"):
        nested.redact_rows(df, redact).collect()


def test_purge_touches_only_what_it_must(spark, tmp_path):
    rows = [("x", "keep", 1), ("x", "bad", 2), ("y", "keep", 3), ("z", "bad", 4), ("z", None, 5), ("w", "bad", 6)]
    df = spark.createDataFrame(rows, "p string, ngram string, n int")
    path = f"{tmp_path}/t"
    df.write.partitionBy("p").parquet(path)
    before = {f: os.stat(f"{path}/p=y/{f}").st_mtime_ns for f in os.listdir(f"{path}/p=y")}
    assert nested.purge(df, path, "p", F.col("ngram") == "bad") == 3
    assert {r.n for r in spark.read.parquet(path).collect()} == {1, 3, 5}
    assert before == {f: os.stat(f"{path}/p=y/{f}").st_mtime_ns for f in os.listdir(f"{path}/p=y")}
    assert nested.purge(df, path, "p", F.col("ngram") == "bad") == 0


def test_sql_surface(spark):
    sql.register(spark, SF)
    assert spark.sql("select count(*) from documents").first()[0] == spark.read.parquet(f"{SF}/documents.parquet").count() == spark.sql("select count(*) from statements").first()[0]
    row = spark.sql("select content_words('war in iran') as n, is_low_content('at the same time') as low, is_template('committee on rules') as t, sentence_spans('Aa bb. Cc dd.') as s").first()
    assert (row.n, row.low, row.t, [(x.start, x.end) for x in row.s]) == (2, True, True, [(0, 6), (7, 13)])
    got = spark.sql("select * from phrase_occurrences('We say clean  Water and clean-water; CLEAN water!', 'clean water', 2)").collect()
    assert [tuple(r) for r in got] == [(7, 19, "we say", "and clean-water"), (37, 48, "and clean-water", "")]
    assert spark.sql("select * from phrase_occurrences(null, 'x', 2)").count() == 0
