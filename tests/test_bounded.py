"""Counts, holders, shared grams, windows of names and held spans against plain versions of their rules."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from unisono.functions import offsets as O
from unisono.functions import text as X
from unisono.operators import claims as C
from unisono.operators import grams as GR
from unisono.operators import names as NA
from unisono.operators import spans as N

TEXTS = [
    (1, "The department of clean water acts fast now. Clean water acts fast now!"),
    (2, "Clean water acts fast now. On monday the people speak again. The people speak again."),
    (3, None),
    (4, ""),
    (5, "of the and to a. of the and to a."),
    (6, "Brave people speak again today. Nothing else is shared here."),
]


def _docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string")


def test_gram_counts(spark):
    docs = _docs(spark)
    for least, templates in ((0, True), (2, False)):
        g = docs.select("doc_id", F.explode(X.doc_ngrams(F.col("text"), 3, 6)).alias("g")).where(X.content_words(F.col("g")) >= least)
        plain = g if templates else g.where(~X.is_template(F.col("g")))
        want = {r[0]: r[1] for r in plain.groupBy("doc_id").count().collect()}
        assert {r[0]: r[1] for r in GR.gram_counts(docs, ["doc_id"], 3, 6, least, templates).collect()} == want


def test_holders_keep_templates(spark):
    phrases = spark.createDataFrame([("on monday the",), ("clean water acts",), ("not said here",)], "ngram string")
    assert sorted(map(tuple, GR.holders(_docs(spark), ["doc_id"], phrases, 3, 3).collect())) == [(1, "clean water acts"), (2, "clean water acts"), (2, "on monday the")]


def test_components_of_shared_grams(spark):
    rows = _docs(spark).select("doc_id", "text", F.lit("D").alias("party"), F.lit("2024-01-01").cast("date").alias("day"))
    shared = C.shared_grams(rows, "doc_id")
    assert {r[0] for r in shared.select("doc_id").distinct().collect()} == {1, 2}
    want = sorted(map(tuple, C.fragment_components(C.cluster_grams(rows, "doc_id"), "doc_id").collect()))
    assert sorted(map(tuple, C.fragment_components(shared, "doc_id").collect())) == want == [(1, 1), (2, 1)]


def test_windows_of_names_come_in_bounded_parts():
    class Bits:
        value = np.full(1 << 12, 255, np.uint8)  # every window may be a name

    texts = [["a", "b", "c"] * 200 for _ in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(500), pa.int64()), pa.array(texts)], ["doc_id", "toks"])
    out = list(NA._windows(Bits(), [2])([batch]))
    assert all(b.num_rows <= NA.SLICE for b in out)
    assert sum(b.num_rows for b in out) == 500 * 599
    assert out[-1].to_pylist()[-1] == {"doc_id": 499, "first": 598, "n": 2, "year": 0, "name": "b c"}


def test_sentence_spans_hold_no_objects(spark):
    rows = _docs(spark).select("doc_id", "text", O.sentence_spans(F.col("text")).alias("s")).collect()
    assert all([(x.start, x.end) for x in r.s] == O.whole_sentences(r.text) for r in rows)


def test_suppressed_spans_by_one_keyed_state(spark):
    forms = {N.form_digest(f, "salt") for f in ("clean water", "people speak again", "now")}
    got = {r[0]: [(x.start, x.end) for x in r[1]] for r in _docs(spark).select("doc_id", N.suppressed_spans(F.col("text"), forms, "salt")).collect()}
    assert got[3] == got[4] == got[5] == []
    assert [TEXTS[0][1][a:b] for a, b in got[1]] == ["clean water", "now", "Clean water", "now"]
    assert [TEXTS[5][1][a:b] for a, b in got[6]] == ["people speak again"]
    long = "s" * 100
    held = N.suppressed_spans(F.col("text"), {N.form_digest("clean water", long)}, long)
    assert _docs(spark).select(F.sum(F.size(held))).first()[0] == 3
