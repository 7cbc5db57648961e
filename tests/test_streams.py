"""Streams against tables, and batches that are run again."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from unisono.streaming import corrections as LC
from unisono.streaming import incremental as A

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "correction_id string, ts timestamp, step string, severity string"


def _events(spark, folder, parts):
    """Each part a file, read in this order."""
    import os
    import time

    for i, rows in enumerate(parts):
        made = [(c, T0 + dt.timedelta(hours=h), s, v) for c, h, s, v in rows]
        spark.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        for f in os.listdir(folder):
            path = f"{folder}/{f}"
            if f.endswith(".parquet") and os.path.getmtime(path) > time.time() - 3600 * 24 * 300:
                os.utime(path, (1_000_000_000 + i, 1_000_000_000 + i))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


PARTS = [
    [("a", 0, "detected", "critical"), ("b", 0, "detected", "minor"), ("c", 1, "acknowledged", "major")],
    [("a", 0.5, "acknowledged", "critical"), ("b", 1, "corrected", "minor"), ("x", 5, "nonsense", "minor")],
    [("a", 30, "corrected", "critical"), ("c", 30, "detected", "major"), ("b", 40, "acknowledged", "minor")],
    [("d", 500, "detected", "minor")],
]


def test_lifecycle_stream_ends_like_the_table(spark, tmp_path):
    """Steps out of order, a deadline met, one missed, one not due, an unknown step."""
    stream = LC.lifecycle_stream(_events(spark, f"{tmp_path}/in", PARTS))
    A.by_batch(stream, f"{tmp_path}/out", f"{tmp_path}/check")
    got = {r.correction_id: r for r in LC.latest(A.batches(spark, f"{tmp_path}/out", stream.schema), "correction_id").collect()}
    events = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/in")
    want = {r.correction_id: r for r in LC.lifecycle_table(events, F.lit(T0 + dt.timedelta(hours=499))).collect()}
    assert got == want
    assert (got["a"].state, got["a"].late_acknowledge, got["a"].late_correct) == ("acknowledged", False, True)
    assert (got["b"].state, got["b"].late_acknowledge, got["b"].late_correct) == ("acknowledged", False, False)
    assert (got["c"].state, got["c"].late_correct, got["d"].late_acknowledge) == ("detected", True, False)


def test_a_batch_that_fails_after_its_write_is_not_doubled(spark, tmp_path):
    stream = _events(spark, f"{tmp_path}/in", PARTS)
    failed = []

    def fail(_, batch):
        if batch == 1 and not failed:
            failed.append(batch)
            raise RuntimeError("lost between write and commit")

    with pytest.raises(Exception, match="lost between write and commit"):
        A.by_batch(stream, f"{tmp_path}/out", f"{tmp_path}/check", "append", fail)
    A.by_batch(stream, f"{tmp_path}/out", f"{tmp_path}/check", "append", fail)
    rows = A.batches(spark, f"{tmp_path}/out", stream.schema)
    assert failed == [1] and rows.count() == sum(map(len, PARTS)) and rows.select("batch").distinct().count() == 4
    A.by_batch(stream, f"{tmp_path}/out", f"{tmp_path}/check", "append")  # nothing new
    assert A.batches(spark, f"{tmp_path}/out", stream.schema).count() == rows.count()


def test_sliding_counts(spark, tmp_path):
    stream = _events(spark, f"{tmp_path}/in", PARTS[:2]).withColumnRenamed("step", "phrase")
    got = {(str(r.start), r.phrase): r.n for r in A.drain(A.sliding_counts(stream), ["start", "phrase"]).collect()}
    assert got["2024-01-01", "detected"] == 2 and got["2023-12-26", "acknowledged"] == 2 and len([k for k in got if k[1] == "corrected"]) == 7


class _Handle:
    """Counts what goes to the JVM."""

    def __init__(self):
        self.calls, self.timers, self.value = [], set(), None

    def getValueState(self, *_):
        return self

    def get(self):
        self.calls.append("get")
        return self.value

    def exists(self):
        self.calls.append("exists")
        return self.value is not None

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def listTimers(self):
        self.calls.append("list")
        return iter(self.timers)

    def deleteTimer(self, t):
        self.calls.append("delete")
        self.timers.remove(t)

    def registerTimer(self, t):
        self.calls.append("register")
        self.timers.add(t)


def test_a_batch_of_a_correction_takes_few_calls():
    from pyspark.sql import Row

    hour = 3_600_000_000
    h, one = _Handle(), LC.Lifecycle()
    one.init(h)
    rows = lambda *x: iter([Row(step=s, us=int(t * hour), severity=v) for s, t, v in x])
    list(one.handleInputRows(("a",), rows(("detected", 10, "critical"), ("acknowledged", 10.5, "critical")), None))
    assert h.calls == ["get", "register", "update"] and h.timers == {34 * hour // 1000}
    list(one.handleInputRows(("a",), rows(("contained", 11, "critical")), None))
    assert h.calls[3:] == ["get", "update"]
    list(one.handleInputRows(("a",), rows(("detected", 9, "critical")), None))  # the deadline that was met is missed now
    assert h.timers == {10 * hour // 1000, 33 * hour // 1000}
