"""The life of corrections as a stream: a state machine for each, with deadlines as event-time timers, and the same from a table."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STEPS = ["detected", "acknowledged", "contained", "corrected", "closed"]
#: Hours until a correction must be acknowledged and corrected.
POLICY = {"critical": (1, 24), "major": (24, 72), "minor": (72, 336)}
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_TIMES = [f"{s}_at" for s in STEPS]
RAW = "correction_id string, severity string, " + ", ".join(f"{t} long" for t in _TIMES) + ", state string, late_acknowledge boolean, late_correct boolean"
_OUT = Row("correction_id", "severity", *_TIMES, "state", "late_acknowledge", "late_correct")
SCHEMA = "correction_id string, severity string, " + ", ".join(f"{t} timestamp" for t in _TIMES) + ", state string, late_acknowledge boolean, late_correct boolean"


def _furthest(times: list) -> str:
    """The last step that is reached in order: every step before it has been seen, none later than the next."""
    state, last = "none", None
    for step, at in zip(STEPS, times, strict=True):
        if at is None or (last is not None and at < last):
            break
        state, last = step, at
    return state


def _open(kept: list) -> list[tuple[int, int]]:
    """(flag, deadline) of what is kept, for the deadlines that no step has met so far."""
    if kept[1] is None or kept[0] not in POLICY:
        return []
    due = [(flag, step, kept[1] + hours * 3_600_000_000) for flag, step, hours in zip((6, 7), (2, 4), POLICY[kept[0]], strict=True)]
    return [(flag, at) for flag, step, at in due if kept[step] is None or kept[step] > at]


class Lifecycle(StatefulProcessor):
    """Keeps the first time of each step and the deadlines that have passed. Events may come in any order."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._kept = handle.getValueState("kept", "severity string, " + ", ".join(f"{s} long" for s in STEPS) + ", late_a boolean, late_c boolean")

    def _load(self) -> list:
        kept = self._kept.get()
        return [None] * 6 + [False, False] if kept is None else list(kept)

    def _row(self, key: str, kept: list) -> Row:
        return _OUT(key, kept[0], *kept[1:6], _furthest(kept[1:6]), bool(kept[6]), bool(kept[7]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        kept = self._load()
        before = {due // 1000 for _, due in _open(kept)}
        for r in rows:
            i = 1 + STEPS.index(r["step"])
            kept[i] = r["us"] if kept[i] is None else min(kept[i], r["us"])
            kept[0] = r["severity"] if kept[0] is None else kept[0] if r["severity"] is None else min(kept[0], r["severity"])
        # each call of the handle goes to the JVM and back: timers are touched where they change
        after = {due // 1000 for _, due in _open(kept)}
        for timer in before - after:
            self._handle.deleteTimer(timer)
        for timer in after - before:
            self._handle.registerTimer(timer)
        self._kept.update(tuple(kept))
        yield self._row(key[0], kept)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        kept = self._load()
        now = expiredTimerInfo.getExpiryTimeInMs()
        for flag, due in _open(kept):
            if due // 1000 <= now:
                kept[flag] = True
        self._kept.update(tuple(kept))
        yield self._row(key[0], kept)


def lifecycle_stream(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each correction whenever it changes (update mode): first time of each step, how far it is, and whether a deadline passed without
    its step. `events` is a stream of correction_id, ts, step, severity; of several severities the least counts. A deadline passes
    when the watermark does. State is one small record for each correction."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    rows = events.where(F.col("step").isin(*STEPS)).withWatermark("ts", late).select("correction_id", "ts", "step", "severity", F.unix_micros("ts").alias("us"))
    out = rows.groupBy("correction_id").transformWithState(statefulProcessor=Lifecycle(), outputStructType=RAW, outputMode="Update", timeMode="eventTime")
    return out.select(*(F.timestamp_micros(c).alias(c) if c in _TIMES else c for c in out.columns))


def lifecycle_table(events: DataFrame, now) -> DataFrame:
    """The same from a table, with `now` (a column) in place of the watermark."""
    times = [F.min(F.when(F.col("step") == s, F.col("ts"))).alias(t) for s, t in zip(STEPS, _TIMES, strict=True)]
    one = events.where(F.col("step").isin(*STEPS)).groupBy("correction_id").agg(F.min("severity").alias("severity"), *times)
    state = F.lit("none")
    ok = F.lit(True)
    for i, (s, t) in enumerate(zip(STEPS, _TIMES, strict=True)):
        ok = ok & F.col(t).isNotNull() & (F.lit(True) if not i else F.col(t) >= F.col(_TIMES[i - 1]))
        state = F.when(ok, s).otherwise(state)

    def missed(step: str, which: int):
        hours = F.coalesce(*(F.when(F.col("severity") == k, F.lit(v[which])) for k, v in POLICY.items()))
        due = F.timestamp_micros(F.unix_micros("detected_at") + hours * 3_600_000_000)
        return F.coalesce((due < now) & (F.col(step).isNull() | (F.col(step) > due)), F.lit(False))

    return one.select("correction_id", "severity", *_TIMES, state.alias("state"), missed("acknowledged_at", 0).alias("late_acknowledge"), missed("corrected_at", 1).alias("late_correct"))


def latest(batches: DataFrame, *key: str) -> DataFrame:
    """The last row of each key by batch and, within one, by the deadlines it knows to have passed."""
    order = Window.partitionBy(*key).orderBy(F.desc("batch"), F.desc(F.col("late_acknowledge").cast("int") + F.col("late_correct").cast("int")))
    return batches.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r", "batch")
