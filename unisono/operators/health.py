"""Readiness, streaks, windows over days, spend and status."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from unisono.params import P

SEVERITY = ("unknown", "neutral", "green", "amber", "red", "critical")


def expected_volume(counts: DataFrame, weeks: int = 6, recent: int = 3) -> DataFrame:
    """Per day the median of the same weekday in the weeks before, or that of the recent ones where all are there and lower."""
    prior = counts.select(F.col("day").alias("_d"), F.col("n").alias("_n"))
    lag = F.datediff("day", "_d")
    hit = counts.join(prior, (lag > 0) & (lag <= 7 * weeks) & (lag % 7 == 0), "left")
    near = F.when(lag <= 7 * recent, F.col("_n"))
    agg = hit.groupBy("day", "n").agg(F.count("_n").alias("observations"), F.median("_n").alias("_long"), F.count(near).alias("_k"), F.median(near).alias("_short"))
    return agg.select("day", "n", "observations", F.when((F.col("_k") == recent) & (F.col("_short") < F.col("_long")), F.col("_short")).otherwise(F.col("_long")).alias("expected"))


def readiness(counts: DataFrame) -> DataFrame:
    """A day is ready at 40 % of what is expected; where that can't be judged it counts as ready."""
    e = expected_volume(counts)
    able = (F.col("expected") >= P.ready_floor) & (F.col("observations") >= 2)
    ready = F.when(~F.coalesce(able, F.lit(False)), True).otherwise(F.col("n") / F.nullif(F.col("expected"), F.lit(0.0)) >= P.ready_ratio)
    return e.withColumn("judgeable", F.coalesce(able, F.lit(False))).withColumn("ready", ready)


def select_target_day(ready: dict[date, tuple[bool, int]], final: set[date], product_day: date, lookback: int = 5, max_wait: int = 2) -> tuple[date | None, str]:
    """The oldest open day that may be published, and why. Six days at most."""
    for age in range(lookback, -1, -1):
        day = product_day - timedelta(days=age)
        if day in final:
            continue
        ok, n = ready.get(day, (True, 0))
        if ok and n >= 1:
            return day, "ready"
        if age >= max_wait:
            if n < 1:
                continue
            return day, "forced"
        return None, "held"
    return None, "done"


def streaks(days: DataFrame, by: list[str]) -> DataFrame:
    """Runs of adjacent days."""
    rows = days.select(*by, "day").distinct()
    w = Window.partitionBy(*by).orderBy("day")
    island = F.date_sub("day", F.row_number().over(w))
    return rows.withColumn("_i", island).groupBy(*by, "_i").agg(F.min("day").alias("start"), F.max("day").alias("stop"), F.count("*").alias("length")).drop("_i")


def windowed_share(rows: DataFrame, by: list[str], part: str, whole: str, days: int) -> DataFrame:
    """Share of `part` in `whole` over the `days` calendar days that end at each day."""
    w = Window.partitionBy(*by).orderBy(F.unix_date("day")).rangeBetween(-(days - 1), 0)
    return rows.withColumn("part_sum", F.sum(part).over(w)).withColumn("whole_sum", F.sum(whole).over(w)).withColumn("share", F.round(F.try_divide("part_sum", "whole_sum"), 6))


def drop_verdict(rows: DataFrame, floor: int = 30) -> DataFrame:
    """red at a quarter dropped of at least `floor` offered; fewer offered: unknown, with the counts kept."""
    return rows.withColumn("verdict", F.when(F.col("whole_sum") < floor, "unknown").when(F.col("share") >= 0.25, "red").otherwise("green"))


def spend(costs: DataFrame) -> DataFrame:
    """Month to date by day, and the projection to the month's end at the pace so far."""
    month = F.trunc("day", "month")
    w = Window.partitionBy(month).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    daily = costs.groupBy("day").agg(F.sum("usd").alias("usd"))
    mtd, seen = F.sum("usd").over(w), F.count("*").over(w)
    return daily.select("day", F.round(mtd, 6).alias("month_to_date"), F.round(mtd + mtd / seen * F.datediff(F.last_day("day"), "day"), 6).alias("projection"))


def worst(checks: DataFrame, by: list[str]) -> DataFrame:
    """The most severe status of a group; a null one is unknown."""
    rank = F.array_position(F.array(*map(F.lit, SEVERITY)), F.coalesce("status", F.lit("unknown")))
    return checks.groupBy(*by).agg(F.element_at(F.array(*map(F.lit, SEVERITY)), F.max(rank).cast("int")).alias("status"))


def latest_complete(*stages: DataFrame) -> DataFrame:
    """The newest day that every stage has."""
    days = stages[0].select("day")
    for s in stages[1:]:
        days = days.intersect(s.select("day"))
    return days.agg(F.max("day").alias("day"))


def coverage_gate(units: DataFrame) -> DataFrame:
    """Per source: at least five members of each party, parties at least 1 : 3, two fifths attributed, provenance complete."""
    a = units.groupBy("source").agg(*(F.count_distinct(F.when(F.col("party") == p, F.col("member_id"))).alias(n) for p, n in (("D", "d"), ("R", "r"))), F.avg(F.col("member_id").isNotNull().cast("double")).alias("attributed"), F.bool_and(F.col("url").isNotNull()).alias("provenance"))
    ok = (F.least("d", "r") >= 5) & (F.least("d", "r") * 3 >= F.greatest("d", "r")) & (F.col("attributed") >= 0.4) & F.col("provenance")
    return a.select("source", "d", "r", F.round("attributed", 6).alias("attributed"), "provenance", ok.alias("passed"))
