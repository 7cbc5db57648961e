"""Research measures over a phrase index, daily counts and statements: widths, lifespans, ceilings, seasons, anchors and style.

A phrase index has a row for each phrase: ngram, peak, peak_day, first_day, last_day. Every measure is a grouping that
combines before its exchange; what it joins is a list of anchors or a table with a row for each year.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from unisono.functions.stats import rate


def phrase_index(daily: DataFrame) -> DataFrame:
    """The index of daily counts (ngram, day, units); the earliest of equally high days is the peak."""
    peak = F.max(F.struct("units", (-F.unix_date("day")).alias("d")))
    out = daily.groupBy("ngram").agg(peak.alias("p"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    return out.select("ngram", F.col("p.units").alias("peak"), F.date_from_unix_date((-F.col("p.d")).cast("int")).alias("peak_day"), "first_day", "last_day")


def ignition_widths(index: DataFrame, peak_min: int = 15, cap: int = 60, min_cell: int = 8) -> DataFrame:
    """Per year of the first day the median of days from there to the peak, `cap` at most; years of fewer than `min_cell` phrases are left out."""
    width = F.least(F.datediff("peak_day", "first_day"), F.lit(cap))
    rows = index.where(F.col("peak") >= peak_min).select(F.year("first_day").alias("year"), width.alias("w")).where("w >= 0")
    return rows.groupBy("year").agg(F.count("*").alias("n"), F.median("w").alias("width")).where(F.col("n") >= min_cell)


def lifespans(index: DataFrame, peak_min: int = 10, min_cell: int = 8) -> DataFrame:
    """Per year of birth the median of days from a phrase's first day to its last, over all its rows that reach `peak_min`."""
    one = index.where(F.col("peak") >= peak_min).groupBy("ngram").agg(F.min("first_day").alias("a"), F.max("last_day").alias("b"))
    return one.groupBy(F.year("a").alias("year")).agg(F.count("*").alias("n"), F.median(F.datediff("b", "a")).alias("lifespan")).where(F.col("n") >= min_cell)


def sync_ceiling(index: DataFrame, active: DataFrame) -> DataFrame:
    """Per year of the peak day the highest peak over the year's active offices (year, active); years without any are left out."""
    top = index.groupBy(F.year("peak_day").alias("year")).agg(F.max("peak").alias("peak"))
    return top.join(active.where("active > 0"), "year").select("year", "peak", F.round(F.col("peak") / F.col("active"), 6).alias("ceiling"))


def month_effect(index: DataFrame, months: DataFrame, month: int = 8, peak_min: int = 15) -> DataFrame:
    """First days per thousand statements in one month of the year and in the others; `months` has (month, n), the first of each month."""
    inside = lambda d: F.month(d) == month
    firsts = index.where(F.col("peak") >= peak_min).agg(F.count_if(inside("first_day")).alias("i"), F.count_if(~inside("first_day")).alias("o"))
    base = months.agg(F.sum(F.when(inside("month"), F.col("n"))).alias("ni"), F.sum(F.when(~inside("month"), F.col("n"))).alias("no"))
    a, b = rate(F.col("i"), F.col("ni")), rate(F.col("o"), F.col("no"))
    return firsts.join(base).select(F.round(a, 6).alias("inside"), F.round(b, 6).alias("outside"), F.round(F.try_divide(a, b), 6).alias("ratio"))


def ingroup_share(stm: DataFrame) -> DataFrame:
    """Per party the share of statements that belong to a release of several offices."""
    rows = stm.where("party in ('D', 'R')").groupBy("party").agg(F.count("*").alias("n"), F.count("joint_group").alias("joint"))
    return rows.withColumn("share", F.round(F.col("joint") / F.col("n"), 6))


def snap(index: DataFrame, anchors: DataFrame, window: int = 90, prior: int = 270) -> DataFrame:
    """Per anchor and party sum(m) / sum(s) in the `window` days up to the anchor and in those before, back to `prior`.

    `index` has (party, day, s, m), a row a day; `anchors` is a list of days. The anchor's own day counts in neither.
    """
    lead = F.datediff("anchor", "day")
    rows = index.join(F.broadcast(anchors), (lead > 0) & (lead <= prior))
    share = lambda c: F.try_divide(F.sum(F.when(c, F.col("m"))), F.sum(F.when(c, F.col("s"))))
    out = rows.groupBy("anchor", "party").agg(share(lead <= window).alias("pre"), share(lead > window).alias("prior"))
    return out.select("anchor", "party", F.round("pre", 6).alias("pre"), F.round("prior", 6).alias("prior"), F.coalesce(F.col("pre") > F.col("prior"), F.lit(False)).alias("snap"))


def gravity(by_day: DataFrame, window: int = 21) -> DataFrame:
    """Per year the highest day of (day, n), and the days until a count is below half of it: a day without a row has none, a year ends its own search.

    The search ends at the first missing or low day, so it needs the run of high days that follows the peak: of these the k-th lies k days on.
    """
    rows = by_day.withColumn("year", F.year("day"))
    peak = rows.groupBy("year").agg(F.max(F.struct("n", (-F.unix_date("day")).alias("d"))).alias("p")).select("year", F.col("p.n").alias("peak"), F.date_from_unix_date((-F.col("p.d")).cast("int")).alias("peak_day"))
    later = F.datediff("day", "peak_day")
    high = rows.join(peak, "year").where((later > 0) & (later < window) & (2 * F.col("n") >= F.col("peak"))).select("year", later.alias("k"))
    run = high.withColumn("r", F.row_number().over(Window.partitionBy("year").orderBy("k"))).where("r = k").groupBy("year").agg(F.max("k").alias("k"))
    return peak.join(run, "year", "left").select("year", "peak", "peak_day", (F.coalesce("k", F.lit(0)) + 1).alias("half_life"))


def monthly_counts(stm: DataFrame) -> DataFrame:
    return stm.groupBy(F.date_format("day", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"))


def statement_meta(stm: DataFrame) -> DataFrame:
    """Per year and weekday (0 is Monday) statements, and the year's active offices."""
    offices = stm.groupBy(F.year("day").alias("year")).agg(F.count_distinct("bioguide").alias("offices"))
    return stm.groupBy(F.year("day").alias("year"), F.weekday("day").alias("wd")).agg(F.count("*").alias("n")).join(F.broadcast(offices), "year")  # a row for each year


def persistence(daily: DataFrame, start: str, end: str) -> DataFrame:
    """Per phrase its active days and span within [start, end)."""
    rows = daily.where((F.col("day") >= F.lit(start).cast("date")) & (F.col("day") < F.lit(end).cast("date")))
    return rows.groupBy("ngram").agg(F.count_distinct("day").alias("active_days"), F.datediff(F.max("day"), F.min("day")).alias("span"))


def marks(text: Column) -> dict[str, Column]:
    """Counts of semicolons, exclamation marks and sentence ends, and whether a word of four capitals or more occurs."""
    n = lambda p: F.regexp_count(text, F.lit(p))
    return {"semicolons": n(";"), "exclamations": n("!"), "ends": n(r"[.!?]+(\s|$)"), "capitals": text.rlike(r"\b[A-Z]{4,}\b")}


def style_rates(rows: DataFrame, period: str) -> DataFrame:
    """Per period semicolons per thousand sentence ends and exclamation marks per statement; `rows` has the columns of `marks`."""
    out = rows.groupBy(period).agg(F.sum("semicolons").alias("s"), F.sum("exclamations").alias("e"), F.sum("ends").alias("t"), F.count("*").alias("n"))
    return out.select(period, F.round(rate(F.col("s"), F.col("t")), 6).alias("semicolons"), F.round(F.col("e") / F.col("n"), 6).alias("exclamations"))


def first_marked(rows: DataFrame, flag: str) -> DataFrame:
    """The earliest row with a mark; on one day the least doc_id."""
    return rows.where(F.col(flag)).groupBy().agg(F.min(F.struct("day", "doc_id", "bioguide", "party")).alias("f")).where("f is not null").select("f.*")
