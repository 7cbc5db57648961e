"""Surges of a phrase against its own calendar, with false-discovery control."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from unisono.functions.stats import binomial_tail
from unisono.params import P


def calendar(denominators: DataFrame, days: int = P.surge_window, weekday: bool = False) -> DataFrame:
    """Each party day with trials, and the days of its baseline: the last `days` earlier ones with trials (of the same weekday)."""
    keys = ["party", F.weekday("day")] if weekday else ["party"]
    w = Window.partitionBy(*keys).orderBy("day").rowsBetween(-days, -1)
    rows = denominators.where("trials > 0")
    return rows.select("party", "day", "trials", F.sum("trials").over(w).alias("base_trials"), F.min("day").over(w).alias("base_from"), F.max("day").over(w).alias("base_to"), F.weekday("day").alias("wd"))


def baselines(daily: DataFrame, denominators: DataFrame, weekday: bool = False, days: int = P.surge_window) -> DataFrame:
    """Rows (phrase, party, day, k, n, base_k, base_n, prior_share): days without the phrase count as zero.

    A range join of a phrase's own days; no row is made for its zero days.
    """
    cal = calendar(denominators, days, weekday)
    now = daily.join(cal, ["party", "day"]).where("successes > 0")
    then = daily.select(F.col("phrase").alias("_p"), F.col("party").alias("_q"), F.col("day").alias("_d"), F.col("successes").alias("_s"))
    cond = (F.col("phrase") == F.col("_p")) & (F.col("party") == F.col("_q")) & (F.col("_d") >= F.col("base_from")) & (F.col("_d") <= F.col("base_to"))
    if weekday:
        cond = cond & (F.weekday("_d") == F.col("wd"))
    keys = ["phrase", "party", "day", "successes", "trials", "base_trials", "base_to"]
    hit = now.join(then, cond, "left").groupBy(*keys).agg(F.coalesce(F.sum("_s"), F.lit(0)).alias("base_k"), F.max(F.when(F.col("_d") == F.col("base_to"), F.col("_s"))).alias("_last"))
    last = cal.select("party", F.col("day").alias("base_to"), F.col("trials").alias("_lt"))
    return hit.join(last, ["party", "base_to"], "left").select(
        "phrase", "party", "day", F.col("successes").alias("k"), F.col("trials").alias("n"), "base_k", F.coalesce("base_trials", F.lit(0)).alias("base_n"),
        F.when(F.col("_lt").isNotNull(), F.coalesce("_last", F.lit(0)) / F.col("_lt")).alias("prior_share"),
    )


def measure(base: DataFrame, alpha: float = P.surge_alpha) -> DataFrame:
    """Share, smoothed baseline, ratio, change, binomial p, skew and spread change."""
    b = F.least((F.col("base_k") + alpha) / (F.col("base_n") + 2 * alpha), F.lit(1.0))
    share = F.col("k") / F.col("n")
    rows = base.withColumn("share", share).withColumn("base", b).withColumn("ratio", share / b).withColumn("change", share - b)
    rows = rows.withColumn("p", binomial_tail(F.least("k", "n"), F.col("n"), F.col("base"))).withColumn("spread", F.col("share") - F.coalesce("prior_share", F.lit(0.0)))
    w = Window.partitionBy("phrase", "day")
    side = lambda x: F.coalesce(F.max(F.when(F.col("party") == x, F.col("share"))).over(w), F.lit(0.0))
    return rows.withColumn("skew", F.abs(side("D") - side("R")))


def benjamini_hochberg(rows: DataFrame, by: str = "day") -> DataFrame:
    """Step-up adjusted p over all rows of a day. Ranks and running minima need a day's rows in order; a day has as many as phrases offered on it."""
    up = Window.partitionBy(by).orderBy("p", "phrase", "party")
    m = F.count("*").over(Window.partitionBy(by))
    ranked = rows.withColumn("_r", F.row_number().over(up)).withColumn("_q", F.col("p") * m / F.col("_r"))
    down = Window.partitionBy(by).orderBy(F.desc("_r")).rowsBetween(Window.unboundedPreceding, 0)
    return ranked.withColumn("q", F.least(F.lit(1.0), F.min("_q").over(down))).drop("_r", "_q")


def gated(rows: DataFrame) -> DataFrame:
    return rows.withColumn("surge", (F.col("change") >= P.surge_change) & (F.col("ratio") >= P.surge_ratio) & (F.col("q") <= P.surge_q))


def surges(daily: DataFrame, denominators: DataFrame, weekday: bool = False) -> DataFrame:
    return gated(benjamini_hochberg(measure(baselines(daily, denominators, weekday))))


RANKINGS = {
    "repeated": ("true", ["k desc"]),
    "deviation": ("true", ["q", "ratio desc", "k desc"]),
    "surge": ("surge", ["q", "ratio desc", "k desc"]),
    "skew": ("true", ["skew desc"]),
    "spread": ("true", ["spread desc"]),
}


def rankings(rows: DataFrame, limit: int = 50) -> DataFrame:
    """Independent orderings of a day, each with phrase and party as last keys."""
    out = None
    for name, (cond, keys) in RANKINGS.items():
        w = Window.partitionBy("day").orderBy(*(F.desc(k[:-5]) if k.endswith(" desc") else F.asc(k) for k in keys), "phrase", "party")
        one = rows.where(cond).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit).select(F.lit(name).alias("ranking"), "day", "phrase", "party", "rank")
        out = one if out is None else out.unionByName(one)
    return out


def overdispersion(daily: DataFrame, denominators: DataFrame, days: int = P.surge_window) -> DataFrame:
    """Pearson dispersion by phrase and party over the party's last `days` days with trials before the latest day, three at least.

    Days without the phrase count as zero; phrases on none or all of the trials have no dispersion. With p the share over
    all days, the sum of (s - t p)^2 / (t p (1 - p)) is (sum of s^2 / t - p * sum of s) / (p (1 - p)), so zero days need no rows.
    """
    rows = denominators.where("trials > 0").join(F.broadcast(denominators.agg(F.max("day").alias("_until"))), F.col("day") < F.col("_until"))
    last = rows.withColumn("_r", F.row_number().over(Window.partitionBy("party").orderBy(F.desc("day")))).where(F.col("_r") <= days).select("party", "day", "trials")
    whole = last.groupBy("party").agg(F.count("*").alias("days"), F.sum("trials").alias("all"))
    sums = daily.join(last, ["party", "day"]).groupBy("phrase", "party").agg(F.sum("successes").alias("hits"), F.sum(F.col("successes") * F.col("successes") / F.col("trials")).alias("squares"))
    p = F.col("hits") / F.col("all")
    out = sums.join(whole, "party").where((F.col("days") >= 3) & (p > 0) & (p < 1))
    return out.select("phrase", "party", "days", F.round((F.col("squares") - p * F.col("hits")) / (p * (1 - p)) / (F.col("days") - 1), 6).alias("dispersion"))


def first_observed(phrases: DataFrame) -> DataFrame:
    """The first office, withheld where others published the phrase on the same day."""
    return phrases.select("ngram", "first_day", F.when(F.size("ties") == 0, F.col("first_bioguide")).alias("originator"))
