"""The phrase ledger: which n-grams several units of one party publish on the same day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from unisono.operators.grams import frequent, grams
from unisono.params import P
from unisono.sources.shared import cut


def eligible(stm: DataFrame, lane: int = 1) -> DataFrame:
    """One lane only, nothing syndicated, known parties."""
    return stm.where((F.col("lane") == lane) & ~F.col("syndicated") & F.col("party").isin("D", "R", "I"))


KEYS = ["doc_id", "day", "party", "congress", "unit", "bioguide"]


def occurrences(stm: DataFrame, lo: int = P.ngram_min, hi: int = P.ngram_max) -> DataFrame:
    """A row for each statement and n-gram in it that is neither template nor low in content, nor touches what the statement's
    `held` spans hold back, where `stm` has them."""
    return grams(stm, KEYS, lo, hi).drop("h")


def frequent_occurrences(stm: DataFrame, quorum: int = P.quorum) -> DataFrame:
    """The `occurrences` of n-grams that may reach the quorum somewhere, and of few others."""
    return frequent(stm, KEYS, P.ngram_min, P.ngram_max, quorum)


def cell_units(occ: DataFrame) -> DataFrame:
    """Distinct units by n-gram, day and party. Distinct rows first: both steps combine before their exchange."""
    return occ.select("ngram", "day", "party", "unit").distinct().groupBy("ngram", "day", "party").agg(F.count("*").alias("units"))


def candidates(occ: DataFrame, quorum: int = P.quorum) -> DataFrame:
    return cell_units(occ).where(F.col("units") >= quorum).select("ngram").distinct()


def df_share(occ: DataFrame, stm: DataFrame) -> DataFrame:
    """The greatest share of a stratum's statements that contain an n-gram; strata are congress and party."""
    totals = stm.groupBy("congress", "party").agg(F.count("*").alias("docs"))
    df = occ.groupBy("congress", "party", "ngram").agg(F.count_distinct("doc_id").alias("df"))
    return df.join(F.broadcast(totals), ["congress", "party"]).groupBy("ngram").agg(F.max(F.col("df") / F.col("docs")).alias("df_share"))


def ledger(stm: DataFrame, quorum: int = P.quorum, df_max: float = P.df_share_max, uses_min: int = P.total_uses_min) -> tuple[DataFrame, DataFrame]:
    """(phrases, daily); see `ledger_of`."""
    stm = eligible(stm)
    return ledger_of(stm, frequent_occurrences(stm, quorum), quorum, df_max, uses_min)


def ledger_of(stm: DataFrame, occ: DataFrame, quorum: int = P.quorum, df_max: float = P.df_share_max, uses_min: int = P.total_uses_min) -> tuple[DataFrame, DataFrame]:
    """(phrases, daily) of eligible statements and their `frequent_occurrences`, which are exact for every n-gram that reaches the
    quorum; the few others go where the totals are joined. Cells and phrases are written to the shared folder, since what is made of
    the ledger reads each several times."""
    cells = cut(cell_units(occ))
    totals = cells.groupBy("ngram").agg(F.max("units").alias("peak_units"), F.sum("units").alias("total_uses")).where((F.col("peak_units") >= quorum) & (F.col("total_uses") >= uses_min))
    units = occ.select("ngram", "unit").distinct().groupBy("ngram").agg(F.count("*").alias("distinct_units"))
    # an office publishes on a phrase's first day if and only if that is the office's first day with it
    office = occ.groupBy("ngram", "bioguide").agg(F.min(F.struct("day", "doc_id")).alias("m"))
    days = office.groupBy("ngram", F.col("m.day").alias("day")).agg(F.min(F.struct("m.doc_id", "bioguide")).alias("f"), F.collect_set("bioguide").alias("offices"))
    first = days.groupBy("ngram").agg(F.min(F.struct("day", "f.doc_id", "f.bioguide")).alias("f"), F.min_by("offices", "day").alias("offices"))
    # no office: no other is a tie
    ties = F.when(F.col("f.day").isNotNull() & F.col("f.bioguide").isNotNull(), F.array_sort(F.array_remove("offices", F.col("f.bioguide")))).otherwise(F.array().cast("array<string>"))
    phrases = cut(
        totals.join(units, "ngram").join(df_share(occ, stm), "ngram").join(first.withColumn("ties", ties), "ngram")
        .where((F.col("df_share") <= df_max) & (F.col("distinct_units") >= 2))
        .select("ngram", "peak_units", "total_uses", "distinct_units", F.round("df_share", 6).alias("df_share"), F.round(1 - F.least(F.lit(1.0), "df_share"), 3).alias("df_weight"),
                F.col("f.day").alias("first_day"), F.col("f.bioguide").alias("first_bioguide"), "ties")
    )
    return phrases, cells.join(phrases.select("ngram"), "ngram", "left_semi")


def discipline(stm: DataFrame, phrases: DataFrame, occ: DataFrame) -> DataFrame:
    """Per party and day: distinct units that use a kept phrase, at most the statements, over statements. `occ` has the occurrences of
    the phrases at least."""
    stm = eligible(stm)
    docs = stm.groupBy("party", "day").agg(F.count("*").alias("docs"))
    used = occ.join(phrases.select("ngram"), "ngram", "left_semi").select("party", "day", "unit").distinct().groupBy("party", "day").agg(F.count("*").alias("units"))
    return docs.join(used, ["party", "day"], "left").select("party", "day", "docs", F.coalesce("units", F.lit(0)).alias("units"), F.round(F.least(F.coalesce("units", F.lit(0)), "docs") / F.col("docs"), 6).alias("share"))


def merge_ledgers(shards: DataFrame) -> DataFrame:
    """Ledger rows of several shards (shard, ngram, first_day, peak_units, df_weight) as one: earliest first day (ties: lower shard), greatest peak, least weight."""
    return shards.groupBy("ngram").agg(F.min(F.struct("first_day", "shard")).alias("f"), F.max("peak_units").alias("peak_units"), F.min("df_weight").alias("df_weight"), F.count("*").alias("shards")).select(
        "ngram", F.col("f.first_day").alias("first_day"), F.col("f.shard").alias("first_shard"), "peak_units", "df_weight", "shards"
    )


def lane_check(stm: DataFrame) -> DataFrame:
    """Whether lanes partition the statements of each congress: rows, distinct ids, and ids in two lanes."""
    per_id = stm.groupBy("congress", "id").agg(F.count_distinct("lane").alias("lanes"), F.count("*").alias("n"))
    return per_id.groupBy("congress").agg(F.sum("n").alias("statements"), F.count("*").alias("ids"), F.count_if(F.col("lanes") > 1).alias("shared_ids"))


def summary(daily: DataFrame) -> DataFrame:
    """Per phrase: peak with its day (earliest) and party (D before R), span and active days."""
    best = F.max_by(F.struct("day", "party"), F.struct("units", -F.unix_date("day"), F.when(F.col("party") == "D", 2).when(F.col("party") == "R", 1).otherwise(0)))
    return daily.groupBy("ngram").agg(F.max("units").alias("peak"), best.alias("b"), F.datediff(F.max("day"), F.min("day")).alias("span"), F.count_distinct("day").alias("active_days")).select(
        "ngram", "peak", F.col("b.day").alias("peak_day"), F.col("b.party").alias("peak_party"), "span", "active_days"
    )


def daily_series(daily: DataFrame) -> DataFrame:
    """Per phrase and day the greater of the two parties' counts."""
    return daily.where("party in ('D', 'R')").groupBy("ngram", "day").agg(F.max("units").alias("units"))


def cross_party_days(daily: DataFrame, threshold: int = P.quorum) -> DataFrame:
    wide = daily.groupBy("ngram", "day").pivot("party", ["D", "R"]).agg(F.max("units"))
    return wide.where((F.col("D") >= threshold) & (F.col("R") >= threshold)).groupBy("day").agg(F.count("*").alias("phrases"))


def log_odds(daily: DataFrame, era: str, top: int = 10) -> DataFrame:
    """Per era and party the phrases with the highest smoothed log odds against the party's other eras. `era` is an expression of day."""
    here = daily.groupBy(F.expr(era).alias("era"), "party", "ngram").agg(F.sum("units").alias("n"))
    n_all = F.sum("n").over(Window.partitionBy("party", "ngram"))
    t_era, t_all = F.sum("n").over(Window.partitionBy("party", "era")), F.sum("n").over(Window.partitionBy("party"))
    rest, t_rest = n_all - F.col("n"), t_all - t_era
    scored = here.withColumn("log_odds", F.round(F.log((F.col("n") + 0.5) / (t_era - F.col("n") + 0.5)) - F.log((rest + 0.5) / (t_rest - rest + 0.5)), 6))
    order = Window.partitionBy("era", "party").orderBy(F.desc("log_odds"), F.desc("n"), "ngram")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
