"""Records of two sources linked in tiers: contests from their result rows, and the term that each winner was seated for."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from unisono.sources.shared import small

SEAT = ["cycle", "state", "district", "special"]
RELAXED = ("relaxed", "relaxed+date")


def contests(rows: DataFrame) -> DataFrame:
    """One record for each decided contest: SEAT, winner, party, winner_votes, runnerup_votes, total_votes, mov.

    `rows` has SEAT, stage, candidate, party, votes. Stages are general ('' too) or runoff; a contest with a runoff counts that alone. A
    candidate's votes are summed over lines and modes; the winner's party is that of the largest line. Ties go to the lesser name.
    Rows without year or candidate are left out, contests without votes undecided. `special` keeps two races for seats of one
    state apart.
    """
    stage = F.lower(F.trim(F.coalesce("stage", F.lit(""))))
    kept = rows.where(F.col("cycle").isNotNull() & (stage.contains("gen") | stage.contains("runoff") | (stage == ""))).withColumn("_runoff", stage.contains("runoff"))
    who = F.upper(F.trim(F.coalesce("candidate", F.lit(""))))
    # lines are summed for both kinds of stage, so that few rows are left when a contest's kind is known
    lines = kept.withColumn("candidate", who).groupBy(*SEAT, "_runoff", "candidate", F.trim(F.coalesce("party", F.lit(""))).alias("party")).agg(F.sum("votes").alias("votes"))
    seat = Window.partitionBy(*SEAT)
    lines = lines.withColumn("_use", F.max("_runoff").over(seat)).where((F.col("_runoff") == F.col("_use")) & (F.col("candidate") != ""))
    one = lines.groupBy(*SEAT, "candidate").agg(F.sum("votes").alias("votes"), F.min(F.struct((-F.col("votes")).alias("v"), "party")).alias("p"))
    order = F.row_number().over(seat.orderBy(F.desc("votes"), "candidate"))
    ranked = one.withColumn("_r", order)
    first, second = F.col("_r") == 1, F.col("_r") == 2
    out = ranked.groupBy(*SEAT).agg(
        F.max(F.when(first, F.col("candidate"))).alias("winner"),
        F.max(F.when(first, F.col("p.party"))).alias("party"),
        F.max(F.when(first, F.col("votes"))).alias("winner_votes"),
        F.coalesce(F.max(F.when(second, F.col("votes"))), F.lit(0)).alias("runnerup_votes"),
        F.sum("votes").alias("total_votes"),
    )
    return out.where("total_votes > 0").withColumn("mov", F.round((F.col("winner_votes") - F.col("runnerup_votes")) / F.col("total_votes"), 6))


def days_from_seating(start: Column, cycle: Column) -> Column:
    """Days between a term's start and January 3 after the contest; very many where there is no start."""
    return F.coalesce(F.abs(F.datediff(start, F.make_date(cycle + 1, F.lit(1), F.lit(3)))), F.lit(10**6))


def last_name(name: Column) -> Column:
    return F.coalesce(F.try_element_at(F.filter(F.split(F.upper(name), r"[^\p{L}'-]+"), lambda w: (F.length(w) > 1) & ~w.isin("JR", "SR", "II", "III", "IV")), F.lit(-1)), F.lit(""))


def link(contests: DataFrame, terms: DataFrame) -> DataFrame:
    """Every contest with the office it seats (bioguide, matched_via), or why there is none (reason: no_term, ambiguous).

    `terms` has bioguide, state, district, party, start, names (upper-case words). A contest of a year seats a term that starts in the next,
    a special one in the same year as well. Tiers: the only term; the only one of the winner's name; then, among those of the name or
    else all, those of the party or else all: the only one, or the one that starts nearest the seating date if no other office
    ties. The terms of a seat are few, so each contest is decided in its own window.
    """
    years = F.when(F.col("special"), F.array("cycle", F.col("cycle") + 1)).otherwise(F.array(F.col("cycle") + 1))
    asked = contests.withColumn("start_year", F.explode(years))
    t = terms.select("bioguide", "state", "district", F.col("party").alias("_party"), "start", "names", F.year("start").alias("start_year"))
    pool = asked.join(t, ["state", "district", "start_year"])
    named = (last_name(F.col("winner")) != "") & F.array_contains("names", last_name(F.col("winner")))
    w = Window.partitionBy(*SEAT)
    count = lambda c: F.sum(c.cast("int")).over(w)
    rows = pool.withColumn("named", named).withColumn("pool", F.count("*").over(w)).withColumn("n_named", count(F.col("named")))
    rows = rows.withColumn("base", (F.col("n_named") == 0) | F.col("named"))
    rows = rows.withColumn("same", F.col("base") & F.coalesce(F.col("_party") == F.col("party"), F.lit(False))).withColumn("n_same", count(F.col("same")))
    rows = rows.withColumn("narrow", F.col("base") & ((F.col("n_same") == 0) | F.col("same"))).withColumn("n_narrow", count(F.col("narrow")))
    rows = rows.withColumn("days", days_from_seating(F.col("start"), F.col("cycle"))).withColumn("best", F.min(F.when(F.col("narrow"), F.col("days"))).over(w))
    rows = rows.withColumn("tied", F.col("narrow") & (F.col("days") == F.col("best")))
    rows = rows.withColumn("offices", F.size(F.collect_set(F.when(F.col("tied"), F.col("bioguide"))).over(w)))
    tier = F.when(F.col("pool") == 1, 1).when(F.col("n_named") == 1, 2).when(F.col("n_narrow") == 1, 3).when(F.col("offices") == 1, 4)
    pick = F.when(tier == 1, F.lit(True)).when(tier == 2, F.col("named")).when(tier == 3, F.col("narrow")).when(tier == 4, F.col("tied"))
    how = (
        F.when(tier == 1, "exact").when(tier == 2, "name")
        .when(tier == 3, F.when(F.col("n_named") > 0, "name+party").when(F.col("n_same") > 0, "exact").otherwise("relaxed"))
        .when(tier == 4, F.when(F.col("n_named") > 0, "name+date").when(F.col("n_same") > 0, "date").otherwise("relaxed+date"))
    )
    judged = rows.groupBy(*SEAT).agg(F.min(F.when(pick, F.struct("start", "bioguide", how.alias("via")))).alias("p"), F.count("*").alias("candidates"))
    same = reduce(lambda a, b: a & b, (F.col(f"c.{k}").eqNullSafe(F.col(f"j.{k}")) for k in SEAT))
    out = contests.alias("c").join(judged.alias("j"), same, "left")
    reason = F.when(F.col("j.candidates").isNull(), "no_term").when(F.col("j.p").isNull(), "ambiguous")
    return out.select("c.*", F.col("j.p.bioguide").alias("bioguide"), F.col("j.p.via").alias("matched_via"), reason.alias("reason"))


def coverage(linked: DataFrame, *by: str) -> DataFrame:
    """Contests matched, unmatched and matched without the party, by group, and the matched per cent."""
    return linked.groupBy(*by).agg(
        F.count("bioguide").alias("matched"),
        F.count_if(F.col("bioguide").isNull()).alias("unmatched"),
        F.count_if(F.col("matched_via").isin(*RELAXED)).alias("relaxed"),
        F.round(100 * F.count("bioguide") / F.count("*"), 1).alias("match_pct"),
    )


def nested(phrases: DataFrame, by: list[str], most: int) -> DataFrame:
    """The `most` best phrases (by, ngram, peak, members) of each group that are no part of a longer one which all their members share.

    Longer phrases stand before shorter ones, so being a part of any phrase that contains it with all its members decides: such a phrase is
    kept itself or is a part of one that is kept, whose members are more still. Parts of a phrase are listed (a phrase has few words) and
    meet shorter phrases by equality; sets of members are compared only then. A phrase without members is never a part.
    """
    words = F.split("ngram", " ")
    parts = F.flatten(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - 1)), lambda n: F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))))
    longer = phrases.where(F.size(words) > 1).select(*by, F.col("members").alias("_more"), F.explode(F.array_distinct(parts)).alias("ngram"))
    inside = longer.join(phrases.select(*by, "ngram", "members"), [*by, "ngram"]).where((F.size("members") > 0) & (F.size(F.array_except("members", "_more")) == 0)).select(*by, "ngram").distinct()
    left = phrases.join(small(inside, 500_000), [*by, "ngram"], "left_anti")
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("peak"), F.desc("ngram")))
    return left.withColumn("rank", rank).where(F.col("rank") <= most)


def era_peaks(occ: DataFrame, era: Column, quorum: int) -> DataFrame:
    """(era, party, ngram, peak, peak_day, members): the day of an era on which most units of a party publish a phrase (the first of several),
    and which; phrases of `quorum` units at least. Members are those of one party on one day."""
    cells = occ.select(era.alias("era"), "party", "ngram", "day", "unit").distinct().groupBy("era", "party", "ngram", "day").agg(F.count("*").alias("peak")).where(F.col("peak") >= quorum)
    best = cells.groupBy("era", "party", "ngram").agg(F.max(F.struct("peak", (-F.unix_date("day")).alias("d"))).alias("b")).select("era", "party", "ngram", F.col("b.peak").alias("peak"), F.date_from_unix_date((-F.col("b.d")).cast("int")).alias("peak_day"))
    who = occ.select("party", "ngram", F.col("day").alias("peak_day"), "unit").join(best, ["party", "ngram", "peak_day"])
    return who.groupBy("era", "party", "ngram", "peak", "peak_day").agg(F.array_sort(F.collect_set("unit")).alias("members"))


def member_index(occ: DataFrame) -> DataFrame:
    """Per office: its phrases, its days, the first and the last."""
    return occ.where("bioguide is not null").groupBy("bioguide").agg(F.count_distinct("ngram").alias("phrases"), F.count_distinct("day").alias("days"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))
