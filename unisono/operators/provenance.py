"""Which instrument collected what: comparisons stay within one lane, windows off the seam, and few rows are no finding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHOWN = 20  # rows that an error names


class LaneError(RuntimeError):
    """A comparison that mixes instruments, or a window over the seam between them."""


def instrument(source: Column, instruments: dict[str, str]) -> Column:
    """The instrument behind a date source; null where the source is null or not listed: there is no default lane."""
    known = F.create_map(*(F.lit(x) for pair in instruments.items() for x in pair)) if instruments else F.lit(None).cast("map<string,string>")
    return F.when(source.isNotNull(), F.try_element_at(known, source))


def lanes(rows: DataFrame, by: list[str], lane: str = "lane") -> DataFrame:
    """Per group n, untagged rows, the number of lanes, and the lane if there is one alone and no untagged row."""
    a, b = F.min(lane), F.max(lane)
    g = rows.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(F.col(lane).isNull()).alias("untagged"), F.count_distinct(lane).alias("lanes"), F.when(a == b, a).alias("_one"))
    return g.withColumn("lane", F.when(F.col("untagged") == 0, F.col("_one"))).drop("_one")


def seam_spans(rows: DataFrame, by: list[str], seam: str, day: str = "day") -> DataFrame:
    """Per group first and last day, and whether the seam, itself the last day of what ends there, lies between. No day: no span."""
    s = F.lit(seam).cast("date")
    g = rows.groupBy(*by).agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return g.withColumn("spans", F.coalesce((F.col("first") <= s) & (F.col("last") > s), F.lit(False)))


def comparisons(rows: DataFrame, by: list[str], half: Column, seam: str, floor: int) -> DataFrame:
    """Per comparison its verdict. `rows`: the columns of `by`, lane, day; `half` says true or false of each row, null leaves it out.

    empty: a side has no row. untagged: a row without lane. mixed: a side has several. two_instruments: the sides' lanes differ.
    underpowered: a side has fewer rows than `floor`, which refutes nothing. Otherwise ok. The first that holds counts. One aggregation.
    """
    h, c = F.col("_half"), F.col
    sides = []
    for name, on in (("a", h), ("b", ~h)):
        sides += [F.count_if(on).alias(f"{name}_n"), F.min(F.when(on, c("lane"))).alias(f"{name}_low"), F.max(F.when(on, c("lane"))).alias(f"{name}_high")]
    s = F.lit(seam).cast("date")
    g = rows.withColumn("_half", half).where("_half is not null").groupBy(*by).agg(*sides, F.count_if(c("lane").isNull()).alias("untagged"), F.min("day").alias("_f"), F.max("day").alias("_l"))
    verdict = (
        F.when(F.least("a_n", "b_n") == 0, "empty")
        .when(c("untagged") > 0, "untagged")
        .when((c("a_low") != c("a_high")) | (c("b_low") != c("b_high")), "mixed")
        .when(c("a_low") != c("b_low"), "two_instruments")
        .when(F.least("a_n", "b_n") < floor, "underpowered")
        .otherwise("ok")
    )
    return g.select(*by, "a_n", "b_n", "untagged", F.coalesce((c("_f") <= s) & (c("_l") > s), F.lit(False)).alias("spans_seam"), verdict.alias("verdict"))


def require(report: DataFrame, fine: Column, what: str) -> DataFrame:
    """`report`, if `fine` holds for each row; otherwise an error that names some of the others. Null is not fine."""
    bad = report.where(~F.coalesce(fine, F.lit(False))).limit(SHOWN).collect()
    if bad:
        raise LaneError(f"{what}: " + "; ".join(str(r.asDict()) for r in bad))
    return report
