"""Gold sets: stratified hash samples, allocation, splits and agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from unisono.functions.stats import wilson


def hash_sample(rows: DataFrame, strata: list[str], key: str, n: int, seed: str) -> DataFrame:
    """The n rows of each stratum with the least sha256(seed newline key)."""
    h = F.sha2(F.concat(F.lit(seed), F.lit("\n"), F.col(key).cast("string")), 256)
    w = Window.partitionBy(*strata).orderBy(h, key)
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def date_split(rows: DataFrame, train_end: str, validation_end: str) -> DataFrame:
    return rows.withColumn("split", F.when(F.col("day") <= F.lit(train_end).cast("date"), "train").when(F.col("day") <= F.lit(validation_end).cast("date"), "validation").otherwise("test"))


def largest_remainder(weights: dict[str, float], total: int, caps: dict[str, int]) -> dict[str, int]:
    """Seats in proportion to weights within caps. In each pass all take the whole part of their quota, and what is left goes one by one to the largest remainders of that pass (ties by name); seats that caps refuse are dealt in a further pass. Strata are few."""
    seats = dict.fromkeys(weights, 0)
    total = min(total, sum(caps.values()))
    while (left := total - sum(seats.values())) > 0:
        room = [k for k, w in weights.items() if w > 0 and seats[k] < caps[k]]
        if not room:
            break
        whole = sum(weights[k] for k in room)
        quota = {k: weights[k] / whole * left for k in room}
        seats |= {k: min(caps[k], seats[k] + int(quota[k])) for k in room}
        after = total - sum(seats.values())
        by_remainder = sorted((k for k in room if seats[k] < caps[k]), key=lambda k: (int(quota[k]) - quota[k], k))
        seats |= {k: seats[k] + 1 for k in by_remainder[:after]}
    return seats


def allocate(universe: DataFrame, strata: list[str], total: int, whole: int = 200, floor: int = 5) -> DataFrame:
    """Seats by stratum: small strata whole, others a floor and their share of the rest. Counts of strata, not rows, reach the driver."""
    sizes = {tuple(r)[:-1]: r["n"] for r in universe.groupBy(*strata).agg(F.count("*").alias("n")).collect()}
    base = {k: n if n <= whole else min(floor, n) for k, n in sizes.items()}
    rest = largest_remainder({str(k): n for k, n in sizes.items()}, max(0, total - sum(base.values())), {str(k): sizes[k] - base[k] for k in sizes})
    rows = [(*k, base[k] + rest[str(k)]) for k in sorted(sizes, key=str)]
    kinds = dict(universe.dtypes)
    return universe.sparkSession.createDataFrame(rows, ", ".join(f"{s} {kinds[s]}" for s in strata) + ", seats int")


def agreement(pairs: DataFrame) -> DataFrame:
    """n, observed agreement, Cohen's kappa and Krippendorff's nominal alpha of label pairs (a, b)."""
    n = pairs.agg(F.count("*").alias("n"), F.count_if(F.col("a") == F.col("b")).alias("same"))
    ca = pairs.groupBy(F.col("a").alias("label")).agg(F.count("*").alias("ca"))
    cb = pairs.groupBy(F.col("b").alias("label")).agg(F.count("*").alias("cb"))
    both = ca.join(cb, "label", "full").agg(F.sum(F.coalesce("ca", F.lit(0)) * F.coalesce("cb", F.lit(0))).alias("prod"), F.sum(F.pow(F.coalesce("ca", F.lit(0)) + F.coalesce("cb", F.lit(0)), 2)).alias("sq"))
    po, pe = F.col("same") / F.col("n"), F.col("prod") / (F.col("n") * F.col("n"))
    m = 2 * F.col("n")
    ea = (m * m - F.col("sq")) / (m * (m - 1))
    return n.join(both).where("n > 0").select(
        "n", F.round(po, 6).alias("observed"), F.round(F.when(pe >= 1, 1.0).otherwise(F.try_divide(po - pe, 1 - pe)), 6).alias("kappa"), F.round(F.when(ea <= 0, 1.0).otherwise(1 - F.try_divide(1 - po, ea)), 6).alias("alpha")
    )


def confusion(pairs: DataFrame) -> DataFrame:
    """Cells of gold against predicted, and the precision of each predicted class with its interval."""
    cells = pairs.groupBy("gold", "predicted").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("predicted"))
    hit = F.sum(F.when(F.col("gold") == F.col("predicted"), F.col("n")).otherwise(0)).over(Window.partitionBy("predicted"))
    lo, hi = wilson(hit, total)
    return cells.select("gold", "predicted", "n", F.round(hit / total, 6).alias("precision"), F.round(lo, 6).alias("low"), F.round(hi, 6).alias("high"))


def family_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of candidates of one day and party that gold and prediction put in one family.

    Counted from the sizes of families, so that no pair is a row.
    """
    two = lambda c: c * (c - 1) / 2
    both = rows.groupBy("day", "party", "gold_family", "predicted_family").agg(F.count("*").alias("n")).agg(F.sum(two(F.col("n"))).alias("both"))
    gold = rows.groupBy("day", "party", "gold_family").agg(F.count("*").alias("n")).agg(F.sum(two(F.col("n"))).alias("gold"))
    pred = rows.groupBy("day", "party", "predicted_family").agg(F.count("*").alias("n")).agg(F.sum(two(F.col("n"))).alias("predicted"))
    return both.join(gold).join(pred).select(*(F.col(c).cast("long").alias(c) for c in ("both", "gold", "predicted")), F.round(F.try_divide("both", "predicted"), 6).alias("precision"), F.round(F.try_divide("both", "gold"), 6).alias("recall"))


def error_gap(rows: DataFrame) -> DataFrame:
    """Error rates of two groups and their gap with Newcombe's interval."""
    from unisono.functions.stats import newcombe

    a = rows.agg(*(f.alias(n) for p in ("D", "R") for n, f in ((f"k{p}", F.count_if((F.col("party") == p) & (F.col("gold") != F.col("predicted")))), (f"n{p}", F.count_if(F.col("party") == p)))))
    lo, hi = newcombe(F.col("kD"), F.col("nD"), F.col("kR"), F.col("nR"))
    return a.where("nD > 0 and nR > 0").select(F.round(F.col("kD") / F.col("nD"), 6).alias("error_d"), F.round(F.col("kR") / F.col("nR"), 6).alias("error_r"), F.round(lo, 6).alias("gap_low"), F.round(hi, 6).alias("gap_high"))


def adjudicate(a: DataFrame, b: DataFrame, decisions: DataFrame) -> DataFrame:
    """Agreed labels, decided ones, and those still open."""
    both = a.select("candidate_id", F.col("label").alias("_a")).join(b.select("candidate_id", F.col("label").alias("_b")), "candidate_id").join(decisions.select("candidate_id", F.col("label").alias("_d")), "candidate_id", "left")
    state = F.when(F.col("_a") == F.col("_b"), "agreed").when(F.col("_d").isNotNull(), "decided").otherwise("open")
    return both.select("candidate_id", state.alias("state"), F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(F.col("_d")).alias("gold"))


def evenly_spaced(rows: DataFrame, strata: list[str], order: list, count: int) -> DataFrame:
    """The rows at places int((i + 0.5) * size / count) of each stratum's order."""
    w = Window.partitionBy(*strata).orderBy(*order)
    n = F.count("*").over(Window.partitionBy(*strata))
    c = F.least(n, F.lit(count))
    place = F.row_number().over(w) - 1
    i = F.floor(place * c / n)
    hit = F.exists(F.array(i - 1, i, i + 1), lambda j: (j >= 0) & (j < c) & (F.floor((j + 0.5) * n / c) == place))
    return rows.withColumn("_hit", hit).where("_hit").drop("_hit")


def seal(universe: DataFrame, columns: list[str], seed: str) -> DataFrame:
    """A fingerprint that doesn't depend on the order of rows and is gathered by aggregation: sums of parts of row hashes, hashed."""
    h = F.sha2(F.concat_ws("\n", F.lit(seed), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)), 256)
    parts = [F.sum(F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)")).alias(f"s{i}") for i in range(8)]
    return universe.agg(F.count("*").alias("rows"), *parts).select("rows", F.sha2(F.concat_ws(":", "rows", *(F.col(f"s{i}").cast("string") for i in range(8))), 256).alias("seal"))


#: What makes a candidate worth a reader's time, and how much.
IMPACT = {"public_surface": 8, "private": 6, "rare_class": 4, "family_collapse": 3, "boundary_quorum": 2}
CLASSES = ("message", "scaffold", "procedural", "biographical", "private", "nomenclature", "unknown")


def universe(daily: DataFrame, offices: DataFrame, predicted: Column, epoch: str, min_units: int = 1) -> DataFrame:
    """A candidate for each phrase and party at the party's peak day from `epoch` on: most units, then the earliest day.

    `daily`: ngram, day, party, units. `offices`: ngram, day, party, headcount; where a cell is missing its units count. `predicted` may
    use ngram and units. Parties other than D and R, and cells without units, give none.
    """
    cells = daily.where(F.col("party").isin("D", "R") & (F.col("units") >= F.greatest(F.lit(min_units), F.lit(1))) & (F.col("day") >= F.lit(epoch).cast("date")))
    peak = cells.groupBy("ngram", "party").agg(F.max(F.struct("units", (-F.unix_date("day")).alias("_d"))).alias("p")).select("ngram", "party", F.date_from_unix_date(-F.col("p._d")).alias("day"), "p.units")
    rows = peak.join(offices, ["ngram", "day", "party"], "left")
    named = F.sha2(F.concat_ws("\n", "ngram", "party", F.date_format("day", "yyyy-MM-dd")), 256)
    return rows.select(F.concat(F.lit("gold:"), F.substring(named, 1, 24)).alias("candidate_id"), "ngram", "party", "day", F.year("day").alias("year"), "units", F.coalesce("headcount", "units").alias("headcount"), predicted.alias("predicted_class"))


def impact(rows: DataFrame, public: DataFrame) -> DataFrame:
    """Candidates with impact tags and the sum of their weights; `public` (ngram): phrases that readers have been shown."""
    shown = rows.join(public.select("ngram", F.lit(True).alias("_shown")).distinct(), "ngram", "left")
    kind = F.col("predicted_class")
    holds = {
        "public_surface": F.col("_shown"),
        "private": kind == "private",
        "rare_class": kind.isin("biographical", "private", "nomenclature"),
        "family_collapse": F.col("headcount") > F.col("units"),
        "boundary_quorum": F.col("units").isin(2, 3),
    }
    tags = F.array_compact(F.array(*(F.when(c, k) for k, c in holds.items())))
    weight = sum((F.when(c, IMPACT[k]).otherwise(0) for k, c in holds.items()), F.lit(0))
    return shown.select(*(F.col(f"`{c}`") for c in rows.columns), tags.alias("impact_tags"), weight.alias("priority"))


def annotation_issues(rows: DataFrame, annotator: str | None = None, classes: tuple[str, ...] = CLASSES) -> DataFrame:
    """(candidate_id, issue): what is wrong with one annotator's batch (candidate_id, annotator_id, gold_class, gold_family_id).

    no_candidate, duplicate (once a candidate), no_annotator, wrong_annotator (where one is expected), class, no_family. Blank counts as
    missing. A batch without issue gives no row, an empty batch none.
    """
    blank = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    tests = [F.when(blank("annotator_id"), "no_annotator"), F.when(~F.coalesce(F.col("gold_class").isin(*classes), F.lit(False)), "class"), F.when(blank("gold_family_id"), "no_family")]
    if annotator is not None:
        tests.append(F.when(~blank("annotator_id") & (F.col("annotator_id") != annotator), "wrong_annotator"))
    issue = F.when(blank("candidate_id"), F.array(F.lit("no_candidate"))).otherwise(F.array_compact(F.array(*tests)))
    each = rows.select("candidate_id", F.explode(issue).alias("issue"))
    twice = rows.where(~blank("candidate_id")).groupBy("candidate_id").agg(F.count("*").alias("n")).where("n > 1").select("candidate_id", F.lit("duplicate").alias("issue"))
    return each.unionByName(twice)
