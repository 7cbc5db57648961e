"""Research metrics: ranks, trends, bursts, events, concentration, resampling and gates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from unisono.functions.stats import direction, normal_tail
from unisono.operators.ranks import row_numbers, value_ranks
from unisono.sources.shared import cut


def spearman(rows: DataFrame, x: str, y: str, *by: str) -> DataFrame:
    """rho by group: null under three pairs or for a constant. Ties have their mean rank. Equal pairs are counted before ranks are joined
    to them, and ranks are made by ranges of values, so no group's rows are in one task."""
    rows = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    pairs = rows.groupBy(*by, x, y).agg(F.count("*").alias("_n"))
    mean = (F.col("before") + (F.col("n") + 1) / 2).cast("double")
    r = pairs.join(value_ranks(rows, x, by).select(*by, x, mean.alias("_x")), [*by, x]).join(value_ranks(rows, y, by).select(*by, y, mean.alias("_y")), [*by, y])
    w = F.col("_n")
    n = F.sum("_n")
    avg = lambda c: F.sum(w * c) / n
    mx, my = avg(F.col("_x")), avg(F.col("_y"))
    cov, vx, vy = avg(F.col("_x") * F.col("_y")) - mx * my, avg(F.col("_x") ** 2) - mx**2, avg(F.col("_y") ** 2) - my**2
    return r.groupBy(*by).agg(n.alias("n"), F.when((n >= 3) & (vx > 1e-12) & (vy > 1e-12), cov / F.sqrt(F.nullif(vx, F.lit(0.0))) / F.sqrt(F.nullif(vy, F.lit(0.0)))).alias("rho"))


def split_half(series: DataFrame, expected: int) -> DataFrame:
    """Direction of (x, value) in halves A and B of one lane, and whether both agree with what is expected. Halves of two lanes are an error."""
    lanes = series.agg(F.when(F.count_distinct("lane") > 1, F.raise_error(F.lit("halves of different lanes"))).otherwise(F.count_distinct("lane")).alias("lanes"))
    rho = spearman(series, "x", "value", "half").withColumn("direction", direction(F.col("rho"), F.col("n")))
    wide = rho.groupBy().pivot("half", ["A", "B"]).agg(F.first("direction"))
    return wide.join(lanes).select(F.col("A").alias("a"), F.col("B").alias("b"), (F.coalesce(F.col("A"), F.lit(9)) == expected).__and__(F.coalesce(F.col("B"), F.lit(9)) == expected).alias("confirmed"))


def bursts(series: DataFrame, key: str, gap: int = 14) -> DataFrame:
    """Islands of active days at most `gap` days apart: first and peak day, width from start to peak, and size."""
    w = Window.partitionBy(key).orderBy("day")
    new = (F.coalesce(F.datediff("day", F.lag("day").over(w)), F.lit(10**6)) > gap).cast("int")
    rows = series.withColumn("_new", new).withColumn("burst", F.sum("_new").over(w))
    out = rows.groupBy(key, "burst").agg(F.min("day").alias("start"), F.max("day").alias("stop"), F.sum("count").alias("total"), F.max(F.struct("count", (-F.unix_date("day")).alias("d"))).alias("p"))
    peak = F.date_from_unix_date((-F.col("p.d")).cast("int"))
    return out.select(key, F.col("burst").cast("int").alias("burst"), "start", "stop", "total", peak.alias("peak_day"), F.datediff(peak, "start").alias("width"))


def weekday_excess(observed: DataFrame, baseline: DataFrame) -> DataFrame:
    """Share of each weekday among observed days over its share in the baseline."""
    share = lambda df, n: df.groupBy(F.weekday("day").alias("wd")).agg(F.sum("n").alias(n)).withColumn(n, F.col(n) / F.sum(n).over(Window.partitionBy()))
    return share(observed, "o").join(share(baseline, "b"), "wd", "full").select("wd", F.round(F.try_divide(F.coalesce("o", F.lit(0.0)), "b"), 6).alias("excess"))


def event_rates(rows: DataFrame, anchors: DataFrame, window: int) -> DataFrame:
    """Sums in (0, window] days after and [-window, 0) days before each anchor, a range join against a short list."""
    hit = rows.join(F.broadcast(anchors), (F.datediff("day", "anchor") != 0) & (F.abs(F.datediff("day", "anchor")) <= window))
    after = F.datediff("day", "anchor") > 0
    return hit.groupBy("anchor").agg(F.coalesce(F.sum(F.when(~after, F.col("n"))), F.lit(0)).alias("before"), F.coalesce(F.sum(F.when(after, F.col("n"))), F.lit(0)).alias("after"))


def did(rows: DataFrame) -> DataFrame:
    """Difference in differences of the mean of `value` over `treated` and `post`."""
    m = lambda t, p: F.avg(F.when((F.col("treated") == t) & (F.col("post") == p), F.col("value")))
    return rows.agg(F.round((m(True, True) - m(True, False)) - (m(False, True) - m(False, False)), 6).alias("did"))


def mann_whitney(rows: DataFrame, group: str, value: str) -> DataFrame:
    """U of group true against false, rank-biserial r, tie-corrected z and two-sided p."""
    v = value_ranks(rows, value, n_true=F.count_if(F.col(group)), n_false=F.count_if(~F.col(group)))
    rank = F.col("before") + (F.col("n") + 1) / 2
    a = v.agg(F.sum("n_true").cast("double").alias("n1"), F.sum("n_false").cast("double").alias("n2"), F.sum(F.col("n_true") * rank).alias("r1"), F.sum(F.pow(F.col("n"), 3) - F.col("n")).alias("ties"))
    u = F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2
    n = F.col("n1") + F.col("n2")
    sd = F.sqrt(F.col("n1") * F.col("n2") / 12 * (n + 1 - F.col("ties") / (n * (n - 1))))
    out = a.select("n1", "n2", u.alias("u"), (2 * u / (F.col("n1") * F.col("n2")) - 1).alias("r"), ((u - F.col("n1") * F.col("n2") / 2) / sd).alias("z"))
    return out.withColumn("p", F.least(F.lit(1.0), 2 * normal_tail(F.abs("z"))))


def concentration(rows: DataFrame, value: str) -> DataFrame:
    """Gini coefficient and the share of the top tenth, from distinct values with their numbers."""
    v = cut(value_ranks(rows, value))
    n, total = v.agg(F.sum("n"), F.sum(F.col("n") * F.col(value))).first()
    c, b, x = F.col("n"), F.col("before"), F.col(value)
    if not n:
        return v.select(F.lit(None).cast("double").alias("gini"), F.lit(None).cast("double").alias("top_decile")).limit(0).groupBy().agg(F.max("gini").alias("gini"), F.max("top_decile").alias("top_decile"))
    gini = 2 * F.sum(x * (c * b + c * (c + 1) / 2)) / (n * total) - (n + 1) / n
    in_top = F.greatest(F.lit(0), F.least(c, b + c - (n - -(-n // 10))))
    return v.agg(F.round(gini, 6).alias("gini"), F.round(F.sum(x * in_top) / total, 6).alias("top_decile"))


def slices(rows: DataFrame, order: list, k: int = 5) -> DataFrame:
    """Slice 0..k-1 with edges q * n div k, which is not what ntile cuts."""
    n = rows.count()
    return row_numbers(rows, order, "_i").withColumn("slice", F.floor((k * F.col("_i") - 1) / max(1, n)).cast("int")).drop("_i")


def same_state_pairs(rows: DataFrame, group: str, state: str) -> DataFrame:
    return rows.groupBy(group, state).agg(F.count("*").alias("n")).groupBy(group).agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).cast("long").alias("pairs"))


def permuted_pairs(rows: DataFrame, group: str, state: str, key: str, runs: int = 50, seed: str = "s") -> DataFrame:
    """Mean of same-state pairs when states are dealt anew; permutations come from hash ranks, each its own partition."""
    many = rows.select(group, state, key).crossJoin(F.broadcast(rows.sparkSession.range(runs).withColumnRenamed("id", "run")))
    a = many.withColumn("_r", F.row_number().over(Window.partitionBy("run").orderBy(F.xxhash64(F.lit(seed), "run", key), key)))
    b = a.select("run", F.row_number().over(Window.partitionBy("run").orderBy(key)).alias("_r"), F.col(group).alias("_g"))
    dealt = a.select("run", "_r", state).join(b, ["run", "_r"])
    return dealt.groupBy("run", "_g", state).agg(F.count("*").alias("n")).groupBy("run").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs")).agg(F.avg("pairs").alias("mean_pairs"))


def density_matched(rows: DataFrame, cell: str, key: str, seed: str) -> DataFrame:
    """As many rows of each cell as the smallest has, the first by a hash."""
    size = rows.groupBy(cell).agg(F.count("*").alias("n")).agg(F.min("n").alias("_least"))
    w = Window.partitionBy(cell).orderBy(F.sha2(F.concat_ws("|", F.lit(seed), F.col(key).cast("string")), 256))
    return rows.withColumn("_r", F.row_number().over(w)).join(F.broadcast(size)).where("_r <= _least").drop("_r", "_least")


PRIME = 2147483647
POISSON = (0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582)  # chances of at most 0, 1, 2, ... at a mean of one


def _resampled(draws: int):
    """Weighted sums of both cells for every draw, over the rows of a task."""

    def run(batches):
        total = np.zeros((4, draws))
        d = np.arange(draws, dtype=np.uint64)[None, :]
        p = np.uint64(PRIME)
        for b in batches:
            for at in range(0, b.num_rows, 1024):  # bounds the matrices
                part = b.slice(at, 1024)
                key = (part.column("key").to_numpy(zero_copy_only=False).astype(np.int64) % PRIME).astype(np.uint64)[:, None]
                x = (key * np.uint64(48271) + d * np.uint64(69621) + np.uint64(12345)) % p
                x = (x * x + key) % p
                x = (x * x + d) % p
                weight = sum((x >= np.uint64(int(c * PRIME))).astype(np.float64) for c in POISSON)
                value = part.column("value").to_numpy(zero_copy_only=False).astype(np.float64)
                cell = part.column("cell").to_numpy(zero_copy_only=False).astype(bool)
                for k, mine in ((0, cell), (2, ~cell)):
                    total[k] += value[mine] @ weight[mine]
                    total[k + 1] += weight[mine].sum(axis=0)
        yield pa.RecordBatch.from_pydict({"draw": pa.array(np.arange(draws), pa.int64())} | {n: pa.array(t) for n, t in zip(("sx", "wx", "sy", "wy"), total, strict=True)})

    return run


def bootstrap_gap(rows: DataFrame, cell: str, value: str, key: str, draws: int = 200) -> DataFrame:
    """Percentile interval of the gap of cell means. Resampling weights are Poisson(1), from a hash of key (a whole number) and draw, so that draws
    need no order; all of them are summed in one pass, and a task sends one row for each draw. Rows without cell, value or key are left out."""
    narrow = rows.select(F.col(cell).alias("cell"), F.col(value).cast("double").alias("value"), F.col(key).cast("long").alias("key")).where("cell is not null and value is not null and key is not null")
    sums = narrow.mapInArrow(_resampled(draws), "draw long, sx double, wx double, sy double, wy double").groupBy("draw").agg(*(F.sum(c).alias(c) for c in ("sx", "wx", "sy", "wy")))
    gap = F.try_divide("sx", "wx") - F.try_divide("sy", "wy")
    return sums.agg(F.round(F.percentile(gap, 0.025), 6).alias("low"), F.round(F.percentile(gap, 0.975), 6).alias("high"))


def conversion(concerns: DataFrame, acts: DataFrame, horizon: int = 180, overlap: int = 2) -> DataFrame:
    """Whether an act of the same office within (0, horizon] days shares `overlap` tokens; rows whose horizon runs past the data are censored."""
    last = acts.agg(F.max("day").alias("_last"))
    hit = concerns.join(acts.select("office", F.col("day").alias("act_day"), F.col("tokens").alias("act")), "office", "left")
    ok = (F.datediff("act_day", "day") > 0) & (F.datediff("act_day", "day") <= horizon) & (F.size(F.array_intersect("tokens", "act")) >= overlap)
    out = hit.groupBy("office", "key", "day").agg(F.max(F.coalesce(ok, F.lit(False))).alias("converted"))
    return out.join(F.broadcast(last)).where(F.date_add("day", horizon) <= F.col("_last")).drop("_last")


def pairwise_jaccard(sets: DataFrame, by: list[str], unit: str, item: str) -> DataFrame:
    """Mean Jaccard over the pairs of units of a cell. Units of a cell are offices of a party week; items meet by equality.

    Units with the same items are one set with a count, so that the join grows with the pairs of different sets and not with those of units."""
    rows = sets.select(*by, unit, item).distinct()
    size = rows.groupBy(*by, unit).agg(F.count("*").alias("n"), F.array_sort(F.collect_set(item)).alias("_items"))
    kinds = size.where(F.col(unit).isNotNull()).groupBy(*by, "n", "_items").agg(F.count("*").alias("c"), F.min(unit).alias("_u"))
    same = kinds.select(*by, F.size("_items").cast("long").alias("both"), F.col("n").alias("m"), "n", (F.col("c") * (F.col("c") - 1) / 2).cast("long").alias("w"))
    l = kinds.select(*by, "_u", "n", "c", F.explode("_items").alias("_item"))
    r = l.select(*by, F.col("_u").alias("_v"), F.col("n").alias("m"), F.col("c").alias("d"), "_item")
    both = l.join(r, [*by, "_item"]).where(F.col("_u") < F.col("_v")).groupBy(*by, "_u", "_v", "n", "m", "c", "d").agg(F.count("*").alias("both"))
    met = both.select(*by, "both", "m", "n", (F.col("c") * F.col("d")).alias("w")).unionByName(same)
    scored = met.groupBy(*by, "both", (F.col("n") + F.col("m") - F.col("both")).alias("either")).agg(F.sum("w").alias("w")).withColumn("j", F.col("w") * F.col("both") / F.col("either"))
    pairs = size.groupBy(*by).agg((F.count("*") * (F.count("*") - 1) / 2).alias("pairs"))
    return pairs.where("pairs > 0").join(scored.groupBy(*by).agg(F.sum("j").alias("s")), by, "left").select(*by, F.col("pairs").cast("long").alias("pairs"), F.round(F.coalesce("s", F.lit(0.0)) / F.col("pairs"), 6).alias("mean_jaccard"))
