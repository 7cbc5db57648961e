"""Identity and duplicates: ids, first-wins dedupe, joint groups, shingles, minhash, families, components."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unisono.functions.text import TOKEN, statement_id
from unisono.operators.grams import SLICE, slices
from unisono.params import P
from unisono.sources.shared import cut, drop, small
from unisono.sources.tables import joint_key

PRIME = 4294967311
SKETCH = 1024  # bits of a set's sketch
BROADCAST_IDS = 500_000


def normalize(raw: DataFrame, order: str) -> DataFrame:
    """Drop records without url, text or a whole day, and all but the first of each id (in the order of `order`)."""
    ok = (F.coalesce("url", F.lit("")) != "") & (F.trim(F.coalesce("text", F.lit(""))) != "") & (F.length(F.substring(F.col("date"), 1, 10)) == 10)
    rows = raw.where(ok).withColumn("id", statement_id(F.col("url"), F.col("text")))
    first = Window.partitionBy("id").orderBy(order)
    return rows.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def rejects(raw: DataFrame) -> DataFrame:
    bad = (F.coalesce("url", F.lit("")) == "") | (F.trim(F.coalesce("text", F.lit(""))) == "") | (F.length(F.substring(F.coalesce("date", F.lit("")), 1, 10)) != 10)
    return raw.agg(F.count("*").alias("seen"), F.count_if(bad).alias("rejects"))


def with_joint_groups(stm: DataFrame) -> DataFrame:
    """joint_group on rows whose day and text several offices share, and unit: the thing that a count counts.

    Group sizes are aggregated before the join, so a text that very many rows share is no hot window.
    """
    keyed = stm.withColumn("_sig", joint_key(F.col("day"), F.col("text")))
    many = keyed.where("bioguide is not null").groupBy("_sig").agg(F.count_distinct("bioguide").alias("_n")).where("_n > 1").select("_sig", F.lit(True).alias("_many"))
    out = keyed.join(many, "_sig", "left")
    group = F.when(F.col("_many") & F.col("bioguide").isNotNull(), F.concat(F.lit("joint:"), F.substring("_sig", 1, 24)))
    return out.withColumn("joint_group", group).withColumn("unit", F.coalesce("joint_group", "bioguide", "id")).drop("_sig", "_many")


def fill_from_roster(stm: DataFrame, columns: tuple[str, ...] = ("party", "state", "chamber")) -> DataFrame:
    """Missing values of an office are filled with its most frequent one."""
    modes = stm.groupBy("bioguide").agg(*(F.mode(c, True).alias(f"_{c}") for c in columns))
    return stm.join(F.broadcast(modes) if modes.limit(100_001).count() <= 100_000 else modes, "bioguide", "left").select(
        *(F.coalesce(c, f"_{c}").alias(c) if c in columns else c for c in stm.columns)
    )


def word_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def shingles(text: Column, size: int = P.family_shingle) -> Column:
    """Distinct crc32 of the runs of `size` tokens."""

    def of(toks: Column) -> Column:  # bound once, so that the text isn't split again for every run
        runs = F.transform(F.sequence(F.lit(0), F.size(toks) - size), lambda i: F.crc32(F.array_join(F.slice(toks, i + 1, size), " ").cast("binary")))
        return F.when(F.size(toks) >= size, F.array_distinct(runs)).otherwise(F.array().cast("array<bigint>"))

    return F.element_at(F.transform(F.array(word_tokens(text)), of), 1)


def minhash(values: Column, hashes: int = P.family_hashes) -> Column:
    """Minima of affine hashes of the values; coefficients are odd numbers and checksums."""

    def least(i: int) -> Column:
        a, b = 2 * i + 1, zlib.crc32(f"document-family-{i}".encode())
        return F.array_min(F.transform(values, lambda v: (v * a + b) % PRIME))

    return F.array(*map(least, range(hashes)))


def _coefficients(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    return np.array([2 * i + 1 for i in range(hashes)], np.uint64)[:, None], np.array([zlib.crc32(f"document-family-{i}".encode()) for i in range(hashes)], np.uint64)[:, None]


def _sets(keys: list[str], least: int, size: int, hashes: int):
    a, b = _coefficients(hashes)

    def run(batches):
        for whole in batches:
            for batch in slices(whole, pc.list_value_length(whole.column("_t")).fill_null(0).to_numpy(zero_copy_only=False), SLICE):
                rows, sh, mh, bits = [], [], [], []
                for i, words in enumerate(batch.column("_t").to_pylist()):
                    if words is None or len(words) < max(least, size):
                        continue
                    words = [w.encode() for w in words]
                    values = np.unique(np.array([zlib.crc32(b" ".join(words[k : k + size])) for k in range(len(words) - size + 1)], np.uint64))
                    odd = np.bincount((values % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
                    rows.append(i)
                    sh.append(values.view(np.int64))
                    mh.append(((values * a + b) % np.uint64(PRIME)).min(axis=1).view(np.int64))
                    bits.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
                if rows:
                    longs = pa.list_(pa.int64())
                    cols = [batch.column(k).take(pa.array(rows)) for k in keys]
                    yield pa.RecordBatch.from_arrays([*cols, pa.array([len(v) for v in sh], pa.int32()), *(pa.array(x, longs) for x in (sh, mh, bits))], [*keys, "n", "sh", "mh", "bits"])

    return run


def shingle_sets(df: DataFrame, keys: list[str], least: int = P.family_min_tokens, size: int = P.family_shingle, hashes: int = P.family_hashes) -> DataFrame:
    """keys, n, sh (sorted `shingles`), mh (their `minhash`) and bits of the rows whose text has `least` tokens: bit i says whether an odd
    number of shingles is i modulo SKETCH, so two sets differ in at least as many shingles as their sketches in bits."""
    narrow = df.select(*keys, word_tokens(F.col("text")).alias("_t"))
    schema = T.StructType([narrow.schema[k] for k in keys]).add("n", T.IntegerType())
    for c in ("sh", "mh", "bits"):
        schema = schema.add(c, T.ArrayType(T.LongType()))
    return narrow.mapInArrow(_sets(keys, least, size, hashes), schema)


def scored_pairs(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity) of the `pairs` (a, b) that reach the threshold; `sets` has id, n, sh, bits.

    Sizes and sketches go to the pairs first: they tell most pairs that can't reach it. Sets go to the others alone."""
    x, y = (sets.select(F.col("id").alias(k), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"bits{k}")) for k in "ab")
    apart = sum((F.bit_count(F.get("bitsa", F.lit(i)).bitwiseXOR(F.get("bitsb", F.lit(i)))) for i in range(SKETCH // 64)), F.lit(0))
    slack = 1e-6  # of rounding; a pair let through is decided on its sets
    sized = F.least("na", "nb") >= threshold * F.greatest("na", "nb") - slack
    near = apart <= (F.col("na") + F.col("nb")) * ((1 - threshold) / (1 + threshold)) + slack
    left = cut(pairs.join(x, "a").join(y, "b").where(sized & near).select("a", "b"))
    ids = small(cut(left.select(F.col("a").alias("id")).unionByName(left.select(F.col("b").alias("id"))).distinct()), BROADCAST_IDS)
    used = sets.join(ids, "id", "left_semi")
    a, b = (used.select(F.col("id").alias(k), F.col("sh").alias(f"s{k}")) for k in "ab")
    both = F.size(F.array_intersect("sa", "sb"))
    scored = left.join(a, "a").join(b, "b").withColumn("similarity", both / (F.size("sa") + F.size("sb") - both))
    return scored.where(F.col("similarity") >= threshold).select("a", "b", "similarity")


def band_hashes(bands: int) -> Column:
    """The hash of each band of the minhashes `mh`."""
    rows = P.family_hashes // bands
    return F.array(*(F.xxhash64(F.lit(b), *(F.get("mh", F.lit(b * rows + r)) for r in range(rows))) for b in range(bands)))


def similar_pairs(docs: DataFrame, threshold: float = P.family_jaccard, bands: int = P.family_bands, hours: int = P.family_hours, sets: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b, jaccard) of documents of at most `hours` apart that share a band and reach the threshold.

    `docs` has key, day, text; `sets`, where they are at hand, their `shingle_sets` (by key, day). Equal shingle sets meet through one
    representative a day, so a group of copies costs no pairs; the copies themselves are paired with their representative.
    """
    usable = (cut(shingle_sets(docs, ["key", "day"])) if sets is None else sets).withColumn("set", F.xxhash64("sh"))
    same = cut(usable.select("set", "day", "key"))
    of = cut(same.join(same.groupBy("set", "day").agg(F.min("key").alias("rep")), ["set", "day"]).where("key <> rep").select("key", "rep"))
    copies = of.select(F.least("key", "rep").alias("a"), F.greatest("key", "rep").alias("b"), F.lit(1.0).alias("jaccard"))
    reps = usable.join(small(of.select("key"), BROADCAST_IDS), "key", "left_anti")
    banded = reps.select("key", "day", F.posexplode(band_hashes(bands)).alias("band", "h"))
    near = (F.abs(F.datediff("l.day", "r.day")) * 24) <= hours
    pairs = banded.alias("l").join(banded.alias("r"), (F.col("l.h") == F.col("r.h")) & (F.col("l.key") < F.col("r.key")) & near).select(F.col("l.key").alias("a"), F.col("r.key").alias("b")).distinct()
    scored = scored_pairs(pairs, reps.withColumnRenamed("key", "id"), threshold)
    return scored.select("a", "b", F.col("similarity").alias("jaccard")).unionByName(copies)


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over `edges` (a, b), by minimum labels with pointer jumping, until nothing changes.

    Each round is written to the shared folder, so that neither the plan nor lost executors grow the work.
    """
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = cut(both.groupBy("a").agg(F.least("a", F.min("b")).alias("c")))
    while True:
        seen = both.join(label.select(F.col("a").alias("b"), "c"), "b").groupBy("a").agg(F.min("c").alias("m"))
        step = label.join(seen, "a").select("a", F.least("c", "m").alias("c"))
        jump = cut(step.join(step.select(F.col("a").alias("c"), F.col("c").alias("cc")), "c", "left").select("a", F.least("c", F.coalesce("cc", "c")).alias("c")))
        same = not jump.join(label.withColumnRenamed("c", "old"), "a").where("c <> old").take(1)
        drop(label)
        label = jump
        if same:
            break
    drop(both)
    return label.select(F.col("a").alias("id"), F.col("c").alias("component"))


def interval_asof(facts: DataFrame, intervals: DataFrame, key: str, day: str) -> DataFrame:
    """Facts with the interval [start, end_exclusive) that holds on their day; of several the one that starts last."""
    hit = facts.join(intervals, key).where((F.col(day) >= F.col("start")) & (F.col(day) < F.col("end_exclusive")))
    rest = [c for c in intervals.columns if c not in (key, "start")]
    return hit.groupBy(*facts.columns).agg(F.max_by(F.struct("start", *rest), "start").alias("_i")).select(*facts.columns, "_i.*")


def contains_citations(targets: DataFrame, docs: DataFrame, most: int = 6) -> DataFrame:
    """The first `most` documents that contain each target phrase; targets are a short list and are broadcast under a check."""
    short = F.broadcast(targets) if targets.limit(10_001).count() <= 10_000 else targets
    hit = docs.join(short, F.contains(docs["text"], targets["phrase"]))
    return hit.withColumn("rank", F.row_number().over(Window.partitionBy("phrase").orderBy("day", "doc_id"))).where(F.col("rank") <= most).select("phrase", "doc_id", "day", "rank")
