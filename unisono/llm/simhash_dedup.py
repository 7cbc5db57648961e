"""Near copies by SimHash: all fingerprints within a Hamming distance, found by the general pigeonhole principle.

The 64 bits are grouped into partitions so that correlated bits lie together. Two fingerprints within distance d differ in
partition i by at most t_i for some i, whatever the thresholds t_i >= -1 are, as long as the sum of t_i + 1 is d + 1. So each
fingerprint takes the thresholds that cost it least: a dynamic programme spends the d + 1 units over the partitions, on the number
of values that must be probed and on how many fingerprints are likely to lie there, estimated from counts of half partitions. In a
partition whose value many have it spends nothing. Every fingerprint is indexed by its value in each partition; what is within
t_i of that value is probed, and fingerprints that meet are verified on all bits.

Equal fingerprints are one. Only what decides components is compared: a bucket is searched from one fingerprint to those that
it links with, which then leave; a bucket of more than BLOCK fingerprints is first thinned by a leader, and what is left in
different components meets in blocks. No pair of a group becomes a row.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _LOWER, arrow_map, materialize, read_table, remove
from .jaccard_join import connected_components

SHINGLE = 4
DISTANCE = 4
SEED = 42
BITS = 64
ROW_COST, PAIR_COST = 300.0, 1.0  # of an entry that is exchanged, and of two fingerprints that meet
FEW = 64  # entries of a bucket that are compared pair by pair
BLOCK = 8192  # entries of a bucket that one task searches; beyond, blocks meet
STRIPE = 65_536  # shingles that are counted at a time
INDEXED, PROBED = 1, 2


# ---- fingerprints ----


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64 bits that are set in over half of the hashes of a text's word shingles; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    size = min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    n = len(words) - size + 1
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, STRIPE):
        spans = zip(starts[at : min(n, at + STRIPE)].tolist(), ends[at + size - 1 : min(n, at + STRIPE) + size - 1].tolist(), strict=True)
        h = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * counts > n).tolist())


def _fingerprints(shingle: int):
    def run(batches):
        for b in batches:
            made = np.array([fingerprint(t.as_py(), shingle) for t in b.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(made.view(np.int64))], ["doc_id", "fp"])

    return run


# ---- the plan ----


def count_parts(n: int, distance: int) -> int:
    """The number of partitions that is cheapest for n fingerprints with evenly spread bits: few wide ones ask for many probes,
    many narrow ones let unrelated fingerprints meet."""

    def cost(m: int) -> float:
        w = BITS // m
        units = [(distance + 1) // m + (i < (distance + 1) % m) for i in range(m)]
        probes = sum(sum(comb(w, k) for k in range(u)) for u in units)
        return probes * (ROW_COST + PAIR_COST * n / 2**w)

    return min(range(2, distance + 2), key=cost)


def group_bits(together: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Partitions of near equal width; each grows by the bit that correlates most with the bits it has."""
    p = np.diag(together) / max(1, n)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    r = np.abs((together / max(1, n) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(r, 0)
    left, out = list(range(BITS)), []
    for i in range(parts):
        size = BITS // parts + (i < BITS % parts)
        group = [max(left, key=lambda b: (r[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            group.append(max(left, key=lambda b: (r[b, group].sum(), -b)))
            left.remove(group[-1])
        out.append(sorted(group))
    return out


def values(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    """The values of some bits, side by side."""
    out = np.zeros(len(fp), np.int64)
    for j, b in enumerate(bits):
        out |= (fp >> np.uint64(b) & np.uint64(1)).astype(np.int64) << j
    return out


def halves(bits: list[int]) -> tuple[list[int], list[int]]:
    return bits[: (len(bits) + 1) // 2], bits[(len(bits) + 1) // 2 :]


def near_counts(counts: np.ndarray, distance: int) -> np.ndarray:
    """[value, k]: how many lie at distance k of the value, by one pass over each bit."""
    out = np.zeros((len(counts), distance + 1))
    out[:, 0] = counts
    at = np.arange(len(counts))
    for j in range((len(counts) - 1).bit_length()):
        other = out[at ^ (1 << j)]
        out[:, 1:] = out[:, 1:] + other[:, :-1]
    return out


def allocate(fp: np.ndarray, parts: list[list[int]], near: list[tuple[np.ndarray, np.ndarray]], n: int, distance: int) -> np.ndarray:
    """[fingerprint, partition]: units t_i + 1 of each partition, summing to distance + 1 at least cost."""
    budget = distance + 1
    best = np.full((len(fp), budget + 1), np.inf)
    best[:, 0] = 0
    chosen = []
    for bits, (a, b) in zip(parts, near, strict=True):
        x, y = (t[values(fp, h)] for t, h in zip((a, b), halves(bits), strict=True))
        cost = np.zeros((len(fp), budget + 1))
        likely = np.zeros(len(fp))
        for t in range(distance + 1):  # halves are taken as independent
            likely = likely + sum(x[:, j] * y[:, t - j] for j in range(t + 1)) / max(1, n)
            cost[:, t + 1] = ROW_COST * sum(comb(len(bits), k) for k in range(t + 1)) + PAIR_COST * likely
        now = np.full_like(best, np.inf)
        took = np.zeros(best.shape, np.int64)
        for s in range(budget + 1):
            ways = np.stack([best[:, s - u] + cost[:, u] for u in range(s + 1)], axis=1)
            took[:, s] = ways.argmin(axis=1)
            now[:, s] = ways.min(axis=1)
        best = now
        chosen.append(took)
    units = np.zeros((len(fp), len(parts)), np.int64)
    rest = np.full(len(fp), budget)
    for i in range(len(parts) - 1, -1, -1):
        units[:, i] = chosen[i][np.arange(len(fp)), rest]
        rest = rest - units[:, i]
    return units


def _together(batches):
    """How often two bits are set together: one row of 64 x 64 counts for each task."""
    total = np.zeros((BITS, BITS), np.int64)
    for b in batches:
        fp = b.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
        x = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
        total += (x.T @ x).astype(np.int64)
    yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(BITS * BITS)), "n": pa.array(total.ravel())})


def _histograms(pieces: list[list[int]]):
    def run(batches):
        total = [np.zeros(1 << len(p), np.int64) for p in pieces]
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for t, bits in zip(total, pieces, strict=True):
                t += np.bincount(values(fp, bits), minlength=len(t))
        for i, t in enumerate(total):
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_pydict({"at": pa.array(at + (i << 40)), "n": pa.array(t[at])})

    return run


def _summed(df: DataFrame) -> list:
    """Counts over all tasks. Their number depends on the bits alone: 64 x 64, or the values of half partitions of 16 bits at most."""
    return df.groupBy("at").agg(F.sum("n").alias("n")).collect()


def masks(bits: list[int], most: int) -> np.ndarray:
    """What a value is changed by within distance `most`, by distance."""
    return np.array([sum(1 << j for j in c) for k in range(most + 1) for c in combinations(range(len(bits)), k)], np.int64)


def _entries(parts: list[list[int]], near, n: int, distance: int):
    """(key, fp, side): the value of each partition as indexed, and what is probed around it."""

    def run(batches):
        for b in batches:
            fp = b.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            bits = fp.view(np.uint64)
            units = allocate(bits, parts, near.value, n, distance)
            for i, part in enumerate(parts):
                own = values(bits, part) | i << 40
                side = np.where(units[:, i] > 0, INDEXED | PROBED, INDEXED)
                yield _entry_batch(own, fp, side)
                for u in range(2, distance + 2):
                    who = np.flatnonzero(units[:, i] >= u)
                    if len(who):
                        ring = masks(part, u - 1)[sum(comb(len(part), k) for k in range(u - 1)) :]
                        for at in range(0, len(who), max(1, 100_000 // len(ring))):
                            some = who[at : at + max(1, 100_000 // len(ring))]
                            yield _entry_batch((own[some][:, None] ^ ring[None, :]).ravel(), np.repeat(fp[some], len(ring)), np.full(len(some) * len(ring), PROBED))

    return run


def _entry_batch(key, fp, side):
    return pa.RecordBatch.from_pydict({"key": pa.array(key, pa.int64()), "fp": pa.array(fp, pa.int64()), "side": pa.array(side, pa.int32())})


# ---- buckets ----


def _close(x: np.ndarray, y: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count((x ^ y).view(np.uint64)) <= distance  # of signed numbers it would count the absolute value


def search(fp: np.ndarray, side: np.ndarray, distance: int, step: int = 256) -> list[tuple[int, int]]:
    """Links that connect a bucket as all its links do: from one entry to those not yet reached, and on from these. An
    entry that was only probed here meets those indexed here, and the other way round."""
    left = np.arange(len(fp))
    out = []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            now, front = front[:step], front[step:]
            meets = (side[now][:, None] | side[left][None, :]) == INDEXED | PROBED
            hit = _close(fp[now][:, None], fp[left][None, :], distance) & meets
            found = hit.any(axis=0)
            out += zip(fp[now[hit[:, found].argmax(axis=0)]].tolist(), fp[left[found]].tolist(), strict=True)
            front, left = np.concatenate([front, left[found]]), left[~found]
    return out


def _buckets(distance: int):
    """Rows sorted by key: links of each bucket."""

    def links(key, fp, side):
        bound = np.flatnonzero(np.diff(key)) + 1
        start = np.concatenate([[0], bound])
        size = np.diff(np.concatenate([start, [len(key)]]))
        few = np.repeat(size <= FEW, size)
        at, lag = np.flatnonzero(few), 0
        while len(at):
            lag += 1
            at = at[at + lag < len(key)]
            at = at[key[at + lag] == key[at]]
            hit = at[_close(fp[at], fp[at + lag], distance) & ((side[at] | side[at + lag]) == INDEXED | PROBED)]
            if len(hit):
                yield fp[hit], fp[hit + lag]
        for s, n in zip(start[size > FEW].tolist(), size[size > FEW].tolist(), strict=True):
            made = search(fp[s : s + n], side[s : s + n], distance)
            if made:
                yield np.array([a for a, _ in made]), np.array([b for _, b in made])

    def run(batches):
        held = None
        for b in batches:
            cols = [b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "fp", "side")]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            cut = np.searchsorted(cols[0], cols[0][-1]) if len(cols[0]) else 0  # the last bucket may go on
            for a, c in links(*(x[:cut] for x in cols)) if cut else ():
                yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(c)})
            held = [x[cut:] for x in cols]
        if held is not None and len(held[0]):
            for a, c in links(*held):
                yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(c)})

    return run


_LINKS = "a long, b long"


def _packed(batches):
    """Rows sorted by (key, block), as one row for each block."""
    held: dict | None = None

    def put(h):
        cols = {c: pa.array([v], pa.int64()) for c, v in zip(("key", "block"), h["at"], strict=True)}
        return pa.RecordBatch.from_pydict(cols | {c: pa.array([np.array(h[c], np.int64).tobytes()], pa.binary()) for c in ("fp", "side", "label")})

    for b in batches:
        for r in b.to_pylist():
            at = (r["key"], r["block"])
            if held is not None and held["at"] != at:
                yield put(held)
                held = None
            if held is None:
                held = {"at": at, "fp": [], "side": [], "label": []}
            for c in ("fp", "side", "label"):
                held[c].append(r[c])
    if held is not None:
        yield put(held)


def _meet(distance: int):
    """Pairs of blocks: links between different components."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                x, y = ([np.frombuffer(r[s + c], np.int64) for c in ("fp", "side", "label")] for s in ("x_", "y_"))
                out: dict[tuple[int, int], tuple[int, int]] = {}
                for at in range(0, len(x[0]), 256):
                    fp, side, label = (v[at : at + 256, None] for v in x)
                    hit = _close(fp, y[0][None, :], distance) & ((side | y[1][None, :]) == INDEXED | PROBED) & (label != y[2][None, :])
                    for i, j in zip(*np.nonzero(hit), strict=True):
                        out.setdefault((int(label[i, 0]), int(y[2][j])), (int(fp[i, 0]), int(y[0][j])))
                if out:
                    yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in out.values()], pa.int64()), "b": pa.array([c for _, c in out.values()], pa.int64())})

    return run


def _labels(fps: DataFrame, links: DataFrame) -> DataFrame:
    comp = connected_components(links)
    return materialize(fps.join(comp.withColumnRenamed("id", "fp"), "fp", "left").select("fp", F.coalesce("component", "fp").alias("label")))


def _blocks(hot: DataFrame, label: DataFrame, distance: int) -> DataFrame:
    """Links between the different components of each bucket; blocks of one and the same component don't meet."""
    rows = hot.join(label, "fp")
    mixed = rows.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.ceil(F.count("*") * 2 / BLOCK).alias("pools")).where("lo <> hi").select("key", "pools")
    rows = rows.join(mixed, "key")
    share = rows.groupBy("key", "label").agg(F.ceil(F.count("*") * 2 / BLOCK).alias("cuts"), F.count("*").alias("n"))
    # a large component has blocks of its own, small ones share pools
    own = F.when(F.col("n") * 4 > BLOCK, F.xxhash64("label", F.pmod(F.xxhash64("fp"), F.col("cuts"))))
    dealt = rows.join(share, ["key", "label"]).select("key", F.coalesce(own, F.pmod(F.xxhash64("label"), F.col("pools"))).alias("block"), "fp", "side", "label")
    parts = int(hot.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = "key long, block long, fp binary, side binary, label binary"
    packed = materialize(arrow_map(dealt.repartition(parts, "key", "block").sortWithinPartitions("key", "block"), _packed, kinds))
    single = dealt.groupBy("key", "block").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    y = single.select("key", F.col("block").alias("y"), F.col("lo").alias("y_lo"), F.col("hi").alias("y_hi"))
    pairs = single.withColumnRenamed("block", "x").join(y, "key").where("x <= y and not (lo = hi and y_lo = y_hi and lo = y_lo)").select("key", "x", "y")

    def side(s: str) -> DataFrame:
        return packed.select("key", F.col("block").alias(s), *(F.col(c).alias(f"{s}_{c}") for c in ("fp", "side", "label")))

    met = pairs.join(side("x"), ["key", "x"]).join(side("y"), ["key", "y"]).drop("key", "x", "y")
    spark = hot.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    return materialize(met.repartition(parts).mapInArrow(_meet(distance), _LINKS))


def near_links(fps: DataFrame, n: int, distance: int = DISTANCE, parts: int | None = None) -> DataFrame:
    """Links (a, b) of `fps` (distinct fp, copies), n of them, that connect the fingerprints as all links do."""
    spark = fps.sparkSession
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    _large_batches(spark)
    together = np.zeros(BITS * BITS)
    for r in _summed(fps.select("fp").mapInArrow(_together, "at long, n long")):
        together[r["at"]] = r["n"]
    groups = group_bits(together.reshape(BITS, BITS), n, parts or count_parts(n, distance))
    pieces = [h for g in groups for h in halves(g)]
    counts = [np.zeros(1 << len(p)) for p in pieces]
    for r in _summed(fps.select("fp").mapInArrow(_histograms(pieces), "at long, n long")):
        counts[r["at"] >> 40][r["at"] & (1 << 40) - 1] = r["n"]
    tables = [near_counts(c, distance) for c in counts]
    near = spark.sparkContext.broadcast(list(zip(tables[::2], tables[1::2], strict=True)))  # 5 MB at most: 2^16 values of each half

    entries = materialize(fps.select("fp").mapInArrow(_entries(groups, near, n, distance), "key long, fp long, side int"))
    large = materialize(entries.groupBy("key").agg(F.count("*").alias("n"), F.bit_or("side").alias("sides")).where(f"n > {BLOCK}").select("key"))
    many = large.count()
    few = F.broadcast(large) if many <= 500_000 else large  # a number of eight bytes each
    small = entries.join(few, "key", "left_anti") if many else entries
    _large_batches(spark)
    links = materialize(small.repartition(shuffle, "key").sortWithinPartitions("key").mapInArrow(_buckets(distance), _LINKS).distinct())
    if many:
        hot = materialize(entries.join(few, "key", "left_semi"))
        lead = hot.where(F.col("side").bitwiseAND(INDEXED) > 0).join(fps, "fp").groupBy("key").agg(F.max(F.struct("copies", "fp")).alias("lead")).select("key", F.col("lead.fp").alias("a"))
        led = hot.join(F.broadcast(lead) if many <= 500_000 else lead, "key").where(F.bit_count(F.col("a").bitwiseXOR(F.col("fp"))) <= distance).select("a", F.col("fp").alias("b"))
        links = links.unionByName(materialize(led.where("a <> b").distinct()))
        links = links.unionByName(_blocks(hot, _labels(fps.select("fp"), links), distance))
        remove(hot)
    remove(entries)
    return links


def _large_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50000")


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, parts: int | None = None) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document.

    Words are the runs of bytes other than ASCII white space after A-Z are lower-cased; a text's shingles are its runs of
    words, repeats included, with fewer words the whole sequence. A bit is set if it is set in over half of their XXH64
    (seed 42). Without words or text the fingerprint is zero and links like any other. component_id is the smallest
    doc_id that is reached over fingerprints within `distance`. doc_id is unique; a row repeated in full gives the same result
    again; a null doc_id takes part and is no component's name. An empty table gives an empty result. Other columns aren't read.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    facts = materialize(arrow_map(narrow, _fingerprints(shingle), "doc_id long, fp long"))
    fps = materialize(facts.groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")))
    n, total = fps.agg(F.count("*"), F.coalesce(F.sum("copies"), F.lit(0))).first()
    label = _labels(fps.select("fp"), near_links(fps.select("fp", "copies"), n, distance, parts))
    names = fps.join(label, "fp")
    least = names.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = materialize(names.join(least, "label").select("fp", "component_id", "copies"))
    # at most 1000 fingerprints have more than a thousandth of all documents; they join apart
    common = F.broadcast(named.where(F.col("copies") * 1000 > total).select("fp", "component_id"))
    rare = facts.join(common, "fp", "left_anti").join(named.select("fp", "component_id"), "fp")
    return facts.join(common, "fp").unionByName(rare).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read_table(spark, sf_dir, "documents"))
