"""Exact Jaccard self-join of word-shingle sets by universe partition.

Sets are grouped into bands by size. Within a band the universe of tokens is hashed into segments, and by the
pigeonhole principle two sets over the threshold agree in a segment, or differ in one token of it. Signatures are the whole
content of a segment and, where the cost-based allocation of the band says so, its one-deletion neighbourhood.
Sets that share a signature are candidates and are verified on their full sets.

Signatures that very many sets have (a passage that fills a segment of each) are left out for sets that meet their partners
by others. Only what decides components is verified: equal sets collapse to one representative; in each bucket members
are compared with its leader, the set that shares the most signatures, which then leaves the bucket, and in later rounds
only sets of different components meet. The last round decides all that are left, block against block, so no link
between different components is lost, and no round makes rows of all pairs of a group.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, materialize, mix64, read_table, remove, shingle_hashes, small_batches, word_hashes

SHINGLE = 3
PERCENT = 90
BAND_GROWTH = 1.25
LEADER_ROUNDS = 3
BROADCAST_IDS = 500_000  # numbers or pairs of numbers, eight bytes each
SPARE = 0.15  # units beyond those that the pigeonhole needs, as a share of these
FREQUENT = 4  # sets of a signature beyond which sets do without it where they can
MEMBERS = 256  # of a leader that one copy of its set serves
BLOCK_SETS, BLOCK_TOKENS = 1024, 1_000_000  # of a block: sets, and tokens of eight bytes
PARTNERS = 16  # blocks that one copy of a block meets
SKETCH = 2048  # bits that stand for a set until its pair may link
_SEED = np.uint64(0x9FB21C651E98DF25)


@dataclass(frozen=True)
class Allocation:
    """Segments of a band: the first `deletions` also index one-deletion neighbourhoods."""

    low: int
    high: int  # first size above the band
    segments: int
    deletions: int
    slack: int  # units that weak segments may lose
    weak_size: int  # both sides share no more tokens than this in a weak segment


def _poisson_at_most(k: int, rate: float) -> float:
    return sum(math.exp(-rate) * rate**i / math.factorial(i) for i in range(k + 1))


@lru_cache(maxsize=None)
def allocation(band: int, percent: int) -> Allocation:
    """The cheapest segments for a band of sizes.

    Two sets of sizes a and b with 100 * |intersection| >= percent * |union| differ in at most
    (100 - percent) * (a + b) / (100 + percent) tokens. Segments provide units: one each, two with deletions. With
    more units than that difference, some segment agrees to within what it indexes. A weak segment (none or one
    token that both share) isn't indexed; `slack` units make up for weak segments. The cost of an allocation is its number of
    signatures plus what is lost where segments become so short that unrelated sets share them.
    """
    low, high = band_edges(band, percent)
    most = (100 - percent) * 2 * (high - 1) // (100 + percent)
    best = None
    # units to spare let sets do without frequent signatures; the smallest sets have no room for them
    for spare, weak_size, share in ((s, w, r) for s in (math.ceil(SPARE * (most + 1)), 0) for w in (0, 1) for r in (0, 0.05, 0.25, 0.5, 1)):
        if spare or best is None or best[2] == 0:
            least = most + 1 + spare
            units = least
            for _ in range(200):  # segments that deletions strengthen are a share of all; units grow until they cover the weak ones
                segments = max(1, math.ceil(units / (1 + share)))
                deletions = min(segments, max(0, units - segments))
                rate = low / segments
                weak = (segments - deletions) * _poisson_at_most(weak_size, rate) + 2 * deletions * _poisson_at_most(weak_size + 1, rate)
                need = least + (math.ceil(weak + 2 * math.sqrt(weak)) if weak > 1e-4 else 0)
                if need <= segments + deletions or rate < 1:
                    break
                units = max(units + 1, need)
            slack = segments + deletions - most - 1
            if rate < 1 and low > 1:
                continue
            # tokens are runs of several words and rarely shared by chance, but in phrases that many texts have, and short
            # texts may consist of these; a meeting by a short signature costs a verification, some dozens of signatures' worth
            chance = 24 if low < 48 else 1
            one, two = rate * math.exp(-rate), rate**2 / 2 * math.exp(-rate)
            meet = (segments - deletions) * ((weak_size < 1) * one + 0.25 * two) + deletions * ((weak_size < 1) * (one + 2 * two) + 0.25 * (two + two * rate))
            cost = segments + deletions * (1 + rate) + chance * meet
            if best is None or cost < best[0]:
                best = (cost, Allocation(low, high, segments, deletions, slack, weak_size), spare)
    # no candidate keeps a token a segment on average: one deletion, and a segment for every other unit that is needed
    plan = best[1] if best else Allocation(low, high, max(1, most), 1, max(1, most) - most, 0)
    assert plan.slack >= 0 and plan.segments + plan.deletions - plan.slack >= most + 1
    return plan


@lru_cache(maxsize=None)
def _edges(percent: int) -> tuple[int, ...]:
    """First sizes of the bands; partners lie in the same band or the next."""
    edges = [1]
    while edges[-1] < 1 << 40:
        reach = edges[-1] * 100 // percent + 1
        edges.append(max(reach, math.ceil(edges[-1] * BAND_GROWTH)))
    return tuple(edges)


def band_edges(band: int, percent: int) -> tuple[int, int]:
    e = _edges(percent)
    return e[band], e[band + 1]


def bands_of(size: int, percent: int) -> list[int]:
    """The band of a size, and the next one where a larger partner may lie in it."""
    e = _edges(percent)
    b = int(np.searchsorted(e, size, side="right")) - 1
    return [b, b + 1] if size * 100 // percent >= e[b + 1] else [b]


def signature_rows(tokens: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit signatures of a set of token hashes over its bands, and with each its band, spare units and own units (see `_info`)."""
    out, info = [], []
    for band in bands_of(len(tokens), percent):
        plan = allocation(band, percent)
        salt = mix64(np.array([band + 1], np.uint64) * _SEED)
        segment = (mix64(tokens ^ salt) % np.uint64(plan.segments)).astype(np.int64)
        value = mix64(tokens + salt)
        total = np.zeros(plan.segments, np.uint64)
        np.add.at(total, segment, value)  # order-free, and a deletion is a subtraction
        size = np.bincount(segment, minlength=plan.segments)
        plain = np.arange(plan.segments) >= plan.deletions
        lost = int((plain & (size <= plan.weak_size)).sum() + 2 * (~plain & (size <= plan.weak_size + 1)).sum())
        least = 0 if lost > plan.slack else plan.weak_size + 1  # a set with many weak segments indexes these as well
        spare = max(0, plan.slack - lost)  # a set that indexes weak segments spares none: the other set may lack these
        name = mix64(np.arange(plan.segments, dtype=np.uint64) + salt)
        whole = mix64(total + name) ^ mix64(size.astype(np.uint64) + name)
        out.append(whole[size >= least])
        info.append(_info(band, spare, np.where(plain, 1, 2)[size >= least]))
        if plan.deletions:
            pick = (segment < plan.deletions) & (size[segment] - 1 >= least)
            s = segment[pick]
            out.append(mix64(total[s] - value[pick] + name[s]) ^ mix64((size[s] - 1).astype(np.uint64) + name[s]))
            info.append(_info(band, spare, np.full(len(s), 2)))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    sig, first = np.unique(np.concatenate(out), return_index=True)
    return sig.view(np.int64), np.concatenate(info)[first].astype(np.int32)


def _info(band: int, spare: int, units: np.ndarray) -> np.ndarray:
    """The band, the units that its set may do without there, and those that hiding one signature may cost, in one number."""
    return (band << 20) | (min(spare, (1 << 17) - 1) << 2) | units


def signatures(tokens: np.ndarray, percent: int) -> np.ndarray:
    """Distinct 64-bit signatures of a set of token hashes, over its bands."""
    return signature_rows(tokens, percent)[0]


def tokens_of(text: str | None, shingle: int) -> np.ndarray:
    return shingle_hashes(word_hashes(text or ""), shingle)


def _set_id(tokens: np.ndarray) -> int:
    """64 bits that tell sets apart."""
    plain = np.array([tokens.sum(dtype=np.uint64)]) + np.uint64(len(tokens))
    mixed = np.array([mix64(tokens ^ _SEED).sum(dtype=np.uint64)])
    return int((mix64(plain) ^ mix64(mix64(mixed))).view(np.int64)[0])


def smallest_with_partners(percent: int) -> int:
    """Sets smaller than this link with equal sets only."""
    return next(i for i in range(1, 1000) if i * 100 >= percent * (i + 1))


def _describe(shingle: int):
    def run(batches):
        for b in batches:
            n, key = [], []
            for t in b.column("text"):
                s = tokens_of(t.as_py(), shingle)
                n.append(len(s))
                key.append(_set_id(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(key, pa.int64())], ["doc_id", "n", "set"])

    return run


def _index(shingle: int, percent: int):
    least = smallest_with_partners(percent)

    def run(batches):
        seen: set[int] = set()  # copies within a task are indexed once; only saves work
        for b in batches:
            keys, made, notes = [], [], []
            for t in b.column("text"):
                s = tokens_of(t.as_py(), shingle)
                if len(s) < least:
                    continue
                key = _set_id(s)
                if key in seen:
                    continue
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(key)
                sig, info = signature_rows(s, percent)
                keys.append(np.full(len(sig), key, np.int64))
                made.append(sig)
                notes.append(info)
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (made, keys, notes)], _ENTRY_NAMES)

    return run


_ENTRIES = "sig long, set long, info int"
_ENTRY_NAMES = [x.split()[0] for x in _ENTRIES.split(", ")]


def _shared(batches):
    """Of rows sorted by (sig, set), those whose signature another set has; constant memory."""
    held: tuple[int, int, int] | None = None  # the last row, and whether it has been put out
    out_held = False
    for b in batches:
        cols = [b.column(n).to_numpy(zero_copy_only=False) for n in _ENTRY_NAMES]
        if not len(cols[0]):
            continue
        if held is not None:
            cols = [np.concatenate([np.array([h], c.dtype), c]) for h, c in zip(held, cols, strict=True)]
        sig, key, _ = cols
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
        flag = np.zeros(len(sig), bool)
        flag[0] = held is not None and out_held
        cols, flag = [c[new] for c in cols], flag[new]
        sig = cols[0]
        same = np.zeros(len(sig), bool)
        same[1:] = sig[1:] == sig[:-1]
        both = same.copy()
        both[:-1] |= same[1:]
        put = both & ~flag
        if put.any():
            yield pa.RecordBatch.from_arrays([pa.array(c[put]) for c in cols], _ENTRY_NAMES)
        held, out_held = tuple(int(c[-1]) for c in cols), bool(both[-1] or flag[-1])


def _needed(shared: DataFrame) -> DataFrame:
    """(sig, set) without the rows of frequent signatures that a set can do without.

    Of a pair that links, more units agree than either set may spare. Where the frequent signatures of one of the two cost
    no more units than it may spare, the pair meets by another signature as well. So frequent ones are kept only
    for sets that can't spare them, and what they share with others is found by those others.
    """
    frequent = shared.groupBy("sig").agg(F.count("*").alias("m")).where(F.col("m") > FREQUENT).select("sig")
    hot = materialize(shared.join(frequent, "sig", "left_semi").withColumn("band", F.shiftright("info", 20)))
    spent = hot.groupBy("set", "band").agg(F.sum(F.col("info").bitwiseAND(3)).alias("cost"), F.max(F.shiftright("info", 2).bitwiseAND((1 << 18) - 1)).alias("spare"))
    bound = spent.where("cost > spare").select("set", "band")
    return shared.join(frequent, "sig", "left_anti").select("sig", "set").unionByName(hot.join(bound, ["set", "band"], "left_semi").select("sig", "set"))


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Bit i says whether an odd number of tokens is i modulo SKETCH: two sets differ in at least as many tokens as their sketches in bits."""
    odd = np.bincount((tokens % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(shingle: int):
    def run(batches):
        for b in batches:
            made = [tokens_of(t.as_py(), shingle) for t in b.column("text")]
            cols = [pa.array([len(s) for s in made], pa.int64()), pa.array([sketch(s) for s in made], pa.list_(pa.int64())), pa.array([s.tobytes() for s in made], pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *cols], ["doc_id", "n", "bits", "tokens"])

    return run


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    if len(x) > len(y):
        x, y = y, x
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[at] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verify(percent: int):
    """Of rows sorted by (a, part, b), where the row without b has the leader's set, the pairs that link; one leader's set is held at a time."""

    def run(batches):
        held, leader = None, np.zeros(0, np.uint64)
        for batch in batches:
            out: tuple[list, list] = ([], [])
            for a, part, b, tokens in zip(batch.column("a").to_pylist(), batch.column("part").to_pylist(), batch.column("b").to_pylist(), batch.column("tokens"), strict=True):
                tokens = np.frombuffer(tokens.as_buffer(), np.uint64)
                if b is None:
                    held, leader = (a, part), tokens.copy()
                elif held == (a, part) and linked(leader, tokens, percent):
                    out[0].append(a)
                    out[1].append(b)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["a", "b"])

    return run


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for the ends of `edges` (a, b) that reach a smaller id: the smallest. Components' smallest ids have no row.

    Alternating large-star and small-star steps (Kiveris and others, "Connected Components in MapReduce and Beyond",
    2014): the number of edges never grows beyond the input's, and rounds grow with the logarithm of the longest path.
    Minima are taken by aggregation, so a component of any size burdens no task.
    """
    cur = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _are_stars(cur):
        # large star: every larger neighbour is joined to the smallest id around the centre
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = materialize(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # small star: every smaller neighbour, and the centre, are joined to the smallest
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = materialize(small.unionByName(small_least.select("u", F.col("m").alias("v"))).distinct())
        remove(large)
        remove(cur)
        cur = nxt
    return cur.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _are_stars(e: DataFrame) -> bool:
    """Whether each of the edges (u, v) is the only one of its u, and no v is a u: then steps change nothing more."""
    ends = e.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(e.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return not ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up + down > 1").count()


def _merged(label: DataFrame | None, ids: DataFrame, links: DataFrame) -> DataFrame:
    """(doc_id, component) of `ids` when `links` (a, b) are added to those that made `label`: components are linked, not their members again."""
    if label is None:
        comp = connected_components(links).withColumnRenamed("id", "doc_id")
        return materialize(ids.join(comp, "doc_id", "left").select("doc_id", F.coalesce("component", "doc_id").alias("component")))
    if links.isEmpty():
        return label
    a, b = (label.select(F.col("doc_id").alias(k), F.col("component").alias(f"c{k}")) for k in "ab")
    comp = connected_components(links.join(a, "a").join(b, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    moved = comp.select(F.col("id").alias("component"), F.col("component").alias("to"))
    return materialize(label.join(moved, "component", "left").select("doc_id", F.coalesce("to", "component").alias("component")))


def _near(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs without those whose sketches tell that they don't link: sets that do differ in (100 - percent) / (100 + percent) of
    their sizes' sum at most."""
    if pairs.count() <= BROADCAST_IDS:
        pairs = F.broadcast(pairs)
    x, y = (sets.select(F.col("doc_id").alias(k), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"bits{k}")) for k in "ab")
    apart = sum((F.bit_count(F.get("bitsa", F.lit(i)).bitwiseXOR(F.get("bitsb", F.lit(i)))) for i in range(SKETCH // 64)), F.lit(0))
    return pairs.join(x, "a").join(y, "b").where((100 + percent) * apart <= (100 - percent) * (F.col("na") + F.col("nb"))).select("a", "b")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the candidate pairs that link; a is the side that may be in very many pairs.

    Sketches decide most pairs; sets go to the others alone. A leader's set is sent once for each MEMBERS of its pairs, not with every pair.
    """
    pairs = materialize(_near(pairs, sets, percent))
    fan = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).cast("long").alias("parts"))
    small = pairs.count() <= BROADCAST_IDS

    def with_tokens(keyed: DataFrame, key: str) -> DataFrame:
        return sets.select(F.col("doc_id").alias(key), "tokens").join(F.broadcast(keyed) if small else keyed, key)

    members = with_tokens(pairs.join(fan, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"), "b"), "b").select("a", "part", "b", "tokens")
    leaders = with_tokens(fan.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")), "a").select("a", "part", F.lit(None).cast("long").alias("b"), "tokens")
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.unionByName(leaders).repartition(parts, "a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return materialize(arrow_map(dealt, _verify(percent), "a long, b long"))


def _leads(cur: DataFrame) -> DataFrame:
    """(sig, lead) with the best member of each bucket, by aggregation: a bucket of any size burdens no task."""
    return cur.groupBy("sig").agg(F.max(F.struct("order", "doc_id", "component", "n")).alias("lead"))


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of `docs` whose doc_id is in `ids`; ids are broadcast up to BROADCAST_IDS of them, else both sides are exchanged."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, "doc_id", "left_semi")


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every document.

    Words are the runs of bytes other than ASCII white space after A-Z are lower-cased; a set is a text's distinct
    shingles, with fewer words the whole sequence. Two documents link when 100 * |intersection| >= percent * |union|;
    component_id is the smallest doc_id reachable by links. Without words or text a document has no shingle and no link.
    Tokens are 64-bit hashes. doc_id is unique; a row repeated in full gives the same result again. Empty tables give empty
    results. Other columns aren't read.
    """
    # every step is written and read again, so its exchange is needed no more when it ends
    docs.sparkSession.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    facts = materialize(arrow_map(narrow, _describe(shingle), "doc_id long, n long, set long"))
    reps = facts.where("set is not null").groupBy("set").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"))

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = narrow.where("text is not null").mapInArrow(_index(shingle, percent), _ENTRIES)
    sorted_entries = entries.repartition(parts, "sig").sortWithinPartitions("sig", "set")
    shared = materialize(_large_batches(sorted_entries).mapInArrow(_shared, _ENTRIES))
    small_batches(docs.sparkSession)
    shared, found = materialize(_needed(shared)), shared
    remove(found)
    fame = shared.groupBy("set").agg(F.count("*").alias("fame")).join(reps, "set").select("set", "doc_id", "n", "fame")
    members = materialize(shared.join(fame, "set").select("sig", "doc_id", "n", F.struct("fame", (-F.col("doc_id")).alias("id")).alias("order")))
    remove(shared)
    ids = materialize(members.select("doc_id").distinct())
    sets = materialize(arrow_map(_only(narrow, ids).dropDuplicates(["doc_id"]) if _repeats(facts) else _only(narrow, ids), _sets(shingle), "doc_id long, n long, bits array<long>, tokens binary"))

    cur = members.withColumn("component", F.col("doc_id"))
    label = seen = None
    for step in range(LEADER_ROUNDS + 1):
        if label is not None:
            cur = members.join(label, "doc_id")
            mixed = cur.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("sig")
            cur = materialize(cur.join(mixed, "sig", "left_semi"))
            if not cur.take(1):
                break
        if step == LEADER_ROUNDS:
            new = _blocks(cur, sets, percent)
        else:
            met = materialize(cur.join(_leads(cur), "sig").select("sig", F.col("lead.doc_id").alias("a"), F.col("doc_id").alias("b"), (F.expr(f"component <> lead.component and 100 * least(n, lead.n) >= {percent} * greatest(n, lead.n)")).alias("open")))
            pairs = met.where("open").select("a", "b").distinct()
            if seen is not None:
                pairs = pairs.join(seen, (F.least("a", "b") == F.col("lo")) & (F.greatest("a", "b") == F.col("hi")), "left_anti")
            pairs = materialize(pairs)
            new = _linked(pairs, sets, percent)
            done = pairs.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
            seen = done if seen is None else seen.unionByName(done)
            # a leader has met all of its bucket
            members = materialize(members.join(met.where("a = b").select("sig", F.col("a").alias("doc_id")), ["sig", "doc_id"], "left_anti"))
            remove(met)
        label = _merged(label, ids, new)
    remove(members)
    remove(sets)
    named = reps.join(label, "doc_id", "left").select("set", F.coalesce("component", "doc_id").alias("component"))
    return facts.join(named, "set", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def _pack(batches):
    """Rows sorted by block, as one row for each block."""
    held: dict | None = None

    def put(h):
        cols = {k: pa.array([v], pa.int64()) for k, v in zip(("candidate", "block", "blocks"), h["key"], strict=True)}
        cols |= {k: pa.array([np.array(h[k], np.int64).tobytes()], pa.binary()) for k in ("ids", "components", "sizes")}
        return pa.RecordBatch.from_pydict(cols | {"tokens": pa.array([b"".join(h["tokens"])], pa.binary())})

    for b in batches:
        for r in b.to_pylist():
            key = (r["candidate"], r["block"], r["blocks"])
            if held is not None and held["key"] != key:
                yield put(held)
                held = None
            if held is None:
                held = {"key": key, "ids": [], "components": [], "sizes": [], "tokens": []}
            held["ids"].append(r["doc_id"])
            held["components"].append(r["component"])
            held["sizes"].append(len(r["tokens"]) // 8)
            held["tokens"].append(r["tokens"])
    if held is not None:
        yield put(held)


class _Block:
    """Sets of a block: ids, components, sizes, and the tokens of all with the set that each belongs to."""

    def __init__(self, row: dict) -> None:
        self.ids, self.components, self.sizes = (np.frombuffer(row[k], np.int64) for k in ("ids", "components", "sizes"))
        self.tokens = np.frombuffer(row["tokens"], np.uint64)
        self.owner = np.repeat(np.arange(len(self.sizes)), self.sizes)

    def links(self, other: _Block, percent: int) -> list[tuple[int, int]]:
        """Links that join components; of several that join the same two, the first."""
        names = np.intersect1d(self.tokens, other.tokens)  # the others add to no intersection
        both = np.zeros((len(self.sizes), len(other.sizes)), np.float32)
        if len(names):
            place = []
            for b in (self, other):
                at = np.minimum(np.searchsorted(names, b.tokens), len(names) - 1)
                hit = names[at] == b.tokens
                place.append((b.owner[hit], at[hit]))
            for low in range(0, len(names), 4096):  # bounds the matrices
                made = []
                for b, (owner, at) in zip((self, other), place, strict=True):
                    x = np.zeros((len(b.sizes), min(4096, len(names) - low)), np.float32)
                    here = (at >= low) & (at < low + 4096)
                    x[owner[here], at[here] - low] = 1
                    made.append(x)
                both += made[0] @ made[1].T
        both = both.astype(np.int64)
        fit = (100 * both >= percent * (self.sizes[:, None] + other.sizes[None, :] - both)) & (self.components[:, None] != other.components[None, :])
        root: dict[int, int] = {}

        def find(c):
            while root.get(c, c) != c:
                c = root[c]
            return c

        out = []
        for i, j in zip(*np.nonzero(fit), strict=True):
            x, y = find(int(self.components[i])), find(int(other.components[j]))
            if x != y:
                root[max(x, y)] = min(x, y)
                out.append((int(self.ids[i]), int(other.ids[j])))
        return out


def _meet(percent: int):
    """Rows sorted by (candidate, x, part, d): a block comes first (d = 0) and meets those after it, and in part 0 itself."""

    def run(batches):
        key, held = None, None
        for batch in batches:
            for r in batch.to_pylist():
                block = _Block(r)
                if r["d"] == 0:
                    key, held = (r["candidate"], r["x"], r["part"]), block
                    out = held.links(held, percent) if r["part"] == 0 else []
                else:
                    out = held.links(block, percent) if key == (r["candidate"], r["x"], r["part"]) else []
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([v[k] for v in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def _blocks(cur: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among members of common buckets that leaders have left in different components.

    Members that are connected by buckets are dealt into blocks of bounded size, and blocks meet in matrix products, so
    every pair is decided and none is a row.
    """
    spark = cur.sparkSession
    star = cur.select("sig", "doc_id").join(cur.groupBy("sig").agg(F.min("doc_id").alias("a")), "sig").where("doc_id <> a").select("a", F.col("doc_id").alias("b")).distinct()
    cand = connected_components(star).withColumnRenamed("id", "doc_id").withColumnRenamed("component", "candidate")
    rows = materialize(cur.select("doc_id", "component", "n").distinct().join(cand, "doc_id", "left").withColumn("candidate", F.coalesce("candidate", "doc_id")))
    size = rows.groupBy("candidate").agg(F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_TOKENS)).cast("long").alias("blocks"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(rows.join(size, "candidate").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks"))).drop("n"))
    dealt = sets.join(F.broadcast(placed) if placed.count() <= BROADCAST_IDS else placed, "doc_id").select("candidate", "block", "blocks", "doc_id", "component", "tokens")
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(conf, "64")
    kinds = "candidate long, block long, blocks long, ids binary, components binary, sizes binary, tokens binary"
    packed = materialize(dealt.repartition(parts, "candidate", "block").sortWithinPartitions("candidate", "block", "doc_id").mapInArrow(_pack, kinds))
    # of n blocks in a circle each meets the n / 2 next ones, PARTNERS of them in a task
    held = packed.select("*", F.col("block").alias("x"), F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"blocks div 2 div {PARTNERS}"))).alias("part"), F.lit(0).cast("long").alias("d"))
    others = (
        packed.where("blocks > 1")
        .select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.expr("blocks div 2"))).alias("d"))
        .select("*", F.expr("pmod(block - d, blocks)").alias("x"), F.expr(f"d div {PARTNERS}").alias("part"))
        .where("2 * d <> blocks or x < block")
    )
    spark.conf.set(conf, "1")
    dealt = held.unionByName(others).repartition(parts, "candidate", "x", "part").sortWithinPartitions("candidate", "x", "part", "d")
    met = materialize(dealt.mapInArrow(_meet(percent), "a long, b long"))
    small_batches(spark)
    return met


def _repeats(facts: DataFrame) -> bool:
    return bool(facts.groupBy("doc_id").count().where("count > 1").take(1))


def _large_batches(df: DataFrame) -> DataFrame:
    """Rows of a few numbers may travel in larger batches than texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
    return df


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))
