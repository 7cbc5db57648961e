"""Conversation repair, SimHash and ball k-means against brute force, their SQL, and edge cases."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from unisono.llm import ball_kmeans, conversation_repair, simhash_dedup
from unisono.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def same_as_sql(spark, name, table):
    got = QUERIES[name](spark, SF).toPandas()
    con = duckdb.connect()
    con.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    want = con.sql(ORACLE_SQL[name]).df()
    key = want.columns[0]
    assert got.sort_values(key).to_dict("records") == want.sort_values(key)[list(got.columns)].to_dict("records")


# ---- conversation repair ----


@pytest.fixture
def cut_small(monkeypatch):
    """Conversations of more than three rows are long, and chunks have two rows."""
    monkeypatch.setattr(conversation_repair, "LONG_ROWS", 3)
    monkeypatch.setattr(conversation_repair, "CHUNK", 2)


@pytest.mark.parametrize("long", [False, True])
def test_repair_equals_sql(spark, long, request):
    if long:
        request.getfixturevalue("cut_small")
    same_as_sql(spark, "op11_conversation_repair", "conversations")


def _brute(rows):
    """Cheapest cost and least audit of (initial, fault) by trying every edit, for each sequence of roles; at most two inserts in a
    row can help."""
    ways = {"": (0, "")}

    def more(to, roles, way):
        to[roles] = min(to.get(roles, way), way)

    for initial, fault in [*rows, (None, None)]:
        for _ in range(2):
            for roles, (c, audit) in list(ways.items()):
                for r in "ua":
                    more(ways, roles + r, (c + 2, audit + "I"))
        if initial is None:
            break
        new = {}
        for roles, (c, audit) in ways.items():
            more(new, roles, (c + 3, audit + "D"))
            if fault < 2:
                more(new, roles + initial, (c + fault, audit + "K"))
                for r in "ua":
                    more(new, roles + r, (c + 2 + fault, audit + "R"))
        ways = new
    return min(way for roles, way in ways.items() if re.fullmatch("(s?(ua)+)?", roles))


def test_layers_equal_brute_force():
    rng = random.Random(5)
    for _ in range(60):
        plan = [(rng.choice("suax"), rng.choice([0, 0, 0, 1, 2, 3]), 0) for _ in range(rng.randint(0, 3))]
        layers = conversation_repair.all_layers(plan, conversation_repair.end_layers([0, None, None, 0]))
        audit, state = conversation_repair.trace(plan, layers, 0, True)
        assert (conversation_repair.cost_of(layers[0], 0), audit) == _brute([r[:2] for r in plan])
        assert state in (0, 3)


def test_chunks_chain_like_whole_conversations():
    rng = random.Random(6)
    for _ in range(200):
        plan = [(rng.choice("suaa"), rng.choice([0, 0, 1, 2, 3]), rng.choice([0, 0, 0, 2])) for _ in range(rng.randint(1, 12))]
        end = conversation_repair.end_layers([0, None, None, 0])
        whole = conversation_repair.all_layers(plan, end)
        at = rng.randint(0, len(plan))
        tables = [conversation_repair.all_layers(plan[:at], conversation_repair.end_layers([0 if q == e else None for q in range(4)]))[0] for e in range(4)]
        after = [conversation_repair.cost_of(whole[at], q) for q in range(4)]
        for q in range(4):
            ways = [conversation_repair.cost_of(tables[e], q) + after[e] for e in range(4) if conversation_repair.cost_of(tables[e], q) is not None]
            assert min(ways) == conversation_repair.cost_of(whole[0], q)
        first = conversation_repair.all_layers(plan[:at], conversation_repair.end_layers(after))
        a, q = conversation_repair.trace(plan[:at], first, 0, False)
        b, _ = conversation_repair.trace(plan[at:], whole[at:], q, True)
        assert a + b == conversation_repair.trace(plan, whole, 0, True)[0]


TALK = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Hello."), (2, None, "user", "No turn."), (2, 5, None, "x" * 200_000 + "."), (2, 5, "assistant", "Tie."), (2, 5, "user", "Tie."), (2, 9, "tool", None), (None, 1, "system", "Only."), (None, 2, "user", " \t\n"), (3, 0, "user", ""), (4, 0, "assistant", "cut"), (4, 0, "assistant", "cut"), (4, 0, "assistant", "cut")]


def _by_hand(rows):
    """Everything for one conversation, from the sorted rows (turn, role, text)."""
    seen, plan, made = set(), [], {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        body = text.strip(" \t\n\v\f\r")
        fault = 2 if not body else 3 if (role, text) in seen else 1 if body[-1] not in ".!?" else 0
        seen.add((role, text))
        plan.append((role[:1], fault))
    made |= {k: sum(f == n for _, f in plan) for k, n in (("blank", 2), ("duplicate", 3), ("truncated", 1))}
    made["illegal"] = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(plan))
    turns = [t for t, _, _ in rows if t is not None]
    made["gaps"] = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    made["cost"], made["audit"] = _brute(plan)
    return made


@pytest.mark.parametrize("long", [False, True])
def test_repair_edges(spark, long, request):
    """Null conv_id, turn, role and text, a tie of turns, repeats, a very long text, an unknown role, an extra column."""
    if long:
        request.getfixturevalue("cut_small")
    frame = spark.createDataFrame([(*r, "x") for r in TALK], "conv_id long, turn long, role string, text string, audit string").repartition(3)
    filled = frame.withColumn("role", F.coalesce("role", F.lit(" "))).withColumn("text", F.coalesce("text", F.lit(" "))).withColumn("copies", F.lit(1).cast("long"))
    done = conversation_repair.repair(filled)
    got = {r.conv_id: r.asDict() for r in done.conversations.collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for conv in got:
        rows = sorted(((t, r or " ", " " if x is None else x) for c, t, r, x in TALK if c == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        assert {k: v for k, v in got[conv].items() if k != "conv_id"} == _by_hand(rows), conv
    hashed = {r.conv_id: r.repaired_sha256 for r in conversation_repair.digests(done.turns).collect()}
    assert hashed["1"] == hashlib.sha256(b"user:Hi.\nassistant:Hello.").hexdigest()
    assert conversation_repair.repair(filled.where("false")).conversations.count() == 0


def test_a_dropped_conversation_stays_in_the_result(spark, tmp_path):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    (row,) = conversation_repair.op11_conversation_repair(spark, str(tmp_path)).collect()
    assert (row.conv_id, row.cost, row.audit, row.repaired_sha256) == (gone, 0, "", hashlib.sha256(b"").hexdigest())


# ---- SimHash ----


def _fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))))
    h = [xxhash.xxh64(b" ".join(words[i : i + 4]), seed=42).intdigest() for i in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _components(keys, close):
    """Smallest key by brute force over all pairs."""
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(keys, 2):
        if close(a, b):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def test_fingerprints():
    assert simhash_dedup.fingerprint(None) == simhash_dedup.fingerprint(" \n") == 0
    for t in ("One", "a b c", "A b\tC d e", "to be or not to be " * 50, "Ünïcode İ K words " * 3, "x" * 100_000 + " y"):
        assert simhash_dedup.fingerprint(t) == _fingerprint(t)


def _clusters(rng):
    """A cluster whose fingerprints differ from its centre by up to seven bits, chains of steps of four, and single ones near to nothing."""
    centre = rng.getrandbits(64)
    fps = {centre} | {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 7))) for _ in range(150)}
    at = rng.getrandbits(64)
    for _ in range(20):
        at ^= sum(1 << b for b in rng.sample(range(64), 4))
        fps.add(at)
    fps |= {0, 1, 31} | {rng.getrandbits(64) & ~0xFFF for _ in range(150)}
    return sorted(f - (1 << 64) if f >> 63 else f for f in fps)


@pytest.mark.parametrize(("parts", "block", "few"), [(5, 16, 2), (4, 8192, 2), (2, 24, 64)])
def test_links_equal_brute_force(spark, parts, block, few, monkeypatch):
    """All plans, and buckets pair by pair, by search and by blocks."""
    monkeypatch.setattr(simhash_dedup, "BLOCK", block)
    monkeypatch.setattr(simhash_dedup, "FEW", few)
    fps = _clusters(random.Random(7))
    frame = spark.createDataFrame([(f, 1 + i % 3) for i, f in enumerate(fps)], "fp long, copies long").repartition(3)
    got = {r.fp: r.label for r in simhash_dedup._labels(frame.select("fp"), simhash_dedup.near_links(frame, len(fps), parts=parts)).collect()}
    assert got == _components(fps, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 4)


def test_allocation_spends_what_the_pigeonhole_needs():
    """Units sum to distance + 1, and a partition whose value all have gets none."""
    rng = np.random.default_rng(3)
    fp = rng.integers(0, 1 << 63, 5000, dtype=np.uint64) & ~np.uint64((1 << 13) - 1)
    parts = [list(range(i * 13, min(64, i * 13 + 13))) for i in range(5)]
    near = [tuple(simhash_dedup.near_counts(100 * np.bincount(simhash_dedup.values(fp, h), minlength=1 << len(h)), 4) for h in simhash_dedup.halves(p)) for p in parts]
    units = simhash_dedup.allocate(fp, parts, near, len(fp) * 100, 4)
    assert (units.sum(axis=1) == 5).all() and (units[:, 0] == 0).all()


def test_near_counts():
    counts = np.random.default_rng(1).integers(0, 9, 64)
    got = simhash_dedup.near_counts(counts, 3)
    for v in range(64):
        assert got[v].tolist() == [sum(int(counts[u]) for u in range(64) if (u ^ v).bit_count() == k) for k in range(4)]


def test_simhash_edges(spark):
    """Null, blank and very long texts, copies, a repeated row, a null id, a clashing extra column; empty tables."""
    rows = [(5, None, 1), (3, "", 1), (9, " \t", 1), (4, "Some words that are here twice", 1), (7, "some WORDS\nthat are here  twice", 2), (7, "some WORDS\nthat are here  twice", 2), (2, "long " * 60_000, 1), (None, "", 1), (8, "alone among all of these", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp long")
    got = sorted((tuple(r) for r in simhash_dedup.simhash_components(docs).collect()), key=str)
    want = {3: 3, 5: 3, 9: 3, None: 3, 4: 4, 7: 4, 2: 2, 8: 8}
    assert got == sorted(((i, f"{_fingerprint(t):016x}", want[i]) for i, t, _ in rows), key=str)
    assert simhash_dedup.simhash_components(docs.where("false")).count() == 0


def test_simhash_equals_brute_force(spark):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op12_simhash_dedup"](spark, SF).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    fps = {i: _fingerprint(t) for i, t in texts.items()}
    comp = _components(sorted(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 4)
    assert got == {i: (f"{fps[i]:016x}", comp[i]) for i in fps}


# ---- ball k-means ----


def test_kmeans_equals_sql(spark):
    same_as_sql(spark, "op13_ball_kmeans", "embeddings")


def _lloyd(rows, k, rounds, scale, seed=2):
    """(id, cluster, distance) with Python integers."""
    vs = [(i, tuple(int(np.floor(float(x) * scale)) for x in v)) for i, v in rows]
    order = sorted(vs, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    c = [v for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), j) for j, m in enumerate(c)) for _, v in vs]

    for _ in range(rounds):
        got = assign()
        for j in range(len(c)):
            mine = [v for (_, v), (_, w) in zip(vs, got, strict=True) if w == j]
            if mine:
                c[j] = tuple(sum(x) // len(mine) for x in zip(*mine, strict=True))
    return sorted((i, j, d) for (i, _), (d, j) in zip(vs, assign(), strict=True)), [list(x) for x in c]


@pytest.mark.parametrize(("scale", "block"), [(2, 7), (256, 2048), (1 << 24, 16)])
def test_kmeans_equals_lloyd(spark, scale, block, monkeypatch):
    """Coarse scales make ties and empty clusters, fine ones large numbers; copies of rows and vectors; vectors that take no part."""
    monkeypatch.setattr(ball_kmeans, "BLOCK", block)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, 4)) * 3
    rows = [(i, (centres[i % 5] + rng.normal(size=4) * 0.3).tolist()) for i in range(120)]
    rows += [(500 + i, rows[0][1]) for i in range(4)] + [rows[1]] * 2
    bad = [(900, None), (901, [1.0, 2.0, 3.0]), (902, [1.0, None, 1.0, 1.0]), (903, [float("nan")] + [0.0] * 3), (904, [float("inf")] + [0.0] * 3), (905, [])]
    frame = spark.createDataFrame([(*r, 1) for r in rows + bad], "vec_id long, embedding array<double>, cluster int").repartition(3)
    members, centroids = ball_kmeans.ball_kmeans(frame, "vec_id", "embedding", k=9, rounds=4, scale=scale, dim=4)
    want, means = _lloyd(rows, 9, 4, scale)
    assert centroids == means
    assert sorted(tuple(r) for r in members.collect()) == want


def test_balls_prune_and_agree():
    """Members near their centroid meet few others, and all get what a full comparison gives."""
    rng = np.random.default_rng(9)
    c = rng.integers(-1000, 1000, (30, 8))
    x = np.repeat(c, 20, axis=0) + rng.integers(-60, 60, (600, 8))
    near = ball_kmeans.Neighbours(c)
    full = ball_kmeans.nearest(x, c)
    for labels in (full.argmin(axis=1), rng.integers(0, 30, 600)):
        got, d = near.assign(x, labels)
        assert (got == full.argmin(axis=1)).all() and (d == full.min(axis=1)).all()
    own = full[np.arange(600), np.repeat(np.arange(30), 20)]
    reach = [np.searchsorted(near.matter[i // 20], own[i], side="right") for i in range(600)]
    assert np.mean(reach) < 3


def test_kmeans_edges(spark):
    frame = spark.createDataFrame([(1, [0.5, 0.25]), (None, [-1.0, 1e30])], "vec_id long, embedding array<double>")
    members, centroids = ball_kmeans.ball_kmeans(frame, "vec_id", "embedding", dim=2)
    assert len(centroids) == 2 and sorted((tuple(r) for r in members.collect()), key=str) == [(1, 0, 0), (None, 1, 0)]
    members, centroids = ball_kmeans.ball_kmeans(frame.where("false"), "vec_id", "embedding", dim=2)
    assert members.count() == 0 and centroids == []
