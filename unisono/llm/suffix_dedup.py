"""Removal of long repeated strings by a distributed merge sort of suffixes.

Every byte that lies in a string of LENGTH bytes which also starts elsewhere is removed. Suffixes are sorted from anchors
only: in each window of LENGTH bytes the substring of GRAM bytes with the least hash is its anchor, and equal windows have
equal anchors at equal places. Anchors whose substring occurs once are dropped. Tasks sort the suffixes of their anchors into
runs, front-code them (a suffix is sent without the prefix that it shares with the one before) and exchange them by
anchor; a receiving task merges its runs with a loser tree that compares two suffixes from the first byte on in which
they may differ. The merged order gives each suffix's longest prefix shared with any other, and with that the windows that
may occur again; these are settled by what stands before the anchor.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, materialize, mix64, prefix_hash, read_table, remove, small_batches, span_hash

LENGTH = 400
GRAM = 32
GROUP = 20_000  # suffixes of one anchor in one task; larger groups are dealt to several and settled by a second exchange
BROADCAST_ROWS = 20_000  # entries of a side table; beyond, both sides are exchanged
RUN_BYTES = 24 << 20
_SEGMENT = 1 << 20
_LOW = np.uint64((1 << 24) - 1)


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hashes, their places, and the first and last start of the windows that each anchors."""
    out = []
    for base in range(0, max(0, len(data) - length + 1), _SEGMENT):
        part = data[base : base + _SEGMENT + length - 1]
        p = prefix_hash(part)
        n = len(part) - gram + 1
        h = span_hash(p, np.arange(n), np.arange(gram, gram + n))
        key = (h & ~_LOW) | np.arange(n, dtype=np.uint64)  # ties: the first place
        w = length - gram + 1
        padded = np.concatenate([key, np.full(-n % w, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
        ahead = np.minimum.accumulate(padded, axis=1).ravel()
        behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
        least = (np.minimum(behind[: n - w + 1], ahead[w - 1 : n]) & _LOW).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        last = np.append(first[1:], len(least)) - 1
        at = least[first]
        out.append((h[at].view(np.int64), at + base, first + base, last + base))
    if not out:
        e = np.zeros(0, np.int64)
        return e, e, e, e
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _bytes(text) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def common_prefix(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of two strings that agree in their first `at` bytes."""
    n, step = min(len(a), len(b)), 32
    while at < n and a[at : at + step] == b[at : at + step]:
        at += step
    if at >= n:
        return n
    end = min(n, at + step)
    while at < end and a[at] == b[at]:
        at += 1
    return at


def front_code(strings: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Of sorted strings, the length of the prefix shared with the one before, and the rest."""
    lcps, tails, before = [], [], b""
    for s in strings:
        n = common_prefix(before, s, 0)
        lcps.append(n)
        tails.append(s[n:])
        before = s
    return lcps, tails


class Run:
    """A front-coded sorted run, read from its beginning."""

    __slots__ = ("lcps", "lens", "tails", "at", "place", "text")

    def __init__(self, lcps, lens, tails: bytes) -> None:
        self.lcps, self.lens, self.tails = lcps, lens, tails
        self.at, self.place, self.text = -1, 0, b""

    def next(self) -> int | None:
        """Move on; the prefix that the new string shares with the one before, or None at the end."""
        self.at += 1
        if self.at >= len(self.lcps):
            return None
        n, size = self.lcps[self.at], self.lens[self.at]
        self.text = self.text[:n] + self.tails[self.place : self.place + size]
        self.place += size
        return n


class LoserTree:
    """Merges runs. Each contender keeps the prefix that it shares with the last winner; where two such lengths differ, they
    decide (the longer is the smaller string), and where they are equal, bytes are compared from there on only."""

    def __init__(self, runs: list[Run]) -> None:
        self.runs = runs
        self.size = 1 << max(0, (len(runs) - 1).bit_length())
        self.shared: list[int | None] = [None] * self.size  # None: this run is at its end
        for i, r in enumerate(runs):
            self.shared[i] = 0 if r.next() is not None else None
        self.losers = [-1] * self.size
        self.best = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._build(2 * node), self._build(2 * node + 1)
        win, lose = self._play(a, b)
        self.losers[node] = lose
        return win

    def _play(self, a: int, b: int) -> tuple[int, int]:
        x, y = self.shared[a], self.shared[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if x != y:
            return (a, b) if x > y else (b, a)
        s, t = self.runs[a].text, self.runs[b].text
        n = common_prefix(s, t, x)
        if s[n : n + 1] < t[n : n + 1] or (n == len(s) == len(t) and a < b):
            self.shared[b] = n
            return a, b
        self.shared[a] = n
        return b, a

    def __iter__(self):
        """(run, position in it, string, prefix shared with the string before) in sorted order."""
        while self.shared[self.best] is not None:
            i = self.best
            run = self.runs[i]
            yield i, run.at, run.text, self.shared[i]
            self.shared[i] = run.next()
            node, win = (self.size + i) // 2, i
            while node:
                win, self.losers[node] = self._play(win, self.losers[node])
                node //= 2
            self.best = win


def merge_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of half-open spans as maximal ones."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > end[:-1]]) if len(start) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return start[first], end[np.append(first[1:], len(start)) - 1] if len(start) else end


_RUN = "kind int, part int, doc binary, start binary, end binary, group binary, place binary, lo binary, hi binary, lcps binary, lens binary, tails binary, left_lens binary, lefts binary"
_NAMES = [x.split()[0] for x in _RUN.split(", ")]


def _row(kind: int, part: int, **cols) -> pa.RecordBatch:
    made = {"kind": pa.array([kind], pa.int32()), "part": pa.array([part], pa.int32())}
    for n in _NAMES[2:]:
        v = cols.get(n)
        made[n] = pa.array([v.tobytes() if isinstance(v, np.ndarray) else v], pa.binary())
    return pa.RecordBatch.from_pydict(made)


def _find(length: int, gram: int):
    def run(batches):
        for b in batches:
            h, d = [], []
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                x = anchors(_bytes(t.as_py()), length, gram)[0]
                h.append(x)
                d.append(np.full(len(x), i, np.int64))
            if h:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h)), pa.array(np.concatenate(d))], ["anchor", "doc_id"])

    return run


def _make_runs(length: int, gram: int, parts: int):
    """Sorted front-coded runs of the suffixes at shared anchors; equal surroundings within a task are settled here."""

    def run(batches):
        items: list[tuple] = []  # string, part, group, doc, place, lo, hi, left
        seen: dict[bytes, tuple[int, int, int, bool]] = {}
        done: list[tuple[int, int, int]] = []
        held = 0

        def flush():
            nonlocal items, held
            items.sort(key=lambda x: (x[1], x[0]))
            i = 0
            while i < len(items):
                j = i
                while j < len(items) and items[j][1] == items[i][1]:
                    j += 1
                some = items[i:j]
                lcps, tails = front_code([x[0] for x in some])
                yield _row(
                    1, some[0][1], group=np.array([x[2] for x in some], np.int64), doc=np.array([x[3] for x in some], np.int64), place=np.array([x[4] for x in some], np.int64),
                    lo=np.array([x[5] for x in some], np.int64), hi=np.array([x[6] for x in some], np.int64), lcps=np.array(lcps, np.uint32), lens=np.array([len(t) for t in tails], np.uint32),
                    tails=b"".join(tails), left_lens=np.array([len(x[7]) for x in some], np.uint32), lefts=b"".join(x[7] for x in some),
                )
                i = j
            items, held = [], 0
            if done:
                yield _row(0, 0, doc=np.array([x[0] for x in done], np.int64), start=np.array([x[1] for x in done], np.int64), end=np.array([x[2] for x in done], np.int64))
                done.clear()

        for b in batches:
            for doc, text, want, split in zip(b.column("doc_id").to_pylist(), b.column("text"), b.column("anchors"), b.column("splits"), strict=True):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                want = np.array(want.as_py(), np.int64)
                order = np.argsort(want)
                want, split = want[order], np.array(split.as_py(), np.int64)[order]
                h, at, first, last = anchors(np.frombuffer(data, np.uint8), length, gram)
                k = np.minimum(np.searchsorted(want, h), len(want) - 1)
                for i in np.flatnonzero(want[k] == h).tolist():
                    p, lo, hi, n = int(at[i]), int(first[i]), int(last[i]), int(split[k[i]])
                    right, left = data[p : hi + length], data[lo:p]
                    name = hashlib.blake2b(left + b"\0" + right + b"%d %d" % (p - lo, p - hi), digest_size=16).digest()
                    other = seen.get(name)
                    if other is not None:  # all windows occur again: settled, one of them stands for all
                        done.append((doc, lo, hi + length))
                        if not other[3]:
                            done.append((other[0], other[1], other[2]))
                            seen[name] = (*other[:3], True)
                        continue
                    if len(seen) > 400_000:
                        seen.clear()
                    seen[name] = (doc, lo, hi + length, False)
                    salt = int(mix64(np.array([doc], np.int64).view(np.uint64))[0] % np.uint64(n)) if n > 1 else 0
                    g = int(mix64(np.array([int(h[i]) % (1 << 64)], np.uint64) + np.uint64(salt))[0] & np.uint64((1 << 62) - 1)) * 2 + (n > 1)
                    items.append((right, g // 2 % parts, g - (1 << 62), doc, p, lo, hi, left))
                    held += len(right) + len(left) + 200
            if held > RUN_BYTES:
                yield from flush()
        yield from flush()

    return run


def _settle(members: list[tuple], length: int, spread: bool) -> tuple[list, list]:
    """Spans of the windows of one group that occur again in it, and (if `spread`) a row for each of its other windows.

    A member is (doc, place, lo, hi, left, right, the longest prefix of right that any other member shares).
    """
    spans, rest = [], []
    hashes, owner, starts = [], [], []
    for k, (doc, p, lo, hi, left, right, reach) in enumerate(members):
        data = np.frombuffer(left + right, np.uint8)
        # window s needs right[: s + length - p] to be shared
        top = hi if spread else min(hi, p + reach - length)
        if top < lo:
            continue
        s = np.arange(lo, top + 1)
        prefix = prefix_hash(data)
        hashes.append(span_hash(prefix, s - lo, s - lo + length))
        owner.append(np.full(len(s), k))
        starts.append(s)
    if not hashes:
        return spans, rest
    h, o, s = np.concatenate(hashes), np.concatenate(owner), np.concatenate(starts)
    u, where, n = np.unique(h, return_inverse=True, return_counts=True)
    again = n[where] > 1
    ho, hs = o[again], s[again]  # owners ascend
    cut = np.flatnonzero(np.diff(ho)) + 1
    for at, x in zip([0, *cut.tolist()], np.split(hs, cut), strict=True):
        if not len(x):
            continue
        k = int(ho[at])
        a, b = merge_spans(x, x + length)
        spans += [(members[k][0], i, j) for i, j in zip(a.tolist(), b.tolist(), strict=True)]
    if spread:
        one = np.zeros(len(u), np.int64)
        one[where[::-1]] = np.arange(len(h))[::-1]
        for v, i, c in zip(u.view(np.int64).tolist(), one.tolist(), n.tolist(), strict=True):
            rest.append((v, members[int(o[i])][0] if c == 1 else None, int(s[i]) if c == 1 else None))
    return spans, rest


_FOUND = "doc_id long, start long, end long, window long"


def _merge(length: int, gram: int):
    def run(batches):
        rows: dict[int, list[dict]] = {}
        for b in batches:
            for r in b.to_pylist():
                rows.setdefault(r["part"], []).append(r)
        for part in sorted(rows):
            some = rows.pop(part)
            meta = [{n: np.frombuffer(r[n], np.int64) for n in ("doc", "place", "lo", "hi", "group")} for r in some]
            lefts = []
            for r in some:
                ends = np.concatenate([[0], np.cumsum(np.frombuffer(r["left_lens"], np.uint32), dtype=np.int64)]).tolist()
                lefts.append((ends, r["lefts"]))
            tree = LoserTree([Run(np.frombuffer(r["lcps"], np.uint32).tolist(), np.frombuffer(r["lens"], np.uint32).tolist(), r["tails"]) for r in some])
            spans, rest = [], []

            def close(cluster, spans=spans, rest=rest):
                """Suffixes with a common prefix of at least an anchor's length, by group (anchor and salt)."""
                if len(cluster) < 2 and not (cluster and cluster[0][0] & 1):
                    return
                groups: dict[int, list] = {}
                for x in cluster:
                    groups.setdefault(x[0], []).append(x)
                for g, xs in groups.items():
                    members = []
                    for j, x in enumerate(xs):
                        reach = 0
                        if len(xs) == len(cluster):  # neighbours in the order share the most
                            reach = max(x[7] if j else 0, xs[j + 1][7] if j + 1 < len(xs) else 0)
                        else:
                            reach = length
                        members.append((*x[1:7], reach))
                    if len(members) > 1 or g & 1:
                        a, b = _settle(members, length, bool(g & 1))
                        spans += a
                        rest += b

            cluster: list[tuple] = []
            for i, at, text, shared in tree:
                if shared < gram and cluster:
                    close(cluster)
                    cluster = []
                m, (ends, left) = meta[i], lefts[i]
                cluster.append((int(m["group"][at]), int(m["doc"][at]), int(m["place"][at]), int(m["lo"][at]), int(m["hi"][at]), left[ends[at] : ends[at + 1]], text, shared))
            close(cluster)
            out = [(d, a, b, None) for d, a, b in spans] + [(d, s, None, w) for w, d, s in rest]
            for k in range(0, len(out), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out[k : k + 100_000], strict=True)], ["doc_id", "start", "end", "window"])

    return run


def _spans_of_rows(batches):
    for b in batches:
        for r in b.to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(r[n], np.int64)) for n in ("doc", "start", "end")], ["doc_id", "start", "end"])


def _cut(length: int):
    def run(batches):
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, text, copied, a, z in zip(b.column("doc_id").to_pylist(), b.column("text"), b.column("copied").to_pylist(), b.column("starts").to_pylist(), b.column("ends").to_pylist(), strict=True):
                text = text.as_py()
                data = (text or "").encode("utf-8", "surrogatepass")
                spans = [(0, len(data))] if copied and len(data) >= length else []
                if a and not spans:
                    s, e = merge_spans(np.array(a, np.int64), np.array(z, np.int64))
                    spans = list(zip(s.tolist(), e.tolist(), strict=True))
                kept, at = [], 0
                for s, e in spans:
                    kept.append(data[at:s])
                    at = e
                kept.append(data[at:])
                left = b"".join(kept)
                row = (doc, len(data), len(data) - len(left), len(spans), hashlib.sha256(left).hexdigest())
                for c, v in zip(out, row, strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in out[:4]), pa.array(out[4], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(doc_id, starts, ends) of repeated strings in distinct texts, and (doc_id) of texts that other rows have too.

    Spans of one document may overlap; `merge_spans` joins them. Texts of less than `length` bytes are left out.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.octet_length("text") >= length)
    facts = materialize(docs.select("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha")))
    texts = materialize(facts.groupBy("sha").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")))
    copied = facts.join(texts.where("n > 1").select("sha"), "sha", "left_semi").select("doc_id").distinct()

    found = materialize(arrow_map(docs, _find(length, gram), "anchor long, doc_id long").groupBy("anchor", "doc_id").agg(F.count("*").alias("k")))
    found_once = found.join(texts.select("doc_id"), "doc_id", "left_semi")  # one document for each text
    shared = found_once.groupBy("anchor").agg(F.sum("k").alias("n")).where("n > 1").select("anchor", F.ceil(F.col("n") / GROUP).cast("long").alias("split"))
    wanted = materialize(found_once.select("anchor", "doc_id").join(shared, "anchor").groupBy("doc_id").agg(F.collect_list("anchor").alias("anchors"), F.collect_list("split").alias("splits")))
    remove(found)
    runs = materialize(arrow_map(_with(docs, wanted, F.sum(F.size("anchors"))), _make_runs(length, gram, parts), _RUN))
    remove(wanted)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    merged = materialize(runs.where("kind = 1").repartition(parts, "part").mapInArrow(_merge(length, gram), _FOUND))
    early = runs.where("kind = 0").select("doc", "start", "end").mapInArrow(_spans_of_rows, "doc_id long, start long, end long")
    # windows of groups that were dealt to several tasks: those that occur in two of them, or again in one
    rest = merged.where("window is not null")
    again = rest.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    late = rest.where("doc_id is not null").join(again, "window", "left_semi").select("doc_id", "start", (F.col("start") + length).alias("end"))
    spans = early.unionByName(merged.where("window is null").select("doc_id", "start", "end")).unionByName(late)
    spans = materialize(spans.groupBy("doc_id").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends")))
    small_batches(spark)
    remove(runs)
    remove(merged)
    return spans, copied


def _with(docs: DataFrame, side: DataFrame, weight) -> DataFrame:
    """`docs` joined with a table by doc_id; that is broadcast up to BROADCAST_ROWS entries, else both sides are exchanged."""
    entries = side.agg(F.coalesce(weight, F.lit(0))).first()[0]
    return docs.join(F.broadcast(side) if entries <= BROADCAST_ROWS else side, "doc_id")


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row.

    Strings are judged on the input: all bytes of every string of `length` bytes that starts at two places, in one document or
    in two, go from both. Null text is empty. Equal texts are repeats of each other, so all their bytes go where they have
    `length` of them. doc_id is unique; a row repeated in full is a copy. Empty tables give an empty result. Other columns
    aren't read.
    """
    spans, copied = repeated_spans(docs, length, gram)
    side = spans.select("doc_id", "starts", "ends", F.lit(False).alias("copied")).unionByName(copied.select("doc_id", F.array().cast("array<long>").alias("starts"), F.array().cast("array<long>").alias("ends"), F.lit(True).alias("copied")))
    # a text that others have has spans of its own as well; these add nothing
    side = materialize(side.groupBy("doc_id").agg(F.max("copied").alias("copied"), F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    entries = side.agg(F.coalesce(F.sum(F.size("starts") + 1), F.lit(0))).first()[0]
    small = entries <= BROADCAST_ROWS
    joined = rows.join(F.broadcast(side) if small else side, "doc_id", "left")
    return arrow_map(joined.select("doc_id", "text", "copied", "starts", "ends"), _cut(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"))
