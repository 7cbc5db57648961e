"""Repair of conversation structure by cost layers.

A conversation must spell `(s?(ua)+)?` by the initials of its roles. Turns may be kept, given another role, deleted or
inserted, each at a cost. For every turn the layers say which states of the grammar can complete the rest at cost 0, 1,
2, ...: a layer is a bitset of the four states, and all layers of a turn lie side by side in one word, so that an edit
is a shift (by its cost) of the states before it (by masks). The first layer that holds the start gives the cost, and the
bits lead through the least audit among the cheapest.

The states of a turn are completed at costs that differ by 7 at most (`a` in the place of `u` costs an insert, and so on), so
16 layers above the first are enough however long the conversation is.

Conversations are dealt out whole as long as they are of bounded size. Longer ones are cut into chunks: equal rows become one
with a count, a chunk is a table of costs between states, tables are chained over the chunks, and each chunk traces its own
audit. Only the chain of chunks, the audit of a conversation (one value by contract) and its digest, which has no parallel form,
pass through one task, as streams.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain, groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, materialize, read_table

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1
LONG_ROWS, LONG_BYTES = 4096, 8 << 20  # of a conversation; beyond either it is cut into chunks
CHUNK = 4096  # rows of a chunk, a power of two
SEGMENT_BYTES = 4 << 20  # of text in one segment of a long conversation
ACCEPT = 0b1001  # states are bits: 0 start, 1 after s, 2 after u, 3 after a
FINE, TRUNCATED, BLANK, DUPLICATE = 0, 1, 2, 3
_ONES, _WORD = 0x1111111111111111, (1 << 64) - 1
_STEP = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_NEXT = {0: 2, 1: 2, 2: 3, 3: 2}  # by the one of u and a that fits
_ROLE = {2: "user", 3: "assistant"}
_LEGAL = {"su", "ua", "au"}
_BLANKS = " \t\n\x0b\x0c\r"

Row = tuple[str, int, int]  # initial, fault, further copies, which are deleted
Layers = tuple[int, int]  # cost of the lowest layer, four bits for each layer from there on


# ---- layers ----


def _before_u(x: int) -> int:
    m = x >> 2 & _ONES
    return m | m << 1 | m << 3


def _before_a(x: int) -> int:
    return (x >> 3 & _ONES) << 2


def _before_s(x: int) -> int:
    return x >> 1 & _ONES


_BEFORE = {"u": _before_u, "a": _before_a, "s": _before_s}


def _settle(base: int, x: int) -> Layers:
    """With up to two inserts in front, from the lowest layer that has a state."""
    for _ in range(2):
        x |= (_before_u(x) | _before_a(x)) << 4 * INSERT
    x &= _WORD
    empty = ((x & -x).bit_length() - 1) // 4
    return base + empty, x >> 4 * empty


def end_layers(costs: Iterable[int | None]) -> Layers:
    """Layers from what each state costs to complete."""
    costs = list(costs)
    base = min(c for c in costs if c is not None)
    x = 0
    for q, c in enumerate(costs):
        if c is not None:
            x |= 1 << 4 * (c - base) + q
    return _settle(base, x)


def all_layers(rows: list[Row], end: Layers) -> list[Layers]:
    """The layers before each row, and at last those at the end."""
    out = [end]
    base, x = end
    for initial, fault, extra in reversed(rows):
        base += DELETE * extra
        y = x << 4 * DELETE
        if fault < BLANK:
            more = CUT_OFF if fault == TRUNCATED else 0
            if initial in _BEFORE:
                y |= _BEFORE[initial](x) << 4 * (KEEP + more)
            y |= (_before_u(x) | _before_a(x)) << 4 * (REROLE + more)
        base, x = _settle(base, y)
        out.append((base, x))
    return out[::-1]


def cost_of(at: Layers, q: int) -> int | None:
    base, x = at
    for c in range(16):
        if x >> 4 * c + q & 1:
            return base + c
    return None


def _holds(at: Layers, q: int | None, cost: int) -> bool:
    return q is not None and 0 <= cost - at[0] < 16 and bool(at[1] >> 4 * (cost - at[0]) + q & 1)


def trace(rows: list[Row], layers: list[Layers], q: int, last: bool) -> tuple[str, int]:
    """The least audit among the cheapest from state q, and the state it ends in; of the letters that are possible, the
    first in ASCII order leads. Inserts after the final row belong to the last chunk."""
    cost = cost_of(layers[0], q)
    out = []
    for i, (initial, fault, extra) in enumerate(rows):
        here, after = layers[i], (layers[i + 1][0] + DELETE * extra, layers[i + 1][1])
        more = CUT_OFF if fault == TRUNCATED else 0
        while not _holds(after, q, cost - DELETE) and _holds(here, _NEXT[q], cost - INSERT):
            out.append("I")
            q, cost = _NEXT[q], cost - INSERT
        if _holds(after, q, cost - DELETE):
            out.append("D")
            cost -= DELETE
        elif _holds(after, _STEP.get(initial, {}).get(q), cost - KEEP - more):
            out.append("K")
            q, cost = _STEP[initial][q], cost - KEEP - more
        else:
            out.append("R")
            q, cost = _NEXT[q], cost - REROLE - more
        out.append("D" * extra)
        cost -= DELETE * extra
    while last and cost > 0:
        out.append("I")
        q, cost = _NEXT[q], cost - INSERT
    return "".join(out), q


def apply_audit(audit: str, rows: Iterable[tuple[str, str, int]], q: int) -> Iterator[tuple[str, str]]:
    """Role and text of the turns that an audit leaves of (role, text, further copies), from state q on."""
    letters = iter(audit)
    for role, text, extra in rows:
        for letter in letters:
            if letter == "I":
                q = _NEXT[q]
                yield _ROLE[q], ""
                continue
            if letter == "K":
                q = _STEP[role[:1]][q]
                yield role, text
            elif letter == "R":
                q = _NEXT[q]
                yield _ROLE[q], text
            break
        for _ in range(extra):
            next(letters)
    for _ in letters:
        q = _NEXT[q]
        yield _ROLE[q], ""


# ---- rows ----


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies of rows damaged by crc32(`conv_id:turn`) % 20: 0 drops the row (no copy), 1 empties
    the text, 2 removes its `[.!?]`, 3 gives it twice, 4 sets role user. Null values are one space."""
    kind = F.crc32(F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c != ":" else F.lit(":") for c in ("conv_id", ":", "turn"))).cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("_kind")).select(
        "conv_id",
        "turn",
        F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("_kind") == 0, 0).when(F.col("_kind") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _fault() -> Column:
    """BLANK, TRUNCATED or FINE by the text alone."""
    body = F.rtrim("text", F.lit(_BLANKS))
    return F.when(body == "", BLANK).when(~F.substring(body, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(FINE)


_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]
_SUMMARY = ["conv_id", *_COUNTS, "cost", "audit"]
_TURNS = "array<struct<role:string,text:string>>"
_KINDS = {"string": pa.string(), "long": pa.int64(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()), _TURNS: pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))}
_TEXT = {"conv_id": "string", "audit": "string", "initial": "string", "first": "string", "last": "string", "after": "array<long>", "costs": "array<long>", "states": "array<long>", "audits": "array<string>", "turns": _TURNS}


def _schema(names: list[str]) -> str:
    return ", ".join(f"{n} {_TEXT.get(n, 'long')}" for n in names)


def _batched(rows: Iterator[dict], names: list[str], most: int = 200) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of bounded length and size of text."""
    held, size = [], 0

    def put():
        return pa.RecordBatch.from_pydict({n: pa.array([r[n] for r in held], _KINDS[_TEXT.get(n, "long")]) for n in names})

    for r in rows:
        held.append(r)
        size += sum(len(t["text"]) for t in r.get("turns", ()))
        if len(held) >= most or size >= SEGMENT_BYTES:
            yield put()
            held, size = [], 0
    if held:
        yield put()


class Repaired(NamedTuple):
    """`conversations`: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. `turns`: conv_id, chunk and segment
    (ascending), turns array<struct<role, text>>. A conversation of up to LONG_ROWS rows and LONG_BYTES has one segment, in
    chunk -1; others have as many as they need."""

    conversations: DataFrame
    turns: DataFrame


class _Facts:
    """Counts over rows in order, and over pieces that follow each other."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns_seen = 0
        self.first = self.last = None  # initials
        self.low = self.high = None  # turns

    def add(self, turn: int | None, initial: str, fault: int, extra: int) -> None:
        self.blank += (fault == BLANK) * (1 + extra)
        self.duplicate += (fault == DUPLICATE) + extra * (fault != BLANK)
        self.truncated += fault == TRUNCATED
        self.illegal += (self.last is not None and self.last + initial not in _LEGAL) + extra
        self.first = initial if self.first is None else self.first
        self.last = initial
        if turn is not None and turn != self.high:
            self.turns_seen += 1
            self.low = turn if self.low is None else self.low
            self.high = turn

    def counts(self) -> dict[str, int]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns_seen
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal}


_READ = ["conv_id", "turn", "role", "text", "copies", "fault"]


def _whole(batches):
    """Conversations of bounded size, sorted: one row each."""

    def rows():
        for b in batches:
            yield from zip(*(b.column(c).to_pylist() for c in _READ), strict=True)

    def repaired(conv, group):
        facts, plan, texts, seen = _Facts(), [], [], set()
        for _, turn, role, text, copies, fault in group:
            if not copies:
                continue
            if fault != BLANK and (role, text) in seen:
                fault = DUPLICATE
            seen.add((role, text))
            facts.add(turn, role[:1], fault, copies - 1)
            plan.append((role[:1], fault, copies - 1))
            texts.append((role, text, copies - 1))
        layers = all_layers(plan, end_layers([0, None, None, 0]))
        audit, _ = trace(plan, layers, 0, True)
        turns = [{"role": r, "text": t} for r, t in apply_audit(audit, texts, 0)]
        return {"conv_id": conv, **facts.counts(), "cost": cost_of(layers[0], 0), "audit": audit, "turns": turns}

    yield from _batched((repaired(conv, group) for conv, group in groupby(rows(), key=lambda r: r[0])), [*_SUMMARY, "turns"])


# ---- long conversations ----


def _places(batches):
    """A place for each row: the partition above, its number there below; chunks are runs of places."""
    from pyspark import TaskContext

    at = TaskContext.get().partitionId() << 36
    for b in batches:
        yield b.append_column("place", pa.array(range(at, at + b.num_rows), pa.int64()))
        at += b.num_rows


def _chunks(batches, names):
    """(conv_id, chunk), rows of a chunk."""

    def rows():
        for b in batches:
            yield from zip(*(b.column(c).to_pylist() for c in names), strict=True)

    return groupby(rows(), key=lambda r: r[:2])


_CHUNK_FACTS = ["conv_id", "chunk", "costs", "blank", "duplicate", "truncated", "illegal", "turns_seen", "low", "high", "first", "last"]
_CHAIN = ["conv_id", "chunk", "after", *_COUNTS, "cost"]
_AUDITS = ["conv_id", "chunk", "audits", "states"]
_PICKED = ["conv_id", "chunk", "state", "audit"]


def _dicts(batches) -> Iterator[dict]:
    for b in batches:
        yield from b.to_pylist()


def _chunk_costs(batches):
    """For each chunk its counts, and what it costs to come from state q to state e (at 4 e + q)."""

    def table(conv, chunk, group):
        facts, plan = _Facts(), []
        for _, _, turn, initial, fault, extra in group:
            facts.add(turn, initial, fault, extra)
            plan.append((initial, fault, extra))
        starts = [all_layers(plan, end_layers([0 if q == e else None for q in range(4)]))[0] for e in range(4)]
        return {"conv_id": conv, "chunk": chunk, "costs": [cost_of(s, q) for s in starts for q in range(4)]} | vars(facts)

    groups = _chunks(batches, ["conv_id", "chunk", "turn", "initial", "fault", "extra"])
    yield from _batched((table(conv, chunk, group) for (conv, chunk), group in groups), _CHUNK_FACTS)


def _chain(batches):
    """Chunk tables sorted by conversation, the last first: what each state costs after each chunk, and a row without chunk
    that has the counts of the conversation."""

    def rows():
        for conv, group in groupby(_dicts(batches), key=lambda r: r["conv_id"]):
            after = later = low = high = None
            total = dict.fromkeys(["blank", "duplicate", "truncated", "illegal", "turns_seen"], 0)
            for r in group:
                yield dict.fromkeys(_CHAIN) | {"conv_id": conv, "chunk": r["chunk"], "after": after}
                for k in total:
                    total[k] += r[k]
                if later is not None:
                    total["illegal"] += r["last"] + later["first"] not in _LEGAL
                    total["turns_seen"] -= r["high"] is not None and r["high"] == later["low"]
                low = low if r["low"] is None else r["low"]
                high = r["high"] if high is None else high
                later = r
                end = end_layers(after or [0, None, None, 0])
                ends = [cost_of(end, e) for e in range(4)]
                ways = [[r["costs"][4 * e + q] + ends[e] for e in range(4) if r["costs"][4 * e + q] is not None and ends[e] is not None] for q in range(4)]
                after = [min(w, default=None) for w in ways]
            gaps = 0 if low is None else high - low + 1 - total["turns_seen"]
            yield dict.fromkeys(_CHAIN) | total | {"conv_id": conv, "gaps": gaps, "cost": after[0]}

    yield from _batched(rows(), _CHAIN)


def _chunk_audits(batches):
    """For each chunk and each state before it the least audit and the state after it."""

    def made(conv, chunk, group):
        plan, after = [], None
        for _, _, initial, fault, extra, after in group:  # noqa: B007
            plan.append((initial, fault, extra))
        layers = all_layers(plan, end_layers(after or [0, None, None, 0]))
        ways = [trace(plan, layers, q, after is None) if cost_of(layers[0], q) is not None else (None, None) for q in range(4)]
        return {"conv_id": conv, "chunk": chunk, "audits": [a for a, _ in ways], "states": [q for _, q in ways]}

    groups = _chunks(batches, ["conv_id", "chunk", "initial", "fault", "extra", "after"])
    yield from _batched((made(conv, chunk, group) for (conv, chunk), group in groups), _AUDITS)


def _pick(batches):
    """Chunks in order: the state before each and its audit; a row without chunk has the audit of the conversation."""

    def rows():
        for conv, group in groupby(_dicts(batches), key=lambda r: r["conv_id"]):
            q, whole = 0, []
            for r in group:
                yield {"conv_id": conv, "chunk": r["chunk"], "state": q, "audit": r["audits"][q]}
                whole.append(r["audits"][q])
                q = r["states"][q]
            yield {"conv_id": conv, "chunk": None, "state": None, "audit": "".join(whole)}

    yield from _batched(rows(), _PICKED)


def _segments(batches):
    """Rows of chunks in order with their audit, as segments of bounded size."""

    def rows():
        for (conv, chunk), group in _chunks(batches, ["conv_id", "chunk", "role", "text", "extra", "state", "audit"]):
            first = next(group)
            held, size, made = [], 0, 0
            for role, text in apply_audit(first[6], chain([first[2:5]], (r[2:5] for r in group)), first[5]):
                held.append({"role": role, "text": text})
                size += len(text)
                if size >= SEGMENT_BYTES:
                    yield {"conv_id": conv, "chunk": chunk, "segment": made, "turns": held}
                    held, size, made = [], 0, made + 1
            if held:
                yield {"conv_id": conv, "chunk": chunk, "segment": made, "turns": held}

    yield from _batched(rows(), _SEGMENT)


_SEGMENT = ["conv_id", "chunk", "segment", "turns"]


def _long(rows: DataFrame) -> Repaired:
    """Conversations of any length. `rows` has conv_id (as a key), turn, role, text, copies."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    met = rows.where("copies > 0").groupBy("conv_id", "turn", "role", "text").agg((F.sum("copies") - 1).alias("extra"))
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    faults = met.select("conv_id", "turn", "role", "text", "extra", _fault().alias("fault"), digest.alias("digest"))
    kinds = "conv_id string, turn long, role string, text string, extra long, fault int, digest string, place long"
    placed = materialize(arrow_map(faults.repartitionByRange(parts, *order).sortWithinPartitions(*order), _places, kinds))
    placed = placed.withColumn("chunk", F.shiftright("place", (CHUNK - 1).bit_length()))
    first = placed.groupBy("conv_id", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    fault = F.when((F.col("fault") < BLANK) & F.col("first").isNull(), DUPLICATE).otherwise(F.col("fault"))
    narrow = materialize(placed.join(first, "place", "left").select("conv_id", "chunk", "place", "turn", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"), "extra"))

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(parts, "conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "place")

    tables = arrow_map(dealt(narrow), _chunk_costs, _schema(_CHUNK_FACTS))
    links = materialize(arrow_map(tables.repartition(parts, "conv_id").sortWithinPartitions("conv_id", F.col("chunk").desc()), _chain, _schema(_CHAIN)))
    ends = links.where("chunk is not null").select("conv_id", "chunk", "after")
    audits = arrow_map(dealt(narrow.join(ends, ["conv_id", "chunk"])), _chunk_audits, _schema(_AUDITS))
    picked = materialize(arrow_map(audits.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "chunk"), _pick, _schema(_PICKED)))
    summary = links.where("chunk is null").select("conv_id", *_COUNTS, "cost").join(picked.where("chunk is null").select("conv_id", "audit"), "conv_id")
    told = placed.select("conv_id", "chunk", "place", "role", "text", "extra").join(picked.where("chunk is not null"), ["conv_id", "chunk"])
    return Repaired(summary, arrow_map(dealt(told), _segments, _schema(_SEGMENT)))


def repair(rows: DataFrame) -> Repaired:
    """The cheapest repair of every conversation of `rows` (conv_id, turn, role, text, copies); conv_id comes back as text.

    Turns follow each other by turn (nulls first), then by role and text; `copies` says how often a row stands there (0: it is
    gone, which leaves its conversation). First fault of a row: blank (no `[^\\x20\\x09-\\x0D]`), duplicate (role and text seen
    earlier), truncated (last such character not `[.!?]`). Blank and duplicate rows are deleted (3); others are kept (0), given the
    role that fits (2) or deleted, and one more if truncated and not deleted; empty turns of user or assistant may be inserted (2).
    Of the cheapest audits the ASCII-least is taken. Role and text must not be null; a null conv_id is a
    conversation of its own (null again), rows without turn come first and count for no gap, a role of any other kind (or none)
    can't be kept. A conversation without rows has zeros and an empty audit; an empty table gives an empty result. Other
    columns aren't read, texts may be of any length.
    """
    spark = rows.sparkSession
    key = F.when(F.col("conv_id").isNotNull(), F.concat(F.lit("="), F.col("conv_id").cast("string"))).otherwise("")
    keyed = rows.select(key.alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text", "copies")
    size = keyed.groupBy("conv_id").agg(F.sum("copies").alias("n"), F.sum(F.col("copies") * F.octet_length("text")).alias("size"))
    long = materialize(size.where(f"n > {LONG_ROWS} or size > {LONG_BYTES}").select("conv_id"))
    n_long = long.count()
    few = F.broadcast(long) if n_long <= 100_000 else long
    short = keyed.join(few, "conv_id", "left_anti") if n_long else keyed
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = short.withColumn("fault", _fault()).repartition(parts, "conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    made = materialize(arrow_map(ordered, _whole, _schema([*_SUMMARY, "turns"])))
    out = Repaired(made.drop("turns"), made.select("conv_id", F.lit(-1).cast("long").alias("chunk"), F.lit(0).cast("long").alias("segment"), "turns"))
    if n_long:
        out = Repaired(*(a.unionByName(b) for a, b in zip(out, _long(keyed.join(few, "conv_id", "left_semi")), strict=True)))
    told = F.when(F.col("conv_id") != "", F.substr("conv_id", F.lit(2))).cast(rows.schema["conv_id"].dataType)
    return Repaired(*(x.withColumn("conv_id", told) for x in out))


def _hash_stream(batches):
    """Segments sorted by conversation: the digest of its turns."""
    for conv, group in groupby(_dicts(batches), key=lambda r: r["conv_id"]):
        h, begun = hashlib.sha256(), False
        for r in group:
            for t in r["turns"]:
                h.update(b"\n" * begun + f"{t['role']}:{t['text']}".encode())
                begun = True
        yield pa.RecordBatch.from_pydict({"conv_id": pa.array([conv], pa.string()), "repaired_sha256": pa.array([h.hexdigest()])})


def digests(turns: DataFrame) -> DataFrame:
    """conv_id (as text) and SHA-256 of `role:text`, newline-joined. Segments of a long conversation pass as a stream, so none is held
    whole; a conversation without segments has no row."""
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    turns = turns.withColumn("conv_id", F.col("conv_id").cast("string"))
    whole = turns.where("chunk < 0").select("conv_id", F.sha2(lines, 256).alias("repaired_sha256"))
    pieces = turns.where("chunk >= 0").repartition(parts, "conv_id").sortWithinPartitions("conv_id", "chunk", "segment")
    return whole.unionByName(arrow_map(pieces, _hash_stream, "conv_id string, repaired_sha256 string"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = repair(damage(read_table(spark, sf_dir, "conversations")))
    hashed = digests(done.turns).withColumnRenamed("conv_id", "_conv")
    joined = done.conversations.join(hashed, F.col("conv_id").cast("string").eqNullSafe(F.col("_conv")), "left")
    return joined.select("conv_id", *_COUNTS, "cost", "audit", F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


# ---- SQL ----


def _sql_cost(x: str, more: str, letter: str) -> str:
    """A way, nine digits of cost and then the audit, made longer by an edit; ways compare by cost and then by audit."""
    return f"lpad((cast(substr({x}, 1, 9) as bigint) + {more})::varchar, 9, '0') || substr({x}, 10) || '{letter}'"


def _sql_step(values: dict[int, str]) -> dict[int, str]:
    """The states with one insert more."""
    out = dict(values)
    out[3] = f"least({values[3]}, {_sql_cost(values[2], '2', 'I')})"
    out[2] = f"least({values[2]}, {_sql_cost(values[0], '2', 'I')}, {_sql_cost(values[1], '2', 'I')}, {_sql_cost(values[3], '2', 'I')})"
    return out


def _sql() -> str:
    old = {q: f"w.s{q}" for q in range(4)}
    t = "(r.fault = 1)::int"

    def kept(x: str, initial: str) -> str:
        return f"case when r.fault < 2 and r.initial = '{initial}' then {_sql_cost(x, t, 'K')} end"

    def turned(x: str) -> str:
        return f"case when r.fault < 2 then {_sql_cost(x, f'2 + {t}', 'R')} end"

    gone = {q: _sql_cost(old[q], "3", "D") for q in range(4)}
    new = {
        0: gone[0],
        1: f"least({gone[1]}, {kept(old[0], 's')})",
        2: f"least({gone[2]}, {', '.join(f(old[q]) for q in (0, 1, 3) for f in (lambda x: kept(x, 'u'), turned))})",
        3: f"least({gone[3]}, {kept(old[2], 'a')}, {turned(old[2])})",
    }
    first = "select conv, k, " + ", ".join(f"{v} as s{q}" for q, v in _sql_step({q: f"s{q}" for q in range(4)}).items())
    return f"""
with recursive o as (
  select coalesce(conv_id::varchar, '') as conv, conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), '') as key
  from conversations
), c as (
  select *, xor(4294967295, list_reduce(list_concat([4294967295::bigint], flatten(list_transform(key, lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, 3988292384 * (a & 1)) end)) % 20 as kind
  from o
), d as (
  select conv, turn, case when kind = 4 then 'user' else role end as role,
    case when kind = 1 then '' when kind = 2 then translate(text, '.!?', '') else text end as text, unnest(range(case when kind = 3 then 2 else 1 end)) as copy
  from c where kind <> 0
), n as (
  select *, row_number() over (partition by conv order by turn nulls first, role, text, copy) as k, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body from d
), r as (
  select conv, turn, role, text, k, role[1:1] as initial,
    case when body = '' then 2 when row_number() over (partition by conv, role, text order by k) > 1 then 3 when right(body, 1) not in ('.', '!', '?') then 1 else 0 end as fault
  from n
), w as (
  select conv, 0::bigint as k, '000000000' as s0, null::varchar as s1, '000000002I' as s2, '000000004II' as s3 from (select distinct conv from r)
  union all
  {first} from ({first} from (
    select w.conv, r.k, {', '.join(f'{v} as s{q}' for q, v in new.items())} from w join r on r.conv = w.conv and r.k = w.k + 1
  ))
), e as (
  select conv, least(arg_max(s0, k), arg_max(s3, k)) as best from (select conv, k, coalesce(s0, '9') as s0, coalesce(s3, '9') as s3 from w) group by conv
), b as (
  select conv, cast(substr(best, 1, 9) as bigint) as cost, substr(best, 10) as audit from e
), l as (
  select conv, i, audit[i:i] as letter, length(replace(audit, 'D', '')) % 2 as odd,
    length(replace(audit[1:i], 'I', '')) as k, length(replace(audit[1:i], 'D', '')) as place
  from (select *, unnest(range(1, length(audit) + 1)) as i from b)
), h as (
  select l.conv, sha256(string_agg(case when letter = 'K' then r.role when (place - odd) % 2 = 1 then 'user' else 'assistant' end || ':' || case when letter = 'I' then '' else r.text end, chr(10) order by l.i)) as digest
  from l left join r on r.conv = l.conv and r.k = l.k where letter <> 'D' group by l.conv
), p as (
  select conv, turn, fault, lag(initial) over (partition by conv order by k) || initial as pair from r
), f as (
  select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 2) as blank, count(*) filter (fault = 3) as duplicate,
    count(*) filter (fault = 1) as truncated, count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
  from p group by conv
)
select i.conv_id, coalesce(f.gaps, 0) as gaps, coalesce(f.blank, 0) as blank, coalesce(f.duplicate, 0) as duplicate, coalesce(f.truncated, 0) as truncated,
  coalesce(f.illegal, 0) as illegal, coalesce(b.cost, 0) as cost, coalesce(b.audit, '') as audit, coalesce(h.digest, sha256('')) as repaired_sha256
from (select distinct conv, conv_id from o) i left join f using (conv) left join b using (conv) left join h using (conv)
"""


ORACLE_SQL = _sql()
