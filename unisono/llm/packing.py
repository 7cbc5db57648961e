"""Packing of examples into fixed token budgets by vector bin packing.

An example has a size in several dimensions (tokens, segments, loss-bearing tokens) and a sequence a capacity in each.
Within a task a bounded pool of waiting pieces is packed by the dot-product heuristic: an open sequence takes the
waiting piece whose size vector has the greatest dot product with what is left of its capacity. Where no piece fits and
cutting is allowed, the best piece is cut, so padding is left in the last sequence of a task only. Tasks pack what
they read, without an exchange.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import arrow_map, read_table

CAPACITY = 4096
MAX_SEGMENTS = 256
POOL = 512
END_ID = 2
VOCABULARY = "word_bpe_49k.json"


class _Memo(dict):
    """Results of a function; emptied when it has `limit` of them."""

    def __init__(self, make: Callable[[str], bytes], limit: int) -> None:
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        out = self[key] = self.make(key)
        return out


class WordTokenizer:
    """Ids of the word-level BPE vocabulary, the same as the library's own encode(text, add_special_tokens=False).

    This vocabulary never merges across the pieces of its splitting pattern, so ids of a piece are remembered. Texts with
    characters for which Python and the library might split differently go to the library whole.
    """

    #: Lower-case letters of Latin-1 besides a-z; ASCII control characters but tab, newline and return are left out.
    PLAIN = re.compile(r"[\t\n\r -~¡-©«-¬®-±´¶-¸»¿-ÿ]*")
    PIECES = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.model = self.full.model
        # the printable stand-ins of bytes that this kind of vocabulary uses (fixed values: 33-126, 161-172, 174-255 stand for themselves)
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(own)]
        self.stand_in = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
        pieces = _Memo(self._piece, 300_000)
        self.words = _Memo(lambda w: b"".join(map(pieces.__getitem__, self.PIECES.findall(w))), 600_000)

    def _piece(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else "".join(self.stand_in[b] for b in piece.encode())
        return np.array([t.id for t in self.model.tokenize(shown)], np.uint32).tobytes()

    def encode(self, text: str) -> np.ndarray:
        if "<|" in text or not self.PLAIN.fullmatch(text) or not (text.isascii() or unicodedata.is_normalized("NFC", text)):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.frombuffer(b"".join(map(self.words.__getitem__, text.lower().split())), np.uint32)


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


@dataclass
class Piece:
    """Tokens [start, start + tokens) of an example, of which `loss` bear loss."""

    key: int
    start: int
    tokens: int
    loss: int
    ids: np.ndarray | None = None
    bears: np.ndarray | None = None

    def cut(self, n: int) -> tuple[Piece, Piece]:
        cut_loss = self.loss * n // self.tokens if self.bears is None else int(self.bears[:n].sum())
        ids, bears = self.ids, self.bears
        a = Piece(self.key, self.start, n, cut_loss, None if ids is None else ids[:n], None if bears is None else bears[:n])
        b = Piece(self.key, self.start + n, self.tokens - n, self.loss - cut_loss, None if ids is None else ids[n:], None if bears is None else bears[n:])
        return a, b


class Packer:
    """Closes one sequence after another from a pool of at most `pool` waiting pieces."""

    def __init__(self, capacity: int, max_segments: int, max_loss: int, cut: bool, pool: int = POOL) -> None:
        self.limits = np.array([capacity, max_segments, max_loss], np.float64)
        self.cut, self.pool = cut, pool
        self.waiting: list[Piece] = []

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        if not self.cut and (piece.tokens > self.limits[0] or piece.loss > self.limits[2]):
            raise ValueError(f"example {piece.key} exceeds a sequence and may not be cut")
        while self.cut and (piece.tokens >= self.limits[0] or piece.loss > self.limits[2]):
            n = self._most(piece, self.limits)
            if n == piece.tokens:
                break
            head, piece = piece.cut(n)
            yield [head]
        if piece.tokens:
            self.waiting.append(piece)
        if len(self.waiting) >= self.pool:
            yield self._close()

    def flush(self) -> Iterator[list[Piece]]:
        while self.waiting:
            yield self._close()

    def _most(self, piece: Piece, left: np.ndarray) -> int:
        """The longest head of a piece that fits."""
        if left[1] < 1:
            return 0
        n = int(min(piece.tokens, left[0]))
        if piece.bears is not None and piece.loss > left[2]:
            n = min(n, int(np.searchsorted(np.cumsum(piece.bears), left[2], side="right")))
        elif piece.loss > left[2]:
            n = min(n, int(left[2] * piece.tokens // piece.loss))
        return n

    def _close(self) -> list[Piece]:
        sizes = np.array([[p.tokens, 1, p.loss] for p in self.waiting], np.float64)
        share = sizes / self.limits
        free = np.ones(len(sizes), bool)
        left = self.limits.copy()
        out: list[Piece] = []
        while True:
            fits = free & (sizes <= left).all(axis=1)
            if not fits.any():
                break
            gain = np.where(fits, share @ (left / self.limits), -1)
            best = int(gain.argmax())  # ties: the piece that has waited longest
            out.append(self.waiting[best])
            free[best] = False
            left -= sizes[best]
        rest: list[Piece] = [p for p, f in zip(self.waiting, free, strict=True) if f]
        if self.cut and rest and left[0] >= 1:
            i = max(range(len(rest)), key=lambda j: (self._most(rest[j], left), -j))
            n = self._most(rest[i], left)
            if 0 < n < rest[i].tokens:
                head, rest[i] = rest[i].cut(n)
                out.append(head)
        self.waiting = rest
        return out


def pack(pieces: Iterator[Piece], packer: Packer) -> Iterator[list[Piece]]:
    for p in pieces:
        yield from packer.add(p)
    yield from packer.flush()


_OUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long, sequence_id long, offset long, segment int"


def _pack_texts(path: str, capacity: int, max_segments: int, max_loss: int, end_id: int, loss_of: Callable | None):
    def run(batches):
        from pyspark import TaskContext

        base, made = TaskContext.get().partitionId() << 33, 0
        tok, packer = tokenizer(path), Packer(capacity, max_segments, max_loss, cut=True)

        def table(sequences: list[list[Piece]]):
            nonlocal made
            cols: dict[str, list] = {k.split()[0]: [] for k in _OUT.split(", ")}
            for seq in sequences:
                offset = 0
                for k, p in enumerate(seq):
                    total = int(p.key[1])
                    values = (p.key[0], p.start, p.tokens, zlib.crc32(np.ascontiguousarray(p.ids, "<u4")), total, p.loss, base | made, offset, k)
                    for c, v in zip(cols.values(), values, strict=True):
                        c.append(v)
                    offset += p.tokens
                made += 1
            return pa.RecordBatch.from_pydict({k: pa.array(v, pa.int32() if k == "segment" else pa.int64()) for k, v in cols.items()})

        end = np.array([end_id], np.uint32)
        for batch in batches:
            done: list[list[Piece]] = []
            for i, text in zip(batch.column("doc_id").to_pylist(), (x.as_py() for x in batch.column("text")), strict=True):
                ids = np.concatenate([tok.encode(text or ""), end])
                bears = loss_of(text, ids) if loss_of else None
                done += packer.add(Piece((i, len(ids)), 0, len(ids), len(ids) if bears is None else int(bears.sum()), ids, bears))
            if done:
                yield table(done)
        if last := list(packer.flush()):
            yield table(last)

    return run


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, max_segments: int = MAX_SEGMENTS, max_loss: int = CAPACITY, end_id: int = END_ID, loss_of: Callable | None = None
) -> DataFrame:
    """Sequences of at most `capacity` tokens, `max_segments` pieces and `max_loss` loss-bearing tokens; one row a piece.

    Null and empty texts are one end token. Longer examples are cut. `loss_of(text, ids)` may mark the tokens that bear
    loss (boolean array); without it all do. Every token lies in exactly one piece. Repeated rows are packed each. Other
    columns aren't read. A sequence's number is unique (task number times 2^33 plus a count).
    """
    fn = _pack_texts(tokenizer_path, capacity, max_segments, max_loss, end_id, loss_of)
    return arrow_map(docs.select("doc_id", "text"), fn, _OUT)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), vocabulary_path())
