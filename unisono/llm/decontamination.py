"""Benchmark decontamination.

The test items make up a BM25 inverted index with block maxima. Every passage of every training document is a query:
block-max WAND retrieves all items that score above a threshold, skipping blocks and passages that cannot reach it.
What is retrieved is verified on the words themselves: the item's question and answer, as shingles, must be in the document.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, mix64, prefix_hash, read_table, span_hash, word_spans

K1, B = 1.2, 0.75
THRESHOLD = 0.5  # of the item's score for itself
OVERLAP = 0.8
SHINGLE = 5
MIN_WORDS = 5  # shorter items are sought as a whole
BLOCK = 32  # postings in a block
COMMON = 0.3  # share of an item's score that may come from terms by which no passage is looked up
MAX_BLOCKS = 256
ITEMS_PER_INDEX = 20_000
_WORD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")  # scripts without spaces
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_STEP = np.uint64(0xD6E8FEB86659FD93)


def hashed_words(text: str) -> np.ndarray:
    """Hashes of a text's words: runs of letters and digits, lower-cased (ASCII punctuation separates); in scripts without spaces each character is a word."""
    if not text.isascii() and _UNSPACED.search(text):
        text = _UNSPACED.sub(r" \g<0> ", text)
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass").translate(_WORD), np.uint8)
    start, end = word_spans(data)
    return span_hash(prefix_hash(data), start, end)


def runs(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words, in order."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    acc = np.full(n, np.uint64(size), np.uint64)
    for k in range(size):
        acc = mix64(acc * _STEP + words[k : k + n])
    return acc


def _windows(half: np.ndarray, term: np.ndarray, size: int) -> np.ndarray:
    """Distinct window * size + term; a window is two halves, and each half belongs to the one that begins with it and to the one before."""
    half = half.astype(np.int64)
    return np.unique(np.concatenate([half * size + term, np.maximum(half - 1, 0) * size + term]))


def question_and_answer(text: str) -> tuple[str, str]:
    """An item's last line, or else its last sentence, is its answer; a single sentence is both."""
    lines = [x for x in text.split("\n") if x.strip()]
    if len(lines) < 2:
        lines = [x for x in _SENTENCE.split(text) if x.strip()]
    return (text, text) if len(lines) < 2 else (" ".join(lines[:-1]), lines[-1])


@dataclass
class Part:
    size: int
    shingles: np.ndarray

    @classmethod
    def of(cls, text: str) -> Part:
        w = hashed_words(text)
        size = min(SHINGLE, len(w))
        return cls(size, np.unique(runs(w, size)) if size else np.zeros(0, np.uint64))


class Index:
    """Postings by term: items in ascending order, impacts as shares of the item's own score, maxima by block of postings, by block of items and by term."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        kept = [(i, t, hashed_words(t)) for i, t in sorted(items)]
        whole: dict[int, list[tuple[int, int]]] = {}
        for i, _, w in kept:
            if 0 < len(w) < MIN_WORDS:
                whole.setdefault(len(w), []).append((int(runs(w, len(w))[0]), i))
        # by number of words: hashes of whole short items, ascending, and their ids
        self.short = {n: (np.array([h for h, _ in sorted(v)], np.uint64), [i for _, i in sorted(v)]) for n, v in whole.items()}
        kept = [x for x in kept if len(x[2]) >= MIN_WORDS]
        self.ids = [i for i, _, _ in kept]
        self.parts = [tuple(Part.of(p) for p in (t, *question_and_answer(t))) for _, t, _ in kept]
        self.longest = max((len(w) for _, _, w in kept), default=0)
        df: dict[int, int] = {}
        terms = []
        for _, _, w in kept:
            t, n = np.unique(w, return_counts=True)
            terms.append((t.tolist(), n.tolist()))
            for x in terms[-1][0]:
                df[x] = df.get(x, 0) + 1
        mean = sum(len(w) for _, _, w in kept) / max(1, len(kept))
        postings: dict[int, list[tuple[int, float]]] = {}
        for d, ((t, n), (_, _, w)) in enumerate(zip(terms, kept, strict=True)):
            norm = K1 * (1 - B + B * len(w) / mean)
            impact = [math.log(1 + (len(kept) - df[x] + 0.5) / (df[x] + 0.5)) * c * (K1 + 1) / (c + norm) for x, c in zip(t, n, strict=True)]
            own = sum(impact)
            for x, s in zip(t, impact, strict=True):
                postings.setdefault(x, []).append((d, s / own))
        self.vocabulary = np.array(sorted(postings), np.uint64)
        self.docs = [[d for d, _ in postings[x]] for x in self.vocabulary.tolist()]
        self.impacts = [[s for _, s in postings[x]] for x in self.vocabulary.tolist()]
        self.block_max = [[max(s[i : i + BLOCK]) for i in range(0, len(s), BLOCK)] for s in self.impacts]
        self.term_max = np.array([max(s) for s in self.impacts], np.float64)
        # essential terms: the others, taken from the most frequent, make up COMMON of any item's score at most
        share = np.zeros(len(kept))
        self.essential, common = np.ones(len(self.vocabulary), bool), share
        for t in sorted(range(len(self.vocabulary)), key=lambda t: (-len(self.docs[t]), t)):
            share[self.docs[t]] += self.impacts[t]
            if share[self.docs[t]].max() > COMMON:
                break
            self.essential[t] = False
            common = share.copy()
        # maxima of essential terms by block of items, and the most that common terms add to an item of the block
        self.blocks = min(MAX_BLOCKS, max(1, len(kept)))
        of = np.arange(len(kept)) * self.blocks // max(1, len(kept))
        self.slack = np.zeros(self.blocks)
        np.maximum.at(self.slack, of, common)
        self.start = np.zeros(len(self.vocabulary) + 1, np.int64)
        block, top = [], []
        for t in range(len(self.vocabulary)):
            if self.essential[t]:
                most: dict[int, float] = {}
                for d, x in zip(self.docs[t], self.impacts[t], strict=True):
                    most[int(of[d])] = max(x, most.get(int(of[d]), 0.0))
                block += most
                top += most.values()
            self.start[t + 1] = len(block)
        self.block_of, self.block_top = np.array(block, np.int64), np.array(top, np.float64)

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """All items whose impacts over distinct `terms` sum to `threshold` or more: block-max WAND without a heap, as the limit is fixed."""
        docs, impacts, blocks = self.docs, self.impacts, self.block_max
        threshold -= 1e-9
        cursors = sorted([docs[t][0], t, 0] for t in terms)  # current item, term, place in its list
        tops = self.term_max
        out = []
        while cursors:
            bound, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                bound += tops[c[1]]
                if bound >= threshold:
                    pivot = i
                    break
            if pivot < 0:
                break
            d = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == d:
                pivot += 1
            # the blocks that would hold d, and the first item after the shortest of them
            bound, after = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else len(self.ids)
            for c in cursors[: pivot + 1]:
                row, b = docs[c[1]], c[2] // BLOCK
                while b < len(blocks[c[1]]) and row[min(len(row), (b + 1) * BLOCK) - 1] < d:
                    b += 1
                if b < len(blocks[c[1]]):
                    bound += blocks[c[1]][b]
                    after = min(after, row[min(len(row), (b + 1) * BLOCK) - 1] + 1)
            if bound < threshold:
                target = max(after, d + 1)
            else:
                score = 0.0
                for c in cursors[: pivot + 1]:
                    row, at = docs[c[1]], c[2]
                    while at < len(row) and row[at] < d:
                        at += 1
                    if at < len(row) and row[at] == d:
                        score += impacts[c[1]][at]
                if score >= threshold:
                    out.append((d, score))
                target = d + 1
            moved = []
            for c in cursors[: pivot + 1]:
                row, at = docs[c[1]], c[2]
                while at < len(row) and row[at] < target:
                    at += BLOCK if at + BLOCK < len(row) and row[at + BLOCK] < target else 1
                if at < len(row):
                    moved.append([row[at], c[1], at])
            cursors = sorted(moved + cursors[pivot + 1 :])
        return out

    def passages(self, words: np.ndarray, threshold: float) -> dict[int, float]:
        """Items that some passage of a document retrieves, with their best score.

        Passages are windows of twice the longest item's words, half of one apart, so an item's words lie in one together.
        """
        if not len(self.vocabulary) or not len(words):
            return {}
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        where = np.flatnonzero(self.vocabulary[at] == words)
        if not len(where):
            return {}
        half = max(32, self.longest)
        term = at[where]
        # a passage can reach the limit only where, in some block of items, the maxima of its essential terms bring what common terms leave open
        key = self.essential[term]
        pairs = _windows(where[key] // half, term[key], len(self.vocabulary))
        best: dict[int, float] = {}
        for w in self._open(pairs // len(self.vocabulary), pairs % len(self.vocabulary), threshold):
            lo, hi = np.searchsorted(where, [w * half, (w + 2) * half])
            terms = np.unique(term[lo:hi])
            if self.term_max[terms].sum() < threshold - 1e-9:
                continue
            for d, s in self.search(terms.tolist(), threshold):
                if s > best.get(d, 0.0):
                    best[d] = s
        return best

    def _open(self, window: np.ndarray, term: np.ndarray, threshold: float) -> list[int]:
        out: list[int] = []
        cuts = np.flatnonzero(np.diff(window // 2048)) + 1  # bounds the table of sums
        for w, t in zip(np.split(window, cuts), np.split(term, cuts), strict=True):
            if not len(w):
                continue
            n = self.start[t + 1] - self.start[t]
            at = np.repeat(self.start[t] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            low = w[0]
            sums = np.bincount(np.repeat(w - low, n) * self.blocks + self.block_of[at], self.block_top[at], minlength=int(w[-1] - low + 1) * self.blocks)
            out += (np.flatnonzero((sums.reshape(-1, self.blocks) + self.slack >= threshold - 1e-9).any(axis=1)) + low).tolist()
        return out

    def leaks(self, text: str | None, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> list[tuple[int, float, float, float, float]]:
        """(item_id, score, overlap, question_overlap, answer_overlap) of the items that a text holds."""
        if not text:
            return []
        words = hashed_words(text)
        found = self.passages(words, threshold)
        sorted_runs: dict[int, np.ndarray] = {}

        def share(p: Part) -> float:
            if p.size not in sorted_runs:
                sorted_runs[p.size] = np.sort(runs(words, p.size))
            have = sorted_runs[p.size]
            if not len(have) or not len(p.shingles):
                return 0.0
            at = np.minimum(np.searchsorted(have, p.shingles), len(have) - 1)
            return float((have[at] == p.shingles).mean())

        out = []
        for d in sorted(found):
            whole, q, a = (share(p) for p in self.parts[d])
            if whole >= overlap or (q >= overlap and a >= overlap):
                out.append((self.ids[d], found[d], whole, q, a))
        for n, (hashes, ids) in self.short.items():
            out += [(ids[k], 1.0, 1.0, 1.0, 1.0) for k in np.flatnonzero(np.isin(hashes, runs(words, n)))]
        return out


def indexes(items: DataFrame, key: str = "item_id", text: str = "text", per_index: int = ITEMS_PER_INDEX):
    """One index for each `per_index` items or so; what the driver holds and sends at once is bounded by that."""
    items = items.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).cast("long").alias("_k"), F.col(text).alias("_t"))
    n = max(1, -(-items.count() // per_index))
    for i in range(n):
        yield Index([tuple(r) for r in items.where(F.pmod(F.xxhash64("_k"), F.lit(n)) == i).collect()])


_OUT = "doc_id long, item_id long, score double, overlap double, question_overlap double, answer_overlap double"


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """A row for each document and test item that it holds.

    An item is held when `overlap` of its shingles of five words are in the document, or `overlap` of its question's and
    of its answer's. One of fewer than five words is held when all its words are there in a row. In scripts without
    spaces each character is a word. Null and empty texts hold none; items without words, or null ones, aren't sought.
    Repeated rows and items give repeated rows. Empty tables give an empty result. Only doc_id and text are read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    out = None
    for index in indexes(items):

        def run(batches, index=index):
            for b in batches:
                rows = [(i, *x) for i, t in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True) for x in index.leaks(t.as_py(), threshold, overlap)]
                if rows:
                    kinds = [pa.int64(), pa.int64(), *[pa.float64()] * 4]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in _OUT.split(", ")])

        part = arrow_map(docs, run, _OUT)
        out = part if out is None else out.unionByName(part)
    return out


def drop_leaking(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """The rows of `docs` that hold no test item, with their columns as they are."""
    schema = docs.schema
    for index in indexes(items):

        def run(batches, index=index):
            for b in batches:
                yield b.filter(pa.array([not index.leaks(t.as_py(), threshold, overlap) for t in b.column("text")], pa.bool_()))

        docs = arrow_map(docs, run, schema)
    return docs


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
