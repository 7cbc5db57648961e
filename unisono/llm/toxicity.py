"""Toxicity by compression distance.

Two zstandard dictionaries are trained on text of either class. A document is cut into windows of some hundred bytes, each
is compressed with either dictionary, and the difference in length tells which text it resembles; windows that the toxic
dictionary serves better are measured again in short windows of a word or two, so that the difference isn't lost among
ordinary words. What a difference is worth, and what a document's differences are worth together, is calibrated on
labelled documents that the dictionaries in use have not seen (three folds); the final dictionaries read all.

Toxic wording is a small part of a toxic document. The toxic dictionary is therefore trained on those passages of toxic
documents, of any length, whose substrings stand in more different surroundings there than ordinary documents explain.
Counting surroundings, not documents, keeps copies of one toxic text from passing off the rest of it as toxic. Both
dictionaries end with the same ordinary part and have the same size, so that ordinary wording differs by next to nothing.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, crc_mod, mix64, read_table

WINDOW_BYTES, FINE_BYTES = 128, 12  # windows end at the first space from there on
MAX_TOXIC, MAX_ORDINARY = 1500, 6000  # labelled documents that training reads at most, whole
BASE_BYTES, OWN_BYTES = 24_576, 4_096
THRESHOLD = 0.7
GRAM = 8  # bytes of a substring that is counted
SURPRISE = 25.0  # least log-likelihood ratio of a toxic substring
FOLDS = 3
SHARES = (0.3, 0.1, 0.02, 0.002)  # of toxic windows in a toxic document
#: Known to both dictionaries: the coder looks for no match in the last bytes of its input.
PAD = b" " * 16
_SPREAD = 24  # differences beyond this count as this
_COUNTED = 4 << 20  # bytes counted at once
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TO_SPACE = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def plain(text: str | None) -> bytes:
    """Lower-cased words with one space before, between and after; ASCII signs and digits count as spaces."""
    return b" " + b" ".join((text or "").lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()) + b" "


def windows(data: bytes, size: int) -> list[bytes]:
    """Consecutive windows, each from a space to the first space `size` bytes on or later; longer ones than four times that are cut. Nothing is left out."""
    out, at, end = [], 0, len(data) - 1
    while at < end:
        stop = data.find(b" ", at + size)
        stop = min(end if stop < 0 else stop, at + 4 * size)
        out.append(data[at : stop + 1])
        at = stop
    return out


def _grams(data: bytes) -> np.ndarray:
    a = np.frombuffer(data, np.uint8)
    if len(a) < GRAM:
        return np.zeros(0, np.uint64)
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(a, GRAM)).view(np.uint64).ravel()


def _counts(docs: list[bytes], deal: int, of: int, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Substrings of one deal, and in how many different surroundings (as many bytes before and after) they stand."""
    found, around = [], []
    for d in docs:
        g = _grams(b" " * GRAM + d + b" " * GRAM)
        mid = g[GRAM:-GRAM]
        keep = np.ones(len(mid), bool) if of == 1 else mix64(mid) % np.uint64(of) == deal
        if only is not None and len(only):
            keep &= only[np.minimum(np.searchsorted(only, mid), len(only) - 1)] == mid
        at = np.flatnonzero(keep)
        names, first = np.unique(mid[at], return_index=True)  # once a document
        at = at[first]
        found.append(names)
        around.append(mix64(g[at] * _MIX + mix64(g[at + 2 * GRAM]) + names * np.uint64(3)))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    g, first = np.concatenate(found), np.unique(np.concatenate(around), return_index=True)[1]
    return np.unique(g[first], return_counts=True)


def marks(toxic: list[list[bytes]], ordinary: list[list[bytes]]) -> list[np.ndarray]:
    """For the documents outside each fold in turn, and for all, the sorted substrings that stand in toxic documents four times as often as ordinary ones explain, beyond chance."""
    of = max(1, math.ceil(sum(len(d) for f in toxic for d in f) / _COUNTED))
    out: list[list[np.ndarray]] = [[] for _ in range(len(toxic) + 1)]
    for deal in range(of):
        parts = [_counts(f, deal, of) for f in toxic]
        g, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        if not len(g):
            continue
        a = np.zeros((len(parts), len(g)))
        a[np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts]), place] = np.concatenate([p[1] for p in parts])
        often = a.sum(0) >= 3
        g, a = g[often], a[:, often]
        b = np.zeros_like(a)
        for k, f in enumerate(ordinary):
            h, n = _counts(f, deal, of, g)
            if len(g):
                b[k, np.searchsorted(g, h)] = n
        for k in range(len(parts) + 1):
            use = [i for i in range(len(parts)) if i != k]
            here, there = (sum(len(x[i]) for i in use) for x in (toxic, ordinary))
            if not here or not there:
                continue
            x, y = a[use].sum(0), b[use].sum(0)
            both = np.maximum(x + y, 1e-9) / (here + there)
            surprise = 2 * (x * np.log(np.maximum(x, 1e-9) / (both * here)) + y * np.log(np.maximum(y, 1e-9) / (both * there)))
            out[k].append(g[(x >= 3) & (x * there >= 4 * (y + 0.5) * here) & (surprise >= SURPRISE)])
    return [np.sort(np.concatenate(x)) if x else np.zeros(0, np.uint64) for x in out]


def passages(docs: list[bytes], marked: np.ndarray) -> list[bytes]:
    """The runs of bytes that marked substrings cover."""
    out = []
    if not len(marked):
        return out
    for d in docs:
        g = _grams(d)
        if not len(g):
            continue
        hit = np.flatnonzero(marked[np.minimum(np.searchsorted(marked, g), len(marked) - 1)] == g)
        if not len(hit):
            continue
        cut = np.flatnonzero(np.diff(hit) > GRAM)
        first, last = hit[np.append(0, cut + 1)], hit[np.append(cut, len(hit) - 1)]
        out += [d[i : j + GRAM] for i, j in zip(first.tolist(), last.tolist(), strict=True)]
    return out


def _dictionary(samples: Iterable[bytes], size: int) -> bytes:
    """Exactly `size` bytes trained on samples in a fixed mixed order; of too few samples, the samples themselves."""
    mixed = [w for _, w in sorted((hashlib.md5(b"%d " % i + w).digest(), w) for i, w in enumerate(samples))]
    try:
        data = zstandard.train_dictionary(size, mixed, k=24, d=8, level=3).as_bytes()
    except (zstandard.ZstdError, ValueError):
        data = b""
    if len(data) < size // 2:
        data = b"".join(dict.fromkeys(mixed)) or b" "
    return (data * (size // len(data) + 1))[-size:]


@dataclass
class ToxicityModel:
    base: bytes
    ordinary: bytes
    toxic: bytes
    gains: list[list[float]] = field(default_factory=lambda: [[0.0] * (2 * _SPREAD + 1)] * len(SHARES))
    weights: list[float] = field(default_factory=lambda: [0.0] * (2 + len(SHARES)))
    level: int = 3

    def __post_init__(self) -> None:
        self._pair = None

    def __getstate__(self):
        return self.__dict__ | {"_pair": None}

    def _compressors(self):
        made = []
        for own in (self.ordinary, self.toxic):
            # the common part comes last: of two equally good matches the coder takes the nearer one
            d = zstandard.ZstdCompressionDict(own + self.base, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            p = zstandard.ZstdCompressionParameters.from_level(self.level, source_size=1024, dict_size=len(d), min_match=4, write_content_size=0, write_checksum=0, write_dict_id=0)
            d.precompute_compress(compression_params=p)
            made.append(zstandard.ZstdCompressor(dict_data=d, compression_params=p).compress)
        return tuple(made)

    def distance(self, window: bytes) -> int:
        """Bytes that a window takes more with the ordinary than with the toxic dictionary."""
        if self._pair is None:
            self._pair = self._compressors()
        x = window + PAD
        return len(self._pair[0](x)) - len(self._pair[1](x))

    def distances(self, text: bytes) -> np.ndarray:
        """Differences of the distinct short windows in those windows that the toxic dictionary serves better."""
        out: dict[bytes, int] = {}
        for w in dict.fromkeys(windows(text, WINDOW_BYTES)):
            if self.distance(w) > 0:
                for v in windows(w, FINE_BYTES):
                    if v not in out:
                        out[v] = self.distance(v)
        return np.fromiter(out.values(), np.int64, len(out))

    def features(self, d: np.ndarray) -> np.ndarray:
        """For each assumed share of toxic windows, by how much the differences are likelier in a toxic document (log, 0 to 8); and whether they are at all."""
        at = np.clip(d, -_SPREAD, _SPREAD) + _SPREAD
        odds = [min(max(float(np.asarray(g)[at].sum()), 0.0), 8.0) for g in self.gains]
        return np.array([1.0, *odds, float(max(odds) > 0)])

    def score(self, text: str | None) -> tuple[float, int]:
        """Probability of label 1, and the number of short windows that were measured."""
        d = self.distances(plain(text))
        z = float(np.dot(self.weights, self.features(d)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), len(d)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 50) -> np.ndarray:
    """Newton's method; the ridge leaves the intercept alone."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _share(d: list[np.ndarray]) -> np.ndarray:
    """Smoothed share of each difference."""
    n = np.bincount(np.clip(np.concatenate([*d, np.zeros(1, np.int64)]), -_SPREAD, _SPREAD) + _SPREAD, minlength=2 * _SPREAD + 1) + 0.02
    return n / n.sum()


def _dictionaries(toxic: list[bytes], ordinary: list[bytes], marked: np.ndarray) -> ToxicityModel | None:
    """Without passages that set toxic documents apart, None."""
    own = passages(toxic, marked)
    if not own:
        return None
    usual = [w for d in ordinary[:MAX_TOXIC] for w in windows(d, 512)]  # of as many documents as the toxic ones may be
    return ToxicityModel(_dictionary(usual[::2], BASE_BYTES), _dictionary(usual[1::2], OWN_BYTES), _dictionary(own, OWN_BYTES))


def train(toxic: list[bytes], ordinary: list[bytes]) -> ToxicityModel:
    """Fit on plain texts of both classes.

    Without labelled documents of both classes every score is 0.5; without passages that set toxic ones apart, the share of label 1.
    """
    folds = [[ds[f::FOLDS] for f in range(FOLDS)] for ds in (toxic, ordinary)]
    marked = marks(*folds)
    model = _dictionaries(toxic, ordinary, marked[FOLDS])
    kept: list[tuple[np.ndarray, float]] = []
    for f in range(FOLDS):
        part = _dictionaries(*([d for i, d in enumerate(ds) if i % FOLDS != f] for ds in (toxic, ordinary)), marked[f])
        kept += [(part.distances(d) if part else np.zeros(0, np.int64), float(y)) for y in (0, 1) for d in folds[1 - y][f]]
    if model:
        hot, cold = (_share([d for d, y in kept if y == c]) for c in (1.0, 0.0))
        more = np.maximum(hot - cold, 1e-7)  # windows of a toxic document are a mixture; this is its toxic part
        model.gains = [np.log1p(s * (more / more.sum() / cold - 1)).tolist() for s in SHARES]
    else:
        model = ToxicityModel(b" ", b" ", b" ")
    if toxic and ordinary:
        x = np.array([model.features(d) for d, _ in kept])
        model.weights = _logistic(x, np.array([y for _, y in kept])).tolist()
    return model


def fit(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_ordinary: int = MAX_ORDINARY) -> ToxicityModel:
    """Train on labelled documents, whole: at most `max_toxic` and `max_ordinary` of them, the first by a hash of doc_id.

    `labels` has doc_id and toxic (0 or 1; rows with null are left out); of repeated labels the greatest counts, of texts
    with one doc_id the greatest.
    """
    y = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("label"))
    some = [y.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for c, n in ((0, max_ordinary), (1, max_toxic))]
    picked = [tuple(r) for s in some for r in s.collect()]  # pairs of numbers, max_toxic + max_ordinary at most
    if not picked:
        return train([], [])
    small = docs.sparkSession.createDataFrame(picked, "doc_id long, label int")
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null").join(F.broadcast(small), "doc_id")
    found: tuple[list[bytes], list[bytes]] = ([], [])
    for r in sorted(wanted.groupBy("doc_id", "label").agg(F.max("text").alias("text")).collect()):
        found[r.label].append(plain(r.text))
    return train(found[1], found[0])


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score and windows of every row; null and empty texts have no window and get the score that calibration gives to none.

    The whole text counts, however long. Repeated rows are scored each; other columns aren't read.
    """

    def run(batches):
        for b in batches:
            made = [model.score(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([s for s, _ in made], pa.float64()), pa.array([n for _, n in made], pa.int64())], ["doc_id", "score", "windows"])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, score double, windows long")


def reject_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that score below `threshold`, with their columns as they are; null texts stay."""
    names = docs.columns

    def run(batches):
        for b in batches:
            keep = [model.score(t.as_py())[0] < threshold for t in b.column("text")]
            yield b.filter(pa.array(keep, pa.bool_()))

    return arrow_map(docs.select(*(f"`{n}`" for n in names)), run, docs.schema)


def learn_rows(labels: DataFrame) -> DataFrame:
    """The fold that may be learnt from."""
    return labels.where(crc_mod(F.col("doc_id"), 3) != 1)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, learn_rows(read_table(spark, sf_dir, "labels")))
    out = score_documents(docs, model)
    return out.select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "windows")
