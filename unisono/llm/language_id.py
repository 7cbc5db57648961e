"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the mean of the embeddings of its hashed byte n-grams (within words, with their borders), a linear layer turns the
mean into scores of languages. Embeddings and layer are trained by stochastic gradient descent in numpy on a bounded
sample; temperature and rejection limit are set on a part of the sample that training doesn't see. As both layers are
linear, a trained model is their product: one row of scores for each bucket.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, crc_mod, mix64, read_table

BUCKETS = 1 << 14
DIM = 16
ORDERS = (2, 3, 4)
MAX_SAMPLE = 3000  # labelled documents that training reads at most, as evenly over languages as there are
MAX_LABELS = 10_000
EPOCHS = 8
ACCURACY = 0.99  # of accepted predictions, on the part kept for calibration
UNDETERMINED = "und"
_CHUNK = 1 << 20
_ASCII_LETTER = re.compile("[A-Za-z]")
_FOLD = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))  # after lower-casing, ASCII other than letters is a border
_TABLES = [mix64(np.arange(256, dtype=np.uint64) + np.uint64(256 * (k + 1))) for k in range(4)]
_SHIFT = np.uint64(64 - BUCKETS.bit_length() + 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def has_letter(text: str | None) -> bool:
    return bool(text) and bool(_ASCII_LETTER.search(text) or any(map(str.isalpha, text)))


def buckets(text: str) -> list[np.ndarray]:
    """Buckets of all n-grams of a text, by chunks of bounded size (with an overlap, so that none is lost or counted twice)."""
    data = np.frombuffer(b" " + text.lower().encode("utf-8", "surrogatepass").translate(_FOLD) + b" ", np.uint8)
    out = []
    for n in ORDERS:
        for at in range(0, max(0, len(data) - n + 1), _CHUNK):
            d = data[at : at + _CHUNK + n - 1]
            m = len(d) - n + 1
            space = d == 32
            bad = space[:m] & space[n - 1 : n - 1 + m]
            for j in range(1, n - 1):
                bad |= space[j : j + m]
            h = _TABLES[0][d[:m]]
            for j in range(1, n):
                h = h + _TABLES[j][d[j : j + m]]
            out.append(((h * _ODD) >> _SHIFT)[~bad].astype(np.int32))
    return out


def counts(text: str) -> np.ndarray:
    total = np.zeros(BUCKETS, np.int64)
    for b in buckets(text):
        total += np.bincount(b, minlength=BUCKETS)
    return total


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class LanguageModel:
    labels: list[str]
    table: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def logits(self, text: str) -> np.ndarray:
        total, n = np.zeros(len(self.labels), np.float64), 0
        for b in buckets(text):
            if len(b) > BUCKETS // 2:
                total += np.bincount(b, minlength=BUCKETS) @ self.table
            else:
                total += self.table[b].sum(axis=0, dtype=np.float64)
            n += len(b)
        return total / max(1, n) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, calibrated probability, and whether it falls below the rejection limit."""
        if not self.labels or not has_letter(text):
            return UNDETERMINED, 0.0, True
        p = _softmax(self.logits(text) / self.temperature)
        best = int(p.argmax())
        return self.labels[best], float(p[best]), bool(p[best] < self.reject_below)


def train(texts: list[np.ndarray], labels: list[str], epochs: int = EPOCHS, rate: float = 6.0, batch: int = 32, seed: int = 7) -> LanguageModel:
    """Fit on bucket counts. Every fifth example calibrates. No example: a model that predicts `und` only."""
    names = sorted(set(labels))
    if not names:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    y = np.array([names.index(x) for x in labels])
    kept = np.arange(len(y)) % 5 == 4
    learn = np.flatnonzero(~kept)
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = rng.normal(0, 0.1, (DIM, len(names))).astype(np.float32), np.zeros(len(names), np.float32)

    def dense(rows) -> np.ndarray:
        x = np.zeros((len(rows), BUCKETS), np.float32)
        for i, r in enumerate(rows):
            at, n = texts[r]
            x[i, at] = n / max(1, n.sum())
        return x

    steps, done = max(1, epochs * ((len(learn) + batch - 1) // batch)), 0
    for _ in range(epochs):
        order = rng.permutation(learn)
        for i in range(0, len(order), batch):
            rows = order[i : i + batch]
            x = dense(rows)
            mean = x @ emb
            g = _softmax(mean @ out + bias)
            g[np.arange(len(rows)), y[rows]] -= 1
            g /= len(rows)
            lr = rate * (1 - done / steps)
            used = np.flatnonzero(x.any(axis=0))
            step = x[:, used].T @ (g @ out.T)
            out -= lr * mean.T @ g
            emb[used] -= lr * 40 * step  # the gradient of an embedding is divided by the length of its texts
            bias -= lr * 0.1 * g.sum(axis=0)
            done += 1
    model = LanguageModel(names, emb @ out, bias.astype(np.float64))
    rows = np.flatnonzero(kept)
    if len(rows):
        z = np.concatenate([dense(rows[i : i + 64]) @ model.table for i in range(0, len(rows), 64)]) + bias
        aim = np.full((len(rows), len(names)), 1 / (len(rows) + 2) / max(1, len(names) - 1))  # never quite certain, as in Platt's scaling
        aim[np.arange(len(rows)), y[rows]] = (len(rows) + 1) / (len(rows) + 2)
        grid = np.geomspace(0.02, 5, 60)
        loss = [-(aim * np.log(_softmax(z / t) + 1e-12)).sum(axis=1).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        p = _softmax(z / model.temperature)
        right, top = p.argmax(axis=1) == y[rows], p.max(axis=1)
        order = np.argsort(-top)
        share = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(share >= ACCURACY)
        ladder = [*top[order], 1 / len(names)]
        model.reject_below = float((ladder[good[-1]] + ladder[good[-1] + 1]) / 2) if len(good) else 1.0
    return model


def _features(batches):
    for b in batches:
        at, n = [], []
        for t in b.column("text"):
            c = counts(t.as_py())
            i = np.flatnonzero(c)
            at.append(i.astype(np.uint16).tobytes())
            n.append(c[i].astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([b.column("key"), b.column("label"), pa.array(at, pa.binary()), pa.array(n, pa.binary())], ["key", "label", "at", "n"])


def fit(docs: DataFrame, key: str = "doc_id", label: str = "lang", max_sample: int = MAX_SAMPLE) -> LanguageModel:
    """Train on rows with a text that has a letter and a label; `max_sample` of them at most, chosen by a hash of the key.

    Labels take turns, so that rare ones are kept; of texts with one key and label the greatest counts. What reaches the driver is bounded: `max_sample` sparse rows of BUCKETS counts.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(label).alias("label"), "text").where("label is not null and text is not null and key is not null")
    # of each label, rows whose hash is low enough to hold twice the sample, so that a frequent label burdens no task
    sizes = rows.groupBy("label").agg(F.count("*").alias("size"))
    some = rows.select("key", "label", F.xxhash64("key").alias("h"))
    few = sizes.limit(MAX_LABELS + 1).collect()  # a model has a row of weights for each label
    if len(few) <= MAX_LABELS:
        low = docs.sparkSession.createDataFrame([(r.label, -(2.0**63) + 2.0**64 * min(1.0, (2 * max_sample + 1000) / r["size"])) for r in few], "label string, top double")
        some = some.join(F.broadcast(low), "label").where("h <= top")
    order = Window.partitionBy("label").orderBy("h", "key")
    turn = some.select("key", "label", "h").withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= max_sample)
    keys = [r.key for r in turn.orderBy("turn", "label").limit(max_sample).select("key").collect()]
    if not keys:
        return train([], [])
    chosen = docs.sparkSession.createDataFrame([(k,) for k in sorted(set(keys))], "key long")
    once = rows.join(F.broadcast(chosen), "key").groupBy("key", "label").agg(F.max("text").alias("text"))
    got = arrow_map(once, _features, "key long, label string, at binary, n binary").collect()
    got = sorted((r for r in got if len(r.at)), key=lambda r: (r.key * 0x9E3779B1 % 2**32, r.key))
    return train([(np.frombuffer(r.at, np.uint16), np.frombuffer(r.n, np.float32)) for r in got], [r.label for r in got])


def predict_documents(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every row, from the whole text alone.

    Null, empty and letterless texts: `und`, 0.0, rejected. A rejected text keeps its most likely language in lang_pred.
    Repeated rows are predicted each; other columns aren't read.
    """

    def run(batches):
        for b in batches:
            made = [model.predict(t.as_py()) for t in b.column("text")]
            cols = [pa.array([m[k] for m in made], kind) for k, kind in ((0, pa.string()), (1, pa.float64()), (2, pa.bool_()))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *cols], ["doc_id", "lang_pred", "score", "rejected"])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, lang_pred string, score double, rejected boolean")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    model = fit(docs.where(~held_out))
    out = predict_documents(docs, model)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
