"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ROWS_PER_BATCH = 256
_BYTES_PER_BATCH = 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, in rows and in bytes; texts may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(_ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(_BYTES_PER_BATCH))


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder under spark.checkpoint.dir; a local one only where that is unset (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()
    if not base:
        base = tempfile.mkdtemp(prefix="unisono-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/unisono-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage is cut and a lost executor loses nothing."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(df: DataFrame) -> None:
    """Delete the files of a materialized frame that is needed no more."""
    spark = df.sparkSession
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        if re.search(r"/unisono-[0-9a-f]{32}$", f):
            path = spark._jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def arrow_map(df: DataFrame, fn, schema: str) -> DataFrame:
    """mapInArrow over bounded batches; fn(batches) yields record batches."""
    small_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of the value written as text, modulo n."""
    return F.crc32(col.cast("string").cast("binary")) % n


def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[str | None]:
    return (x.as_py() for x in batch.column(name))


# ---- word hashing over whole batches of bytes (numpy) ----

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, element by element."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)
        self.inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = 1 << (n - 1).bit_length()
            self.up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _BASE)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, self.inverse)]), dtype=np.uint64)
        return self.up[:n], self.down[:n]


_powers = Powers()
_TABLE = mix64(np.arange(1, 257, dtype=np.uint64))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[i] = sum over j < i of table[data[j]] * base^j modulo 2^64."""
    up, _ = _powers.get(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * up[: len(data)], out=out[1:], dtype=np.uint64)
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of data[start:end], equal for equal bytes wherever they lie."""
    _, down = _powers.get(len(prefix))
    return mix64((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of bytes other than ASCII white space."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.flatnonzero(np.diff(np.concatenate([[True], _SPACE[data], [True]]).view(np.int8)))
    return edge[::2], edge[1::2]


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word `[^\\x20\\x09-\\x0D]+` after A-Z are lower-cased."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_LOWER), np.uint8)
    start, end = word_spans(data)
    return span_hash(prefix_hash(data), start, end)


_STEPS = [np.uint64(int(x)) for x in mix64(np.arange(1000, 1064, dtype=np.uint64))]


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words; with fewer words, of the whole sequence."""
    if not len(words):
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    n = len(words) - size + 1
    acc = np.full(n, np.uint64(size), np.uint64)
    for k in range(size):
        acc = mix64(acc * _STEPS[k] + words[k : k + n])
    return np.unique(acc)
