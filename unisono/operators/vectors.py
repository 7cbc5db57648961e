"""Nearest vectors by cosine, in blocks: a stated set of queries meets all rows as matrix products, and no pair is a row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unisono.sources.shared import cut

BLOCK = 2048
BROADCAST_BYTES = 32 << 20
_BLOCKS = "block long, dim int, ids array<long>, data binary"
_BEST = "query_id long, block long, best array<struct<cosine:double,vec_id:long>>"


def _pack(batches):
    """Vectors of one length as blocks of unit vectors; those of length zero have no cosine and take no part."""
    from pyspark import TaskContext

    part, made = TaskContext.get().partitionId() << 32, 0
    for b in batches:
        groups: dict[int, list] = {}
        for i, v in zip(b.column("id").to_pylist(), b.column("v").to_pylist(), strict=True):
            groups.setdefault(len(v), []).append((i, v))
        for dim, rows in groups.items():
            x = np.array([v for _, v in rows], np.float64)
            norm = np.sqrt((x * x).sum(axis=1))
            ok = norm > 0
            ids = [i for (i, _), k in zip(rows, ok, strict=True) if k]
            if ids:
                yield pa.RecordBatch.from_pydict({"block": pa.array([part + made], pa.int64()), "dim": pa.array([dim], pa.int32()), "ids": pa.array([ids], pa.list_(pa.int64())), "data": pa.array([(x[ok] / norm[ok, None]).tobytes()], pa.binary())})
                made += 1


def _tiles(k: int):
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                q, c = (np.frombuffer(r[n], np.float64).reshape(-1, r["dim"]) for n in ("q_data", "data"))
                ids = np.array(r["ids"], np.int64)
                who, best = [], []
                for at in range(0, len(q), 256):
                    score = np.round(q[at : at + 256] @ c.T, 6)
                    for i, s in zip(r["q_ids"][at : at + 256], score, strict=True):
                        other = np.flatnonzero(ids != i)
                        if len(other) > k:  # all that tie with the k-th stay, ids decide
                            other = other[s[other] >= np.partition(s[other], len(other) - k)[len(other) - k]]
                        top = other[np.lexsort((ids[other], -s[other]))[:k]]
                        who.append(i)
                        best.append([{"cosine": float(s[j]), "vec_id": int(ids[j])} for j in top])
                yield pa.RecordBatch.from_pydict({"query_id": pa.array(who, pa.int64()), "block": pa.array([r["block"]] * len(who), pa.int64()), "best": pa.array(best, pa.list_(pa.struct([("cosine", pa.float64()), ("vec_id", pa.int64())])))})

    return run


def nearest(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, cosine, rank): the k rows of greatest cosine, at six digits, for each query, its own id left out; ties to the
    smaller id. `rows` and `queries` have id and v (array<double>). Vectors that are null, empty or zero take no part; those of different
    length don't meet."""
    spark = rows.sparkSession

    def packed(df: DataFrame) -> DataFrame:
        return df.where("v is not null and size(v) > 0").select("id", "v").mapInArrow(_pack, _BLOCKS)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BLOCK))
    q = cut(packed(queries)).select("dim", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
    c = cut(packed(rows))
    size = q.agg(F.coalesce(F.sum(F.octet_length("q_data")), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        tiles = c.join(F.broadcast(q), "dim")
    else:  # a copy of the queries for each group of blocks
        groups = int(spark.conf.get("spark.sql.shuffle.partitions"))
        q = q.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
        tiles = c.withColumn("group", F.pmod(F.xxhash64("block"), F.lit(groups))).join(q, ["dim", "group"])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
    lists = cut(tiles.select("block", "dim", "ids", "data", "q_ids", "q_data").mapInArrow(_tiles(k), _BEST))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    order = "(a, b) -> case when a.cosine > b.cosine then -1 when a.cosine < b.cosine then 1 when a.vec_id < b.vec_id then -1 when a.vec_id > b.vec_id then 1 else 0 end"
    for width in (256, 1):  # lists are merged in two steps, so that a query's are not all in one group
        lists = lists.groupBy("query_id", F.pmod(F.xxhash64("block"), F.lit(width)).alias("block")).agg(F.slice(F.expr(f"array_sort(flatten(collect_list(best)), {order})"), 1, k).alias("best"))
    return lists.select("query_id", F.posexplode("best")).select("query_id", "col.vec_id", "col.cosine", (F.col("pos") + 1).cast("int").alias("rank"))
