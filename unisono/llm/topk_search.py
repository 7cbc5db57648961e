"""Exact top-k search by inner product.

Queries and candidates are packed into blocks. Each tile, a block of queries against a shard of candidates, is one
matrix product; a partial selection keeps k rows for each query of the tile, and the lists of the tiles are merged in a
tree of bounded fan-in. The queries are a stated set that meets all rows in blocks; no pair becomes a row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, materialize, read_table

K = 20
BLOCK = 2048
FAN_IN = 16
BROADCAST_BYTES = 32 << 20  # of all blocks of queries; beyond, both sides are dealt to a grid
_BLOCKS = "dim int, tile long, ids binary, data binary"
_LISTS = "query_id long, tile long, best array<struct<score:long,vec_id:long>>"


def _pack(key: str, per_block: int):
    def run(batches):
        ids: dict[int, list[int]] = {}
        rows: dict[int, list[np.ndarray]] = {}
        part = _partition()
        made = 0

        def flush(dim: int):
            nonlocal made
            out = pa.RecordBatch.from_pydict(
                {
                    "dim": pa.array([dim], pa.int32()),
                    "tile": pa.array([part << 33 | made], pa.int64()),
                    "ids": pa.array([np.array(ids.pop(dim), np.int64).tobytes()], pa.binary()),
                    "data": pa.array([np.stack(rows.pop(dim)).tobytes()], pa.binary()),
                }
            )
            made += 1
            return out

        for batch in batches:
            for i, v in zip(batch.column(key).to_pylist(), batch.column("_v").to_pylist(), strict=True):
                ids.setdefault(len(v), []).append(i)
                rows.setdefault(len(v), []).append(np.array(v, np.int64))
                if len(ids[len(v)]) == per_block:
                    yield flush(len(v))
        for dim in list(ids):
            yield flush(dim)

    return run


def _partition() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def _product(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products; in float64 where all sums stay exact there, else in int64."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if top < 2**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    return q @ c.T


def _tile(k: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                qid, cid = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
                q = np.frombuffer(row["q_data"], np.int64).reshape(-1, dim)
                c = np.frombuffer(row["data"], np.int64).reshape(-1, dim)
                order = np.argsort(cid, kind="stable")
                cid, c = cid[order], c[order]
                keep_q, keep = [], []
                for at in range(0, len(qid), 256):  # bounds the matrix of scores
                    score = _product(q[at : at + 256], c)
                    own = cid[None, :] == qid[at : at + 256, None]
                    for i in range(len(score)):
                        s, ok = score[i], ~own[i]
                        s, who = s[ok], cid[ok]
                        if not len(s):
                            continue
                        if len(s) > k:
                            least = np.partition(s, len(s) - k)[len(s) - k]
                            sel = np.flatnonzero(s >= least)  # ties at the limit are settled by vec_id below
                        else:
                            sel = np.arange(len(s))
                        sel = sel[np.lexsort((who[sel], -s[sel]))[:k]]
                        keep_q.append(int(qid[at + i]))
                        keep.append([{"score": int(a), "vec_id": int(b)} for a, b in zip(s[sel], who[sel], strict=True)])
                yield pa.RecordBatch.from_pydict(
                    {
                        "query_id": pa.array(keep_q, pa.int64()),
                        "tile": pa.array([row["tile_no"]] * len(keep_q), pa.int64()),
                        "best": pa.array(keep, pa.list_(pa.struct([("score", pa.int64()), ("vec_id", pa.int64())]))),
                    }
                )

    return run


def usable(v: Column, scale: float) -> Column:
    """floor(scale * x) of every component; null where the vector, or a component, is null or not finite."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return F.when(v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True)), whole)


def top_k(queries: DataFrame, rows: DataFrame, id_col: str, vector_col: str, k: int = K, scale: float = 64.0, block: int = BLOCK) -> DataFrame:
    """The k rows of greatest integer inner product for each query: query_id, rank, vec_id, score.

    Ties go to the smaller id. A row that has the query's id is the query's own and no candidate. Unusable vectors (see
    `usable`) take no part; vectors of different length don't meet; repeated rows count each. A query without candidates
    has no rows, and empty tables give an empty result. Only the two named columns are read.
    """
    spark = rows.sparkSession

    def packed(df: DataFrame, per_block: int) -> DataFrame:
        df = df.select(F.col(id_col).cast("long").alias("_id"), usable(F.col(vector_col), scale).alias("_v")).where("_v is not null and _id is not null")
        return arrow_map(df, _pack("_id", per_block), _BLOCKS)

    # a block is a row of 1 MB at most where vectors have 64 components; each meets every block of queries
    q = materialize(packed(queries, block)).select("dim", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.col("tile").alias("q_tile"))
    size = q.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("q_data")), F.lit(0))).first()
    shards = packed(rows, block).withColumn("tile_no", F.col("tile"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if size[1] <= BROADCAST_BYTES:
        tiles = shards.join(F.broadcast(q), "dim")
    else:  # a grid of query stripes and shard groups; a shard is copied to each stripe, a block of queries to each group
        stripes = max(1, min(size[0], math.isqrt(parts)))
        groups = max(1, parts // stripes)
        q = q.withColumn("stripe", F.pmod(F.xxhash64("q_tile"), F.lit(stripes))).withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
        shards = shards.withColumn("group", F.pmod(F.xxhash64("tile"), F.lit(groups))).withColumn("stripe", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(stripes - 1).cast("long"))))
        tiles = shards.join(q, ["dim", "stripe", "group"])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", min(8, int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))))
    lists = tiles.select("dim", "q_ids", "q_data", "ids", "data", "tile_no").mapInArrow(_tile(k), _LISTS)
    return merge_lists(lists, k, levels=max(2, math.ceil(math.log(max(2, rows.count() / block + parts), FAN_IN))))


def merge_lists(lists: DataFrame, k: int, fan_in: int = FAN_IN, levels: int = 2) -> DataFrame:
    """Merge per-tile lists: at each level a group holds about `fan_in` lists of k entries, the last joins what is left."""
    for level in range(levels - 1, -1, -1):
        width = fan_in**level  # groups of a query that are left after this level
        group = F.pmod(F.xxhash64("tile"), F.lit(width)) if level else F.lit(0)
        best = F.slice(F.expr("array_sort(flatten(collect_list(best)), (a, b) -> case when a.score > b.score then -1 when a.score < b.score then 1 when a.vec_id < b.vec_id then -1 when a.vec_id > b.vec_id then 1 else 0 end)"), 1, k)
        lists = lists.groupBy("query_id", group.cast("long").alias("tile")).agg(best.alias("best"))
    return lists.select("query_id", F.posexplode("best")).select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "col.vec_id", "col.score")


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return top_k(rows.where("vec_id % 20 = 0"), rows, "vec_id", "embedding")


ORACLE_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as e from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id as vec_id, list_inner_product(q.e, c.e)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 20 = 0
), r as (
  select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, vec_id, score from s
)
select query_id, rank::int as rank, vec_id, score from r where rank <= 20
"""
