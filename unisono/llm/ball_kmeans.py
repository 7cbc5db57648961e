"""Ball k-means: exact Lloyd rounds in which a vector meets only the centroids that may be nearer than its own.

The vectors lie in blocks with the clusters they were last in. The members of a cluster in a block form a ball around the
cluster's new centroid: its radius is their greatest distance. With squared distances in integers, a centroid j can only be
nearer to x, or as near, than x's own centroid i where |i - j|^2 <= 4 |x - i|^2. So the ball's neighbours are the centroids within
twice its radius; members nearer than half the way to the first neighbour are its stable core and stay, and those
between half the ways to the n-th and the next neighbour, an annulus, are compared with n neighbours, exactly.

Blocks are written to the shared folder in each round, with sums for each cluster; the driver holds k centroids only.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, materialize, read_table, remove, small_batches

K = 40
ROUNDS = 5
SCALE = 256
DIM = 64
SEED = 2
BLOCK = 2048  # vectors
LARGEST = 1 << 27  # components are cut to this, so that a squared distance of up to 64 of them fits a long
_BLOCK_ROWS = "ids array<long>, wide boolean, data binary, labels binary, parts array<struct<cluster:int,n:long,total:array<long>>>"


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances [vector, centroid], exact."""
    if max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0))) < 1 << 20:  # all sums are exact in float64
        cross = (x.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    else:
        cross = x @ c.T
    return (x * x).sum(1)[:, None] - 2 * cross + (c * c).sum(1)[None, :]


class Neighbours:
    """For each centroid the others by distance, and the least squared distance of a member at which they matter."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        apart = nearest(centroids, centroids)
        self.order, self.matter = [], []
        for i, row in enumerate(apart):
            others = np.delete(np.arange(len(row)), i)
            others = others[np.argsort(row[others], kind="stable")]
            self.order.append(others)
            self.matter.append(-(-row[others] // 4))

    def assign(self, x: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid (ties: the smaller number) and squared distance, from labels that may be any."""
        own = x - self.centroids[labels]
        best = (own * own).sum(1)
        out = labels.copy()
        for i in np.unique(labels):
            ball = np.flatnonzero(labels == i)
            reach = np.searchsorted(self.matter[i], best[ball], side="right")  # neighbours that matter to each member
            for n in np.unique(reach[reach > 0]):  # an annulus; the stable core has none
                members = ball[reach == n]
                rivals = np.sort(np.append(self.order[i][:n], i))
                d = nearest(x[members], self.centroids[rivals])
                pick = d.argmin(axis=1)
                out[members] = rivals[pick]
                best[members] = d[np.arange(len(members)), pick]
        return out, best


def _pack(scale: float, size: int):
    """Vectors as blocks without labels."""

    def put(ids, rows):
        x = np.clip(np.floor(np.array(rows, np.float64) * scale), -LARGEST, LARGEST).astype(np.int32)
        wide = bool(np.abs(x).max() >= 1 << 15)
        cols = {"ids": [ids], "wide": [wide], "data": [(x if wide else x.astype(np.int16)).tobytes()], "labels": [b""], "parts": [[]]}
        return pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(cols.items(), _ARROW, strict=True)})

    def run(batches):
        ids, rows = [], []
        for b in batches:
            for i, v in zip(b.column("_id").to_pylist(), b.column("_v").to_pylist(), strict=True):
                ids.append(i)
                rows.append(v)
                if len(ids) == size:
                    yield put(ids, rows)
                    ids, rows = [], []
        if ids:
            yield put(ids, rows)

    return run


_ARROW = [pa.list_(pa.int64()), pa.bool_(), pa.binary(), pa.binary(), pa.list_(pa.struct([("cluster", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.int64()))]))]


def _blocks(batches, centroids: np.ndarray):
    """Each block: its row, vectors, and what they are assigned to."""
    near = Neighbours(centroids)
    for b in batches:
        for row in b.to_pylist():
            x = np.frombuffer(row["data"], np.int32 if row["wide"] else np.int16).reshape(-1, centroids.shape[1]).astype(np.int64)
            if row["labels"]:
                labels, d = near.assign(x, np.frombuffer(row["labels"], np.int32))
            else:  # no ball yet
                far = nearest(x, centroids)
                labels = far.argmin(axis=1).astype(np.int32)
                d = far[np.arange(len(x)), labels]
            yield row, x, labels, d


def _round(centroids: np.ndarray):
    """Blocks with new labels, and the sums of each cluster in the block."""

    def run(batches):
        for row, x, labels, _ in _blocks(batches, centroids):
            parts = [{"cluster": int(i), "n": int((labels == i).sum()), "total": x[labels == i].sum(0).tolist()} for i in np.unique(labels)]
            cols = [[row["ids"]], [row["wide"]], [row["data"]], [labels.astype(np.int32).tobytes()], [parts]]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, _ARROW, strict=True)], ["ids", "wide", "data", "labels", "parts"])

    return run


def _sums(batches):
    """Sums of each cluster over the blocks of a task."""
    n: dict[int, int] = {}
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for parts in b.column("parts").to_pylist():
            for p in parts:
                n[p["cluster"]] = n.get(p["cluster"], 0) + p["n"]
                total[p["cluster"]] = total.get(p["cluster"], 0) + np.array(p["total"], np.int64)
    if n:
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(list(n), pa.int32()), "n": pa.array(list(n.values()), pa.int64()), "total": pa.array([total[c].tolist() for c in n], pa.list_(pa.int64()))})


def _final(centroids: np.ndarray):
    def run(batches):
        for row, _, labels, d in _blocks(batches, centroids):
            yield pa.RecordBatch.from_pydict({"vec_id": pa.array(row["ids"], pa.int64()), "cluster": pa.array(labels, pa.int32()), "distance": pa.array(d, pa.int64())})

    return run


class Clusters(NamedTuple):
    """`members`: vec_id, cluster, distance (squared). `centroids`: whole numbers, by cluster."""

    members: DataFrame
    centroids: list[list[int]]


def ball_kmeans(rows: DataFrame, id_col: str, vector_col: str, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, dim: int = DIM, seed: int = SEED) -> Clusters:
    """`rounds` Lloyd rounds over floor(scale * x) of every vector with `dim` components, then one more assignment.

    Centroids start as the k vectors with the least hex sha256 of `seed:id` and move to floor(sum / count) of their members;
    empty ones stay. Ties go to the smaller number. Vectors that are null, of another length, or hold a null or non-finite
    component take no part. With fewer than k vectors there are as many centroids; rows of one id that start as
    centroids follow each other by their components, and a vector without id takes part but starts last. A repeated
    row counts each time. Components beyond 2^27 count as 2^27, since squared distances are longs. An empty table has no
    members and no centroids. Other columns aren't read.
    """
    spark = rows.sparkSession
    bad = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    vectors = rows.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).cast("array<double>").alias("_v")).where((F.size("_v") == dim) & ~bad)
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_id").cast("string")), 256)
    first = vectors.select(hashed.alias("h"), "_v").orderBy(F.col("h").asc_nulls_last(), "_v").limit(k).collect()
    if not first:
        return Clusters(spark.createDataFrame([], "vec_id long, cluster int, distance long"), [])
    centroids = np.clip(np.floor(np.array([r["_v"] for r in first], np.float64) * scale), -LARGEST, LARGEST).astype(np.int64)

    blocks = materialize(arrow_map(vectors, _pack(scale, BLOCK), _BLOCK_ROWS))
    for _ in range(rounds):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
        done = materialize(blocks.mapInArrow(_round(centroids), _BLOCK_ROWS))
        remove(blocks)
        blocks = done
        parts = blocks.select("parts").mapInArrow(_sums, "cluster int, n long, total array<long>")
        moved = centroids.copy()
        for r in parts.select("cluster", "n", F.posexplode("total")).groupBy("cluster", "pos").agg(F.sum("n").alias("n"), F.sum("col").alias("s")).collect():  # k * dim rows
            moved[r["cluster"], r["pos"]] = r["s"] // r["n"]
        still = (moved == centroids).all()
        centroids = moved
        if still:  # further rounds would change nothing
            break
    members = materialize(blocks.mapInArrow(_final(centroids), "vec_id long, cluster int, distance long"))
    remove(blocks)
    small_batches(spark)
    return Clusters(members, centroids.tolist())


def op13_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, centroids = ball_kmeans(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    sums = {r["cluster"]: int(r["s"]) for r in members.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}  # k rows
    most, whole = (1 << 63) - 1, sum(sums.values())
    rows = [(i, min(n, most), min(whole, most), hashlib.sha256(",".join(map(str, centroids[i])).encode()).hexdigest()) for i, n in sums.items()]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return members.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


# ---- SQL ----


def _sql(k: int = K, rounds: int = ROUNDS) -> str:
    out = f"""
with v as materialized (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)) as e from embeddings
  where len(embedding) = {DIM} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), c0 as materialized (
  select row_number() over (order by sha256('{SEED}:' || vec_id) nulls last, e) - 1 as c, e from v order by 1 limit {k}
)"""
    for i in range(rounds + 1):
        out += f""", a{i} as materialized (
  select v.row, min((list_inner_product(v.e, v.e) - 2 * list_inner_product(v.e, c.e) + list_inner_product(c.e, c.e))::hugeint * {k} + c.c) as best
  from v, c{i} c group by v.row
)"""
        if i < rounds:
            out += f""", c{i + 1} as materialized (
  select c.c, coalesce(m.e, c.e) as e from c{i} c left join (
    select c, list(floor_sum order by i) as e from (
      select best % {k} as c, i, ((sum(e[i]::bigint) - ((sum(e[i]::bigint) % count(*)) + count(*)) % count(*)) // count(*))::double as floor_sum
      from a{i} join v using (row), range(1, {DIM + 1}) r(i) group by 1, 2
    ) group by c
  ) m on m.c = c.c
)"""
    return (
        out
        + f"""
select v.vec_id, (best % {k})::int as cluster, (best // {k})::bigint as distance, (sum(best // {k}) over (partition by best % {k}))::bigint as cluster_inertia,
  (sum(best // {k}) over ())::bigint as inertia, sha256(array_to_string(list_transform(c.e, lambda x: x::bigint::varchar), ',')) as centroid_sha256
from a{rounds} join v using (row) join c{rounds} c on c.c = best % {k}
"""
    )


ORACLE_SQL = _sql()
