"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised into 2^bits buckets each, rows are sorted by the index of their cell on
the Hilbert curve, and the sorted sequence is cut into runs. Neighbouring runs hold neighbouring cells, so the
minimum and maximum of *every* dimension stay narrow in a file and readers can skip files on any of them.

No row visits the driver. Bucket limits of numbers come from `percentile_approx` sketches of fixed size, those of strings from
counts of their whole values; the order comes from one range exchange of narrow rows, and ranks from the row counts of its
partitions. Rows of one group (equal texts) take one cell, so a group is parted by the cuts between runs alone.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, read_table

SHARDS = 40
BITS = 4
HEAVY = 50_000  # broadcast groups number fewer than this


def hilbert_index(point: tuple[int, ...], bits: int) -> int:
    """Distance of an integer point along the Hilbert curve of len(point) dimensions, 2^bits cells a side."""
    x, n = list(point), len(point)
    top = 1 << (bits - 1)
    q = top
    while q > 1:  # undo the rotations, from the coarsest level to the finest
        low = q - 1
        for i in range(n):
            if x[i] & q:
                x[0] ^= low
            else:
                swap = (x[0] ^ x[i]) & low
                x[0] ^= swap
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    flip, q = 0, top
    while q > 1:
        if x[n - 1] & q:
            flip ^= q - 1
        q >>= 1
    index = 0
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            index = index << 1 | ((x[i] ^ flip) >> b & 1)
    return index


def string_limits(df: DataFrame, col: Column, steps: list[float]) -> list[str]:
    """The values at which the running share of rows, in order of whole values, first reaches each of `steps`.

    Rows are counted by value before anything is ordered, so a frequent value is one row here; the values lie in range
    partitions, and the driver sees a total for each of these and one value for each step.
    """
    counts = df.select(col.alias("v")).where("v is not null").groupBy("v").agg(F.count("*").alias("n"))
    local = materialize(counts.repartitionByRange(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "v").withColumn("part", F.spark_partition_id()))
    totals = sorted(local.groupBy("part").agg(F.sum("n")).collect())  # one row for each partition
    ends = list(accumulate(n for _, n in totals))
    if not ends:
        return []
    before = df.sparkSession.createDataFrame([(p, e - n) for (p, n), e in zip(totals, ends, strict=True)], "part int, before long")
    running = F.col("before") + F.sum("n").over(Window.partitionBy("part").orderBy("v"))
    to = local.join(F.broadcast(before), "part").withColumn("to", running)
    marks = [F.min(F.when(F.col("to") >= ends[-1] * q, F.col("v"))).alias(f"m{i}") for i, q in enumerate(steps)]
    return list(to.agg(*marks).first())


def hilbert_order(df: DataFrame, dims: dict[str, Column], bits: int = BITS) -> DataFrame:
    """`df` with a column `<name>_bucket` for each of `dims` (numeric or string expressions) and the column `curve`.

    Limits of buckets are quantiles of the data, approximate ones for numbers. Null and NaN values take bucket 0. An empty table gives
    an empty table. dims * bits is at most 16, so that the table of cells, which is broadcast, has at most 65536 rows.
    """
    if not dims or len(dims) * bits > 16:
        raise ValueError("between 1 and 16 // bits dimensions")
    steps = [(i + 1) / 2**bits for i in range(2**bits - 1)]
    types = dict(df.select(*(x.alias(k) for k, x in dims.items())).dtypes)
    values = {k: x if types[k] == "string" else F.nanvl(x.cast("double"), F.lit(None)) for k, x in dims.items()}
    numeric = [F.percentile_approx(v, steps, 1000).alias(k) for k, v in values.items() if types[k] != "string"]
    limits = df.agg(*numeric).first().asDict() if numeric else {}
    out = df
    for k, v in values.items():
        cuts = sorted(set(string_limits(df, v, steps) if types[k] == "string" else limits[k] or []))
        bucket = sum(((v > F.lit(c)).cast("int") for c in cuts), F.lit(0))
        out = out.withColumn(f"{k}_bucket", F.coalesce(bucket, F.lit(0)).cast("int"))
    code = F.lit(0)
    for k in dims:
        code = code * 2**bits + F.col(f"{k}_bucket")
    n = len(dims)
    cells = [(c, hilbert_index(tuple(c >> bits * (n - 1 - i) & 2**bits - 1 for i in range(n)), bits)) for c in range(2 ** (n * bits))]
    table = df.sparkSession.createDataFrame(cells, "_cell int, curve int")
    return out.withColumn("_cell", code.cast("int")).join(F.broadcast(table), "_cell", "left").drop("_cell")


def global_rank(df: DataFrame, keys: list[str], out: str = "rank") -> DataFrame:
    """Row number from 0 over the whole table in the order of `keys`, which must be unique together.

    One range exchange; each partition is numbered alone and moved up by the rows of the partitions before it.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    local = (
        df.repartitionByRange(parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    local = materialize(local)
    counts = local.groupBy("_part").count().collect()  # one row for each partition
    before, total = {}, 0
    for part, n in sorted(counts):
        before[part] = total
        total += n
    offsets = spark.createDataFrame([(k, v, total) for k, v in before.items()], "_part int, _before long, _total long")
    return local.join(F.broadcast(offsets), "_part").withColumn(out, F.col("_before") + F.col("_row")).drop("_part", "_row", "_before")


def shard_rows(df: DataFrame, keys: list[str], shards: int = SHARDS) -> DataFrame:
    """Cut the order of `keys` into `shards` runs whose row counts differ by one at most: columns `shard` and `slot`."""
    ranked = global_rank(df, keys, "_rank")
    shard = F.expr(f"cast((_rank * {shards}) div _total as int)")
    start = F.expr(f"(shard * _total + {shards - 1}) div {shards}")
    return ranked.withColumn("shard", shard).withColumn("slot", F.col("_rank") - start).drop("_rank", "_total")


def gather(placed: DataFrame, key: str) -> DataFrame:
    """`placed` with `curve` the least of its group of equal `key`s.

    Only groups that lie in several cells are looked up. Groups of more than one in HEAVY rows, of which there are fewer than
    HEAVY, are broadcast; rows of all others meet theirs by an exchange, in which no key has more than that share.
    """
    total = placed.count()
    groups = materialize(placed.groupBy(key).agg(F.min("curve").alias("_least"), F.max("curve").alias("_most"), F.count("*").alias("_n")).where("_least < _most").drop("_most"))
    is_heavy = F.col("_n") * HEAVY > total
    heavy, light = F.broadcast(groups.where(is_heavy).drop("_n")), groups.where(~is_heavy).drop("_n")
    rest = placed.join(heavy.select(key), key, "left_anti").join(light, key, "left")
    out = rest.unionByName(placed.join(heavy, key))
    return out.withColumn("curve", F.coalesce("_least", "curve")).drop("_least")


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shards of documents by source, language and length.

    Law `rows`. Documents of equal text share the least of their cells and lie side by side there, so the cuts part
    `shards` - 1 groups at most; the buckets stay each document's own. Null texts have 16 bytes and the crc32 of no
    bytes and count as one group; null source, language and text take bucket 0; doc_id must be unique. Repeated rows of one doc_id would
    still get different slots. Other columns, whatever their names, are left out. An empty table gives an empty table.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16
    narrow = docs.select(
        "doc_id",
        size.alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("_hash"),
        F.col("source").alias("_source"),
        F.col("lang").alias("_lang"),
    )
    narrow = materialize(narrow)  # the text is read once
    placed = hilbert_order(narrow, {"source": F.col("_source"), "lang": F.col("_lang"), "length": F.log2(F.col("size"))})
    placed = materialize(placed.drop("_source", "_lang"))  # four times read
    return shard_rows(gather(placed, "_hash"), ["curve", "_hash", "doc_id"], shards).drop("_hash")


def shard_statistics(sharded: DataFrame, dims: list[str]) -> DataFrame:
    """Per shard the range of each dimension, as a reader that prunes files would keep it."""
    return sharded.groupBy("shard").agg(F.count("*").alias("rows"), *(f(d).alias(f"{d}_{n}") for d in dims for n, f in (("min", F.min), ("max", F.max))))


def write_sharded(rows: DataFrame, sharded: DataFrame, path: str, key: str = "doc_id") -> None:
    """Write `rows` as one sorted file group for each shard."""
    placed = rows.join(sharded.select(key, "shard", "slot"), key)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op3_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(read_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
        "curve", "source_bucket", "lang_bucket", "length_bucket",
    )
