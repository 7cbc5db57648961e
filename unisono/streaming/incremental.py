"""Incremental state: deduplicated appends, memo tables, and the ledger's daily counts as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unisono.sources.shared import shared_folder


def append_new(existing: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """`existing` and those of `rows` whose key it lacks, each key once."""
    return existing.unionByName(rows.dropDuplicates(key).join(existing.select(*key), key, "left_anti"))


def pending(rows: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    return rows.join(done.select(*key), key, "left_anti")


def unscanned(rows: DataFrame, memo: DataFrame, version: str) -> DataFrame:
    """Rows whose text the memo doesn't know as clean under this version of the instrument."""
    clean = memo.where(F.col("version") == version).select("text_hash").distinct()
    return rows.withColumn("text_hash", F.sha2("text", 256)).join(clean, "text_hash", "left_anti")


def event_stream(spark: SparkSession, path: str, schema, names: str = "*.parquet") -> DataFrame:
    """Files of a folder as a stream of events with an event time `ts`."""
    return spark.readStream.schema(schema).option("pathGlobFilter", names).parquet(path)


def daily_units(events: DataFrame, late: str = "2 days") -> DataFrame:
    """Distinct units by day and phrase. State is bounded by the watermark: first duplicates go, then rows are counted."""
    rows = events.withWatermark("ts", late).withColumn("day", F.date_trunc("day", "ts"))
    once = rows.dropDuplicatesWithinWatermark(["day", "phrase", "unit"])
    return once.groupBy(F.window("ts", "1 day").alias("w"), "phrase").agg(F.count("*").alias("units")).select(F.to_date("w.start").alias("day"), "phrase", "units")


def sliding_counts(events: DataFrame, late: str = "2 days") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", "7 days", "1 day").alias("w"), "phrase").agg(F.count("*").alias("n")).select(F.to_date("w.start").alias("start"), "phrase", "n")


def session_bursts(events: DataFrame, gap: str = "6 hours", late: str = "2 days") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "unit").agg(F.count("*").alias("n")).select("unit", F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "n")


def by_batch(stream: DataFrame, path: str, checkpoint: str, mode: str = "update", each: Callable[[DataFrame, int], None] | None = None) -> None:
    """Run a stream over what is there, each batch a folder of its own under `path`, in the shared store.

    The folder's name is the batch's number and a batch that is run again, after a failure between its write and its commit, overwrites what it
    wrote: nothing is lost or doubled. `each` is called after the write.
    """

    def put(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch}")
        if each:
            each(df, batch)

    stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def batches(spark: SparkSession, path: str, schema) -> DataFrame:
    """What `by_batch` wrote, with the number of the batch."""
    return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/batch=*").select("*", F.col("batch").cast("long").alias("_b")).drop("batch").withColumnRenamed("_b", "batch")


def drain(stream: DataFrame, key: list[str], mode: str = "update") -> DataFrame:
    """Run a stream over what is there and return the final state of its result: the last row of each key or, in complete mode (whose keys may
    merge, as sessions do), the last batch. All of it is in the shared folder, nothing in the driver."""
    spark = stream.sparkSession
    base = shared_folder(spark)
    by_batch(stream, f"{base}/rows", f"{base}/checkpoint", mode)
    rest = [c for c in stream.columns if c not in key]
    rows = batches(spark, f"{base}/rows", stream.schema)
    if mode == "complete":
        last = rows.agg(F.max("batch")).first()[0]
        return rows.where(F.col("batch") == last).drop("batch")
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch").alias("_v")).select(*(F.col(c) if c in key else F.col(f"_v.{c}").alias(c) for c in stream.columns))
