"""Ranks and running sums over whole tables without one task for all rows.

Rows are dealt by ranges of their order, summed within each range, and each range starts from the sums of the ranges before it: one
row a range. Equal values are counted first, so that a value of very many rows is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from unisono.sources.shared import cut


def running(df: DataFrame, order: list[str], value: str, name: str = "before") -> DataFrame:
    """`df` with the sum of `value` over the rows before each, in the order of `order`, whose values should tell rows apart."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    sums = ranged.groupBy("_part").agg(F.sum(value).alias("_sum"))  # a row for each range
    start = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_start")
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    told = ranged.withColumn("_own", F.coalesce(F.sum(value).over(within), F.lit(0))).join(F.broadcast(start), "_part")
    return told.withColumn(name, F.col("_start") + F.col("_own")).drop("_part", "_own", "_start")


def row_numbers(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """`df` with a number from 1 for each row in the order of `order`; of rows equal there, in any order."""
    one = df.withColumn("_one", F.lit(1).cast("long"))
    return running(one, order, "_one", name).drop("_one").withColumn(name, F.col(name) + 1)


def value_ranks(df: DataFrame, value: str, by: tuple[str, ...] = (), **sums: Column) -> DataFrame:
    """(*by, value, n, before, *sums): each distinct value with its rows, the rows of its group before it, and further sums. The mean rank
    of its rows is before + (n + 1) / 2. Null values have no rank."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"), *(c.alias(k) for k, c in sums.items()))
    if not by:
        return running(counted, [value], "n")
    whole = cut(running(counted, [*by, value], "n"))
    base = whole.groupBy(*by).agg(F.min("before").alias("_base"))
    same = [F.col(f"w.{b}").eqNullSafe(F.col(f"b.{b}")) for b in by]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return whole.alias("w").join(base.alias("b"), cond).select(*(f"w.{c}" for c in whole.columns if c != "before"), (F.col("before") - F.col("_base")).alias("before"))
