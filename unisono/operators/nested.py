"""Strings within nested columns rewritten, map keys as well, and derived tables purged by partition."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unisono.sources.shared import cut


def rewrite(col: Column, kind: T.DataType, fn: Callable[[Column], Column]) -> Column:
    """Every string of a column, at any depth, by `fn`. Keys of a map that would become one are an error, never merged; what
    holds no string stays as it is."""
    if isinstance(kind, T.StringType):
        return fn(col)
    if isinstance(kind, T.ArrayType) and holds_strings(kind.elementType):
        return F.transform(col, lambda x: rewrite(x, kind.elementType, fn))
    if isinstance(kind, T.MapType) and (holds_strings(kind.keyType) or holds_strings(kind.valueType)):
        entries = F.transform(F.map_entries(col), lambda e: F.struct(rewrite(e["key"], kind.keyType, fn).alias("key"), rewrite(e["value"], kind.valueType, fn).alias("value")))
        keys = F.transform(entries, lambda e: e["key"])
        one = F.size(F.array_distinct(keys)) == F.size(keys)
        return F.when(one, F.map_from_entries(entries)).when(col.isNotNull(), F.raise_error(F.lit("two keys would become one")).cast(kind))
    if isinstance(kind, T.StructType) and any(holds_strings(f.dataType) for f in kind):
        made = F.struct(*(rewrite(col.getField(f.name), f.dataType, fn).alias(f.name) for f in kind))
        return F.when(col.isNotNull(), made)
    return col


def holds_strings(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return holds_strings(kind.elementType)
    if isinstance(kind, T.MapType):
        return holds_strings(kind.keyType) or holds_strings(kind.valueType)
    if isinstance(kind, T.StructType):
        return any(holds_strings(f.dataType) for f in kind)
    return isinstance(kind, T.StringType)


def redact_rows(df: DataFrame, fn: Callable[[Column], Column], changed: str = "changed") -> DataFrame:
    """`df` with every string rewritten, and whether a row has changed. A column name with dots is one column."""
    made = [rewrite(F.col(f"`{f.name}`"), f.dataType, fn).alias(f.name) for f in df.schema]
    text = lambda cols: F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    before = text([F.col(f"`{f.name}`") for f in df.schema if holds_strings(f.dataType)] or [F.lit(0).alias("_")])
    after = text([m for m, f in zip(made, df.schema, strict=True) if holds_strings(f.dataType)] or [F.lit(0).alias("_")])
    return df.select(*made, (before != after).alias(changed))


def purge(df: DataFrame, path: str, partition: str, bad: Column) -> int:
    """Take the rows for which `bad` holds out of the table at `path`, and return their number. Only partitions that hold one are
    written anew, by overwriting them; the others keep their files as they are."""
    spark = df.sparkSession
    table = spark.read.schema(df.schema).parquet(path)
    found = table.where(bad).groupBy(partition).agg(F.count("*").alias("n"))
    hit = {r[0]: r["n"] for r in found.collect()}  # partitions of one table
    if not hit:
        return 0
    touched = cut(table.where(F.col(partition).isin(*hit)))
    emptied = set(hit) - {r[0] for r in touched.where(~bad | bad.isNull()).select(partition).distinct().collect()}
    touched.where(~bad | bad.isNull()).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    for value in emptied:  # a partition without rows is not overwritten
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{partition}={value}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return sum(hit.values())
