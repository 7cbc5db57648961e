"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir; under one of our own only where that is unset (tests)."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", "") or tempfile.mkdtemp())
    return f"{spark.sparkContext.getCheckpointDir()}/cut-{uuid.uuid4().hex}"


def cut(df: DataFrame, group: int | None = None) -> DataFrame:
    """`df` written to spark.checkpoint.dir and read again: its lineage ends, and it is computed once, where checkpoint()
    would compute it twice. A folder of our own is taken only where that is unset (tests). Row groups have `group` bytes, if given, so
    that `splits` can part them."""
    spark = df.sparkSession
    path = shared_folder(spark)
    (df.write.option("parquet.block.size", group) if group else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def splits(spark: SparkSession, most: int):
    """What runs meanwhile reads files in splits of `most` bytes."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def drop(df: DataFrame) -> None:
    """Delete the files of a table that `cut` wrote and nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if re.search(r"/cut-[0-9a-f]{32}$", folder):
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, rows: int) -> DataFrame:
    """`df`, a table in the shared folder, to be broadcast if it has at most `rows` rows; otherwise joins exchange it."""
    return F.broadcast(df) if df.count() <= rows else df
