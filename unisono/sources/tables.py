"""Readers, sinks, and the adapter from the driver's tables to statements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from unisono.functions.text import congress_of, fold_space, is_syndicated
from unisono.schemas import RAW_RECORD


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal a scan of fewer splits than cores to all cores; larger inputs are left as they are read, without an exchange."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_jsonl(spark: SparkSession, path, schema=RAW_RECORD) -> DataFrame:
    """JSON lines, plain or gzip; lines that don't parse are left out (see `bad_lines`)."""
    rows = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    return rows.where("_corrupt_record is null").drop("_corrupt_record") if "_corrupt_record" in rows.columns else rows


def bad_lines(spark: SparkSession, path, schema=RAW_RECORD) -> DataFrame:
    rows = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    return rows.select(F.input_file_name().alias("file"), F.col("_corrupt_record").isNotNull().cast("long").alias("bad")).groupBy("file").agg(F.sum("bad").alias("bad"))


def read_json(spark: SparkSession, path) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def read_xml(spark: SparkSession, path, row_tag: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).load(path)


def read_delimited(spark: SparkSession, path, sep: str | None = None) -> DataFrame:
    """A header line names the columns; without `sep`, the most frequent of comma, tab, semicolon and bar in it is taken."""
    if sep is None:
        head = spark.read.text(path).limit(1).first()
        sep = max(",\t;|", key=(head[0] if head else "").count)
    return spark.read.option("header", True).option("sep", sep).csv(path)


def provenance(spark: SparkSession, path) -> DataFrame:
    """Name, length and content hash of each file."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


def write_jsonl(df: DataFrame, path: str, compress: bool = False) -> None:
    df.write.mode("overwrite").option("compression", "gzip" if compress else "none").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_days(df: DataFrame, path: str, final_days: DataFrame, by: str = "day") -> None:
    """Overwrite the partitions of days that aren't final; final ones stay as they are."""
    open_days = df.join(final_days.select(by), by, "left_anti")
    open_days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def envelope(df: DataFrame, resource: str) -> DataFrame:
    """Each row as JSON in an envelope with its content hash."""
    body = F.to_json(F.struct(*(df[c] for c in sorted(df.columns))))
    return df.select(F.lit(resource).alias("resource"), body.alias("body"), F.sha2(body, 256).alias("sha256"))


def verify_envelope(df: DataFrame) -> DataFrame:
    return df.withColumn("valid", F.sha2("body", 256) == F.col("sha256"))


def atom_entries(phrases: DataFrame, terms: list[str], link: str = "") -> DataFrame:
    """Feed entries of phrases that contain a term, newest day first."""
    low = F.lower("ngram")
    hit = F.exists(F.array(*(F.lit(t.lower()) for t in terms)), lambda t: F.contains(low, t)) if terms else F.lit(False)
    entry = F.concat(F.lit("<entry><id>"), F.sha2(F.concat_ws("|", "day", "ngram"), 256), F.lit("</id><title>"), F.replace(F.replace("ngram", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(f"</title><link href=\"{link}\"/></entry>"))
    return phrases.where(hit).select("day", "ngram", entry.alias("entry")).orderBy(F.desc("day"), "ngram")


def statements_from_documents(docs: DataFrame) -> DataFrame:
    """The driver's documents as statements of offices (sources) of two parties over thirty days."""
    no = F.expr("cast(substr(source, 4) as int)")
    day = F.expr("date_add(date '2024-01-01', cast((doc_id div 20) % 30 as int))")
    return docs.select(
        "doc_id",
        F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("id"),
        F.col("source").alias("bioguide"),
        F.when(no % 2 == 0, "D").otherwise("R").alias("party"),
        day.alias("day"),
        F.when(F.col("doc_id") % 37 == 0, 2).otherwise(1).alias("lane"),
        F.concat(F.lit("S"), (no % 5).cast("string")).alias("state"),
        F.when(no % 4 < 2, "house").otherwise("senate").alias("chamber"),
        F.when(day < F.lit("2024-01-16").cast("date"), "legacy").otherwise("scraper").alias("date_source"),
        congress_of(day).alias("congress"),
        F.element_at(F.split("text", "\n"), 1).alias("title"),
        "text",
        is_syndicated(F.col("text")).alias("syndicated"),
    )


def joint_key(day: Column, text: Column) -> Column:
    """Signature of an exact joint release: day and case- and space-folded text."""
    return F.sha2(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("\u0000"), F.lower(fold_space(text))), 256)


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statements_from_documents(spread(table(spark, sf_dir, "documents")))
