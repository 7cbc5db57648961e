"""From raw documents to packed training sequences: toxic documents go, lines of many sites go, one of each group of near
copies stays, documents that hold benchmark items go, and the rest is packed.

Every stage works on all that the one before has kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from unisono.llm.common import materialize, read_table
from unisono.llm.decontamination import drop_leaking
from unisono.llm.jaccard_join import BROADCAST_IDS, jaccard_components
from unisono.llm.line_dedup import dedup_lines
from unisono.llm.packing import pack_documents, vocabulary_path
from unisono.llm.toxicity import fit, learn_rows, reject_toxic

#: Near copies share 80 % or more of their shingles of five words.
SHINGLE, PERCENT = 5, 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that score as toxic; labels are learnt from the fold that the operator's query learns from."""
    return reject_toxic(docs, fit(docs, learn_rows(read_table(spark, sf_dir, "labels"))))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take widely spread lines out of the texts; n_chars follows the text. No document goes."""
    out = dedup_lines(docs)
    return out.select(*(F.length("text").cast(docs.schema["n_chars"].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each group of near copies; documents without words have none and stay."""
    groups = jaccard_components(docs, SHINGLE, PERCENT)
    gone = materialize(groups.where("component_id <> doc_id").select("doc_id").distinct())
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, "doc_id", "left_anti").select(*(f"`{c}`" for c in docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return drop_leaking(docs, read_table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens, a row for each piece."""
    return pack_documents(docs, vocabulary_path())


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: No SQL: models, tokenizers and components stand between the tables and the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written as Parquet to the shared folder and read again."""
    out = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, out, sf_dir)
        if i + 1 < len(STAGES):
            out = materialize(out)
    return out
