"""From raw documents to encoded ones: five stages, each over all that its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)``. All but the last return the columns
of ``documents``; null or empty texts, repeated rows and empty tables pass through
as each operator states.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.decontamination import judged_rows
from tessera.llm.lines import dedup_lines
from tessera.llm.minhash import near_duplicates
from tessera.llm.pieces import encode_decode
from tessera.llm.quality import keep_quality
from tessera.llm.registry import table
from tessera.workspace import materialize

PIECES = public_tokenizers.path("piece_bpe_32k.model")

# SQL cannot express the measures of a vocabulary, nor its merges.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, those without text among them."""
    return keep_quality(docs, PIECES)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later matches of a line go; a document goes with its last line. ``n_chars`` follows."""
    left = dedup_lines(docs)
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        left = left.withColumn("n_chars", F.coalesce(size, F.col("n_chars")))
    return left


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays; rows of one id stay together."""
    gone = (
        near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias("__id")).distinct()
    )
    return docs.join(gone, F.col("doc_id") == F.col("__id"), "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    gone = (
        judged_rows(docs, table(spark, sf_dir, "benchmark"))
        .where("contaminated")
        .select(F.col("doc_id").alias("__id"), F.col("content").alias("__content"))
        .distinct()
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    same = (F.xxhash64(text) == F.col("__content")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    return docs.join(gone, same, "left_anti")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document that is left, and the round trip through them."""
    return encode_decode(docs, PIECES)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
