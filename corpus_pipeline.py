"""A pipeline over ``documents``: five stages, each reading what the one before it has written.

1. ``language_id``: documents without a recognised language go.
2. ``near_dedup``: of each group of near duplicates the first document stays.
3. ``decontaminate``: documents that hold benchmark passages go.
4. ``mask_secrets``: secrets in the texts are replaced by a mark.
5. ``pack``: what is left is cut and packed into sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import decontaminate, language_id, near_dedup, packing, secret_scan
from clickloom.llm.workers import ready
from clickloom.sources.storage import materialize

PIECES = "piece_bpe_32k.model"
TOKENS = "word_bpe_49k.json"


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops null texts, texts without letters, and texts that no language fits best by far.

    The model is learned from the labelled documents that the stage is given.
    """
    model = language_id.Model.learn(docs, public_tokenizers.path(PIECES))
    return (language_id.predict(docs, model)
            .where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= 0.5))
            .select(*docs.columns))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group; five words, similarity 0.8."""
    found = near_dedup.near_duplicates(docs, near_dedup.Sizes()).where(
        "doc_id is not null and not kept")
    gone = found.select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that overlap with an item of ``benchmark``."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    gone = decontaminate.overlaps(docs, benchmark).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_gone"]), "left_anti")


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts; ``n_chars`` follows."""
    found = secret_scan.masked(secret_scan.find_secrets(docs))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(
            F.size("secrets") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a sequence."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENS))


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", dedup_stage),
    ("decontaminate", decontamination_stage),
    ("mask_secrets", secret_stage),
    ("pack", packing_stage),
]

# SQL expresses neither the sums over segmentations nor the search for near duplicates' seeds; the
# tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
