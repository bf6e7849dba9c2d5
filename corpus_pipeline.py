"""A corpus from raw documents to packed sequences, in stages that each read what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from isobar.llm import common, packing, quality, simhash, suffix


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects (score below 0.3) go."""
    return quality.keep_good(docs, common.table(spark, sf_dir, "labels"), threshold=0.3)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: five-word shingles, a similarity of 0.8 or more."""
    return simhash.simhash_dedup(docs, shingle=5, min_similarity=0.8)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes or more that occur more than once go; every document stays, with what is left of it."""
    return suffix.without_repeats(docs, threshold=200, count_col="n_chars")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    return packing.pack(docs, common.tokenizer_path("byte_bpe_50k.json"), end_id=0, capacity=1024)


STAGES = [("quality", quality_stage), ("near_dedup", near_dedup_stage), ("repeats", repeats_stage), ("packing", packing_stage)]
#: Tokenizers, trained models and byte strings cannot be expressed in SQL; tests replay the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; each result is written to the shared folder and read again, and goes when the next one stands."""
    docs, at, before = common.table(spark, sf_dir, "documents"), common.scratch_path(spark, "pipeline"), None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{at}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            common.remove(spark, before)
        before = path
    return docs
