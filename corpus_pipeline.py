"""Corpus pipeline over ``documents``; counted as part of ``propal.llm``.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet
and read again as the next stage's ``docs``.  All stages but the last return
rows of ``docs`` with all their columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from propal.llm import bpe, decontaminate, exact_dedup, quality, simhash
from propal.llm.common import table
from propal.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    return exact_dedup.keep_owners(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the smallest doc_id stays."""
    return simhash.keep_first(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of ``benchmark`` go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document: number and hash of its ids, hash of the decoded bytes."""
    return bpe.round_trip(docs, bpe.public_vocabulary(spark))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("SimHash near-dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("byte-level BPE", encode_stage),
]

#: Fitted classifiers, fingerprints, alignments and byte-pair merges cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a written table between two stages, in
    the folder that the cluster shares."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = scratch_path(spark, f"stage{k}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
