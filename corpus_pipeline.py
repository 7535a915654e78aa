"""The corpus pipeline: five stages over ``documents``, each on all that the one before kept.

``run`` writes every stage to a folder below ``spark.checkpoint.dir`` and reads it again, so a
lost executor costs tasks of one stage and no stage computes an earlier one anew.

Stages handle nulls in any column, empty and very long texts, repeated rows and empty tables as
their operators define; further columns of ``documents`` pass through to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bedside_spark.llm import leaks, pieces, quality, simhash, substrings
from bedside_spark.llm.frames import ready, table
from bedside_spark.session import work_folder


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    ready(spark)
    return quality.drop_rejected(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    ready(spark)
    return simhash.one_per_group(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur twice are cut out; a text without one stays as it is."""
    ready(spark)
    return substrings.cut_repeated(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return leaks.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, their number, and digests of the ids and of what they decode to."""
    ready(spark)
    return pieces.encode(docs, outputs=(*pieces.DIGESTS, "ids"))


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("sentencepiece", encoding_stage),
]

#: Fingerprints (XXH64) and token ids cannot be had from SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), work_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
