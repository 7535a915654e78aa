"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedside_spark.llm.frames import remainder_of_id


def labelled_ids(labels: DataFrame, label: str, divisor: int, held_out: int, most: int) -> DataFrame:
    """(doc_id, label, turn) of at most ``most`` labelled ids that are not held out.

    The ids with the smallest hashes are taken, so the sample is the same wherever it runs. An id
    labelled more than once takes the greatest label.
    """
    train = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).where(
        remainder_of_id("doc_id", divisor) != held_out
    )
    once = train.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    return once.withColumn("turn", F.xxhash64("doc_id")).orderBy("turn", "doc_id").limit(most)


