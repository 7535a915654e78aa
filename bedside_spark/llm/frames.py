"""Small DataFrame helpers of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bedside_spark.session import prepare, work_folder


#: Rows and bytes of an Arrow batch: texts may be long, and a batch is held on both sides of the pipe.
BATCH_ROWS, BATCH_BYTES = 2_000, 16 << 20


def ready(spark: SparkSession) -> SparkSession:
    """The session with the engine's settings and batches small enough for whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return prepare(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """``keep`` and the text's UTF-8 bytes as ``body``; other columns cannot clash."""
    return docs.select(*keep, F.col(text).cast("binary").alias("body"))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, its lineage cut."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(work_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder, its lineage cut; smaller than a checkpoint."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder_of_id(id_column: str, divisor: int):
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % divisor
