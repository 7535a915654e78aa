"""Monitoring tables derived from the supplied ``events`` and ``customer`` tables.

Both engines compute the same values from this arithmetic, which is what lets every query
be checked against DuckDB. All of it is column expressions over the scanned table, so
column pruning reaches the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bedside_spark.functions.rules import with_flags
from bedside_spark.functions.timekit import ISO_MICROS
from bedside_spark.operators.ingest import encode_text
from bedside_spark.session import prepare


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly to three tasks a core.

    A scan is split by bytes and row groups, so rows that cost much work and few bytes come in too
    few tasks.
    """
    return df.repartition(3 * df.sparkSession.sparkContext.defaultParallelism)


def padded_id(prefix: str, number: str):
    """Six digits at least; longer numbers stay whole."""
    text = F.col(number).cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.lit(6), F.length(text)), F.lit("0")))


def readings_from(events: DataFrame, *extra: str) -> DataFrame:
    step = F.col("event_id")
    return events.select(
        padded_id("P", "user_id").alias("patient_id"),
        padded_id("bed-", "user_id").alias("device_id"),
        F.col("ts").alias("event_time"),
        (F.col("ts") + F.make_dt_interval(secs=(step * 7919) % 600)).alias("ingestion_time"),
        F.least(F.lit(220.0), F.col("value") + 60).alias("heart_rate"),
        (step % 61 + F.lit(100.0)).alias("systolic_bp"),
        (step % 31 + F.lit(60.0)).alias("diastolic_bp"),
        (100 - F.get_json_object("props", "$.k").cast("int") * F.lit(0.125)).alias("spo2"),
        (step % 25 * F.lit(0.125) + 36).alias("temperature"),
        (step % 19 + F.lit(12.0)).alias("resp_rate"),
        F.md5(step.cast("string")).alias("trace_id"),
        *extra,
    )


def readings(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return readings_from(table(spark, sf_dir, "events"), *extra)


def vitals(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return with_flags(readings(spark, sf_dir, *extra))


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("c_custkey")
    gender = F.element_at(F.array(*map(F.lit, ("M", "F", "NB"))), (number % 3 + 1).cast("int"))
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            padded_id("P", "c_custkey").alias("patient_id"),
            F.substring_index("c_name", "#", 1).alias("first_name"),
            F.substring_index("c_name", "#", -1).alias("last_name"),
            gender.alias("gender"),
            F.date_add(F.lit("1940-01-01").cast("date"), ((number * 97) % 25000).cast("int")).alias(
                "birth_date"
            ),
            F.lit("Not stated").alias("race"),
            F.lit("Not stated").alias("ethnicity"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
            F.lit("Not stated").alias("county"),
        )
    )


def listed_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension without every tenth patient, so that some streamed ids have no match."""
    return patients(spark, sf_dir).where(F.substring("patient_id", -1, 1) != "0")


def raw_payloads(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """(recordId, data) archive records; 9 of every 20 are altered, 2 of those harmlessly."""
    kind = F.col("event_id") % 20
    iso = F.date_format("event_time", ISO_MICROS)
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "props")
    source = readings_from(spread(events), "event_id")
    fields = {
        "patient_id": F.col("patient_id"),
        "device_id": F.col("device_id"),
        "event_time": iso,
        "ingestion_time": F.date_format("ingestion_time", ISO_MICROS),
        "heart_rate": F.col("heart_rate"),
        "systolic_bp": F.col("systolic_bp"),
        "diastolic_bp": F.when(kind != 4, F.col("diastolic_bp")),
        "spo2": F.when(kind != 1, F.col("spo2")),
        "temperature": F.col("temperature"),
        "resp_rate": F.col("resp_rate"),
        "trace_id": F.col("trace_id"),
    }
    # to_json leaves NULL fields out, which is the "missing field" defect.
    whole = F.to_json(F.struct(*[col.alias(name) for name, col in fields.items()]))

    def swapped(field: str, text: str):
        return F.regexp_replace(whole, f'"{field}":[^,}}]*', f'"{field}":{text}')

    text = (
        F.when(kind == 0, F.lit("####not-json####"))
        .when(kind == 2, swapped("heart_rate", '"fast"'))
        .when(kind == 3, swapped("heart_rate", "null"))
        .when(kind == 5, F.lit("[1]"))
        .when(kind == 7, swapped("heart_rate", "true"))
        .when(kind == 8, swapped("spo2", '"98"'))
        .otherwise(whole)
    )
    encoded = encode_text(text)
    data = F.when(kind == 6, F.concat(F.lit("*"), F.substr(encoded, F.lit(2)))).otherwise(
        encoded
    )
    return source.select(
        F.concat(F.lit("rec-"), F.col("event_id").cast("string")).alias("recordId"),
        data.alias("data"),
        *extra,
    )


def declared(schema: StructType, df: DataFrame) -> DataFrame:
    """Project and cast to a declared schema."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
