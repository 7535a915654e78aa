"""Intermediate tables the registered queries share, built from one sf folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bedside_spark.functions.timekit import ISO_MICROS, latest
from bedside_spark.operators import alerts, windows
from bedside_spark.sources import derived


def vitals(spark: SparkSession, sf: str) -> DataFrame:
    return derived.vitals(spark, sf)


def as_of(spark: SparkSession, sf: str):
    return latest(derived.table(spark, sf, "events"), "ts")


def vitals_1m(spark: SparkSession, sf: str) -> DataFrame:
    return windows.tumble(derived.readings(spark, sf))


def vitals_hop_1m(spark: SparkSession, sf: str) -> DataFrame:
    return windows.hop(derived.readings(spark, sf))


def stored_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Threshold alerts as stored: a third unset, a third not sent, a third sent."""
    rows = alerts.threshold_alerts(derived.vitals(spark, sf, "event_id"), "event_id")
    third = F.col("event_id") % 3
    sent = F.when(third == 1, F.lit(False)).when(third == 2, F.lit(True))
    return rows.withColumn("sent", sent)


def change_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Change records of the alerts table: operation and tagged new image as VARIANT."""
    stored = stored_alerts(spark, sf)
    fifth = F.col("event_id") % 5
    op = F.when(fifth < 2, "INSERT").when(fifth < 4, "MODIFY").otherwise("REMOVE")

    def number(name: str):
        whole = F.col(name) == F.floor(name)
        text = F.when(whole, F.col(name).cast("bigint").cast("string")).otherwise(
            F.col(name).cast("string")
        )
        return F.struct(text.alias("N"))

    def text(col):
        return F.struct(col.alias("S"))

    image = F.struct(
        *[text(F.col(c)).alias(c) for c in ("patient_id", "alert_id", "rule", "severity")],
        number("value").alias("value"),
        number("threshold").alias("threshold"),
        text(F.date_format("event_ts", ISO_MICROS)).alias("event_ts"),
        F.when(F.col("sent").isNotNull(), F.struct(F.col("sent").alias("BOOL"))).alias("sent"),
    )
    return stored.select(op.alias("op"), F.parse_json(F.to_json(image)).alias("image"))
