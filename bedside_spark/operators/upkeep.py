"""Duplicates, late readings and retention."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bedside_spark.functions.timekit import micros, moment

READING_KEY = ("patient_id", "device_id", "event_time")


def dedup_readings(vitals: DataFrame) -> DataFrame:
    """One row per (patient, device, event time): the first to arrive survives."""
    rest = [c for c in vitals.columns if c not in READING_KEY]
    first = F.min_by(F.struct(*rest), F.struct("ingestion_time", "trace_id"))
    return (
        vitals.groupBy(*READING_KEY)
        .agg(first.alias("_row"))
        .select(*READING_KEY, "_row.*")
        .select(*vitals.columns)
    )


def with_lateness(
    vitals: DataFrame,
    window_seconds: int = 60,
    delay_seconds: int = 10,
    span_seconds: int = 60,
    before: int | None = None,
) -> DataFrame:
    """Readings with ``seconds_late``: how long their window was closed when they arrived, or null.

    The watermark before a reading is the greatest event time that arrived earlier, less the
    delay. That running maximum has no key, so it is taken inside spans of the arrival time, and
    what the spans before hold is added: one row per span is ordered globally, never readings.
    ``before`` is the greatest event time, in microseconds, that arrived before all of these.
    """
    width, span = window_seconds * 1_000_000, span_seconds * 1_000_000
    readings = vitals.withColumn("_span", F.floor(micros("ingestion_time") / F.lit(span)))
    earlier = Window.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = readings.groupBy("_span").agg(F.max(micros("event_time")).alias("_newest"))
    carries = spans.select("_span", F.max("_newest").over(earlier).alias("_carry"))
    inside = Window.partitionBy("_span").orderBy("ingestion_time", "trace_id")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    seen = readings.withColumn("_inside", F.max(micros("event_time")).over(inside))
    newest = F.greatest("_inside", "_carry", F.lit(before).cast("bigint"))
    closes = (F.floor(micros("event_time") / width) + 1) * width
    late = newest - delay_seconds * 1_000_000 - closes
    return (
        seen.join(carries, "_span")
        .withColumn("seconds_late", F.when(late >= 0, late / F.lit(1e6)))
        .select(*vitals.columns, "seconds_late")
    )


def late_readings(
    vitals: DataFrame,
    window_seconds: int = 60,
    delay_seconds: int = 10,
    span_seconds: int = 60,
) -> DataFrame:
    """Readings whose window was already closed when they arrived."""
    readings = vitals.select("patient_id", "event_time", "ingestion_time", "trace_id")
    judged = with_lateness(readings, window_seconds, delay_seconds, span_seconds)
    return judged.where("seconds_late is not null")


def apply_retention(
    df: DataFrame, time: str, as_of: datetime | Column, days: int
) -> DataFrame:
    """Rows that are not older than ``days``; on a day-partitioned table whole days drop out."""
    return df.where(F.col(time) >= moment(as_of) - F.make_dt_interval(days=F.lit(days)))
