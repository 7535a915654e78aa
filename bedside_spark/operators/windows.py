"""Tumbling and hopping per-patient summaries, usable on batch and streaming input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MINUTE = "1 minute"
HALF_MINUTE = "30 seconds"

_HOP_COLUMNS = ("avg_heart_rate", "max_heart_rate", "min_spo2", "reading_count")
_TUMBLE_COLUMNS = (*_HOP_COLUMNS[:3], "max_systolic_bp", "reading_count")


def _summarise(df: DataFrame, span: Column, names: tuple[str, ...]) -> DataFrame:
    summary = {
        "avg_heart_rate": F.avg("heart_rate"),
        "max_heart_rate": F.max("heart_rate"),
        "min_spo2": F.min("spo2"),
        "max_systolic_bp": F.max("systolic_bp"),
        "reading_count": F.count("*"),
    }
    return (
        df.groupBy(span.alias("_span"), "patient_id")
        .agg(*[summary[name].alias(name) for name in names])
        .select(
            F.col("_span.start").alias("window_start"),
            F.col("_span.end").alias("window_end"),
            "patient_id",
            *names,
        )
    )


def tumble(df: DataFrame, size: str = MINUTE) -> DataFrame:
    """One row per patient and window; every reading belongs to exactly one window."""
    return _summarise(df, F.window("event_time", size), _TUMBLE_COLUMNS)


def hop(df: DataFrame, size: str = MINUTE, slide: str = HALF_MINUTE) -> DataFrame:
    """Overlapping windows; every reading belongs to ``size / slide`` of them."""
    return _summarise(df, F.window("event_time", size, slide), _HOP_COLUMNS)
