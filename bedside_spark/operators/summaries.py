"""Queries over the window summaries and table-level totals."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedside_spark.functions.numbers import rounded
from bedside_spark.functions.timekit import micros, moment, truncated


def recent_windows(summary: DataFrame, as_of: datetime | Column, minutes: int = 60) -> DataFrame:
    """Windows that started within the last ``minutes``, newest first."""
    since = moment(as_of) - F.make_dt_interval(mins=F.lit(minutes))
    return (
        summary.where(F.col("window_start") >= since)
        .select("patient_id", "window_start", "avg_heart_rate", "max_heart_rate")
        .orderBy(F.col("window_start").desc_nulls_last(), "patient_id")
    )


def flag_distribution(vitals: DataFrame, as_of: datetime | Column, hours: int = 24) -> DataFrame:
    """How often each rule fired within the last ``hours``."""
    since = moment(as_of) - F.make_dt_interval(hours=F.lit(hours))
    return (
        vitals.where(F.col("event_time") >= since)
        .select(F.explode("abnormal_flags").alias("flag"))
        .groupBy("flag")
        .agg(F.count("*").alias("occurrences"))
        .orderBy(F.col("occurrences").desc(), "flag")
    )


def _window_totals(summary: DataFrame, windowing: str) -> DataFrame:
    return summary.agg(
        F.count("*").alias("windows"),
        F.countDistinct("patient_id").alias("patients"),
        F.sum("reading_count").alias("sampled_readings"),
        F.min("window_start").alias("lo"),
        F.max("window_end").alias("hi"),
    ).select(F.lit(windowing).alias("windowing"), "*")


def windowing_summary(tumbled: DataFrame, hopped: DataFrame) -> DataFrame:
    """Totals of both windowings with the hop : tumble window ratio."""
    # Labels of the two windowings.
    fixed, sliding = "tumbling 1m", "hop 30s/1m"
    both = _window_totals(tumbled, fixed).unionByName(_window_totals(hopped, sliding))
    base = tumbled.agg(F.count("*").cast("double")).scalar()
    factor = F.when(F.col("windowing") == fixed, F.lit(1.0)).otherwise(
        rounded(F.col("windows") / base, 2)
    )
    return both.withColumn("overlap_factor", factor)


def overlap_factor(tumbled: DataFrame, hopped: DataFrame) -> DataFrame:
    """Hop windows per tumbling window, by an uncorrelated scalar subquery."""
    base = tumbled.agg(F.count("*").cast("double")).scalar()
    return hopped.agg(F.count("*").alias("hop_windows")).select(
        "hop_windows", rounded(F.col("hop_windows") / base, 2).alias("overlap_factor")
    )


def window_edge_compare(
    tumbled: DataFrame, hopped: DataFrame, minute: datetime | Column
) -> DataFrame:
    """One tumbling minute next to the hop windows that overlap it."""
    start = moment(minute)
    half = F.make_dt_interval(secs=F.lit(30))

    def side(df: DataFrame, name: str) -> DataFrame:
        return (
            df.groupBy("window_start", "window_end")
            .agg(
                F.countDistinct("patient_id").alias("patients"),
                rounded(F.avg("avg_heart_rate"), 1).alias("avg_hr"),
            )
            .select(F.lit(name).alias("win"), "*")
        )

    exact = tumbled.where(F.col("window_start") == start)
    overlapping = hopped.where(F.col("window_start").between(start - half, start + half))
    return side(exact, "tumbling").unionByName(side(overlapping, "hop"))


def table_counts(**tables: DataFrame) -> DataFrame:
    """(table_name, rows) inventory."""
    out = None
    for name, df in tables.items():
        rows = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = rows if out is None else out.unionByName(rows)
    return out


def average_peak(summary: DataFrame) -> DataFrame:
    return summary.agg(rounded(F.avg("max_heart_rate"), 6).alias("avg_max_hr"))


def readings_per_patient(vitals: DataFrame) -> DataFrame:
    return vitals.groupBy("patient_id").agg(F.count("*").alias("readings"))


def window_totals(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count("*").alias("windows"),
        F.coalesce(F.sum("reading_count"), F.lit(0)).alias("readings"),
    )


def first_windows(summary: DataFrame, count: int = 5) -> DataFrame:
    return summary.orderBy("window_start", "patient_id").limit(count)


def _chart(summary: DataFrame, **metrics: Column) -> DataFrame:
    minute = truncated(summary, "window_start", "minute").alias("minute")
    return summary.groupBy(minute, "patient_id").agg(
        *[metric.alias(name) for name, metric in metrics.items()]
    )


def chart_heart_rate(summary: DataFrame) -> DataFrame:
    return _chart(
        summary, avg_hr=rounded(F.avg("avg_heart_rate"), 6), max_hr=F.max("max_heart_rate")
    )


def chart_min_spo2(summary: DataFrame) -> DataFrame:
    return _chart(summary, min_spo2=F.min("min_spo2"))


def chart_readings(summary: DataFrame) -> DataFrame:
    return _chart(summary, total_readings=F.sum("reading_count"))


def daily_operations(vitals: DataFrame, alerts: DataFrame, routed: DataFrame) -> DataFrame:
    """Readings, alerts written and sent, and dropped archive records per day.

    ``routed`` holds (day, result) of the ingest step. The inputs are counted per day
    before they meet, so the union is a few rows per day.
    """

    def counted(df: DataFrame, day: Column, **metrics: Column) -> DataFrame:
        return df.groupBy(day.alias("day")).agg(*[m.alias(n) for n, m in metrics.items()])

    parts = [
        counted(vitals, F.to_date("event_time"), readings=F.count("*")),
        counted(
            alerts,
            F.to_date("event_ts"),
            alerts_written=F.count("*"),
            alerts_sent=F.count_if(F.col("sent")),
        ),
        counted(routed, F.col("day"), dropped=F.count_if(F.col("result") == "Dropped")),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    names = ("readings", "alerts_written", "alerts_sent", "dropped")
    return union.groupBy("day").agg(
        *[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in names]
    )


def ingest_latency(vitals: DataFrame, target_seconds: float = 60.0) -> DataFrame:
    """95th percentile of ingestion delay per day against the target.

    Delays are counted per (day, millisecond) first, so the exact percentile works on a
    histogram whose size depends on the spread of delays and not on the row count.
    """
    delay_ms = F.floor((micros("ingestion_time") - micros("event_time")) / 1000)
    histogram = (
        vitals.where(F.col("ingestion_time").isNotNull())
        .groupBy(F.to_date("event_time").alias("day"), delay_ms.alias("_delay"))
        .agg(F.count("*").alias("_rows"))
    )
    p95 = F.percentile("_delay", 0.95, F.col("_rows")) / 1000
    return histogram.groupBy("day").agg(
        F.sum("_rows").alias("readings"),
        rounded(p95, 3).alias("p95_seconds"),
        (p95 <= target_seconds).alias("within_target"),
    )
