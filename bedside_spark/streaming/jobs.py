"""The live job: events, tumbling and hopping summaries from one source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bedside_spark.functions.rules import with_flags
from bedside_spark.operators import windows
from bedside_spark.operators.alerts import threshold_alert_rows
from bedside_spark.sinks.streams import COMMIT_EVERY, append_days

DELAY = "10 seconds"


def watermarked(stream: DataFrame, delay: str = DELAY) -> DataFrame:
    """Event time as an instant with a bounded out-of-orderness watermark."""
    instant = F.col("event_time").cast("timestamp")
    return stream.withColumn("event_time", instant).withWatermark("event_time", delay)


def stream_events(stream: DataFrame) -> DataFrame:
    return with_flags(stream)


def stream_tumble(stream: DataFrame, size: str = windows.MINUTE, delay: str = DELAY) -> DataFrame:
    return windows.tumble(watermarked(stream, delay), size)


def stream_hop(
    stream: DataFrame,
    size: str = windows.MINUTE,
    slide: str = windows.HALF_MINUTE,
    delay: str = DELAY,
) -> DataFrame:
    return windows.hop(watermarked(stream, delay), size, slide)


def stream_dedup(stream: DataFrame, delay: str = DELAY) -> DataFrame:
    """Drop repeats of (patient, device, event time) that arrive within the watermark."""
    return watermarked(stream, delay).dropDuplicatesWithinWatermark(
        ["patient_id", "device_id", "event_time"]
    )


def stream_threshold_alerts(stream: DataFrame, delay: str = DELAY) -> DataFrame:
    """Threshold alerts as they arrive, without repeats of an alert within the watermark."""
    flagged = threshold_alert_rows(watermarked(stream, delay), "event_time")
    # A stream may have one event-time column: the alert's own times become plain values.
    plain = F.timestamp_micros(F.unix_micros("event_time"))
    flagged = flagged.withColumns({"event_ts": plain, "created_at": plain})
    return flagged.dropDuplicatesWithinWatermark(["patient_id", "alert_id"]).drop("event_time")


def stream_enrich(stream: DataFrame, patients: DataFrame, salts: int = 1) -> DataFrame:
    """Readings with the patient's attributes; unknown patients keep NULLs.

    Spark broadcasts the dimension while its size is under
    ``spark.sql.autoBroadcastJoinThreshold``. For a larger one set ``salts``: the dimension
    is repeated per salt and a hot patient's readings spread over that many tasks.
    """
    if salts == 1:
        return stream.join(patients, "patient_id", "left")
    salted = stream.withColumn(
        "_salt", F.pmod(F.xxhash64("trace_id", "event_time"), F.lit(salts)).cast("int")
    )
    repeated = patients.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    return salted.join(repeated, ["patient_id", "_salt"], "left").drop("_salt")


def start_vitals_job(
    stream: DataFrame, root: str, every: str | None = COMMIT_EVERY
) -> list[StreamingQuery]:
    """Three independent queries over the source, each with its own checkpoint."""
    outputs = {
        "vitals": (stream_events(stream), "event_time"),
        "vitals_1m": (stream_tumble(stream), "window_start"),
        "vitals_hop_1m": (stream_hop(stream), "window_start"),
    }
    return [
        append_days(df, time, f"{root}/{name}", f"{root}/_checkpoints/{name}", every)
        for name, (df, time) in outputs.items()
    ]
