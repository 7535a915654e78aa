"""Time-series queries over single readings: buckets, deltas, averages, rolling statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bedside_spark.functions.numbers import rounded
from bedside_spark.functions.timekit import bucketed, micros, seconds_between, truncated
from bedside_spark.operators.ordered import (
    HOT_ROWS,
    own_rows,
    running,
    slice_window,
    with_neighbours,
    with_slices,
)

ORDER = ("event_time", "trace_id")


def newest(columns: list[str]) -> Column:
    """The row with the greatest (event_time, trace_id), as a struct; combines map-side."""
    return F.max_by(F.struct(*columns), F.struct(*ORDER))


def time_bucketing(vitals: DataFrame) -> DataFrame:
    """Readings, average HR, lowest SpO2 and average SBP per patient and minute."""
    minute = truncated(vitals, "event_time", "minute")
    return (
        vitals.groupBy("patient_id", minute.alias("bucket_ts"))
        .agg(
            F.count("*").alias("readings"),
            rounded(F.avg("heart_rate"), 1).alias("avg_hr"),
            F.min("spo2").alias("min_spo2"),
            rounded(F.avg("systolic_bp"), 1).alias("avg_sbp"),
        )
        .select(
            "patient_id",
            "bucket_ts",
            F.hour("bucket_ts").cast("bigint").alias("hour_of_day"),
            (F.weekday("bucket_ts") + 1).cast("bigint").alias("day_of_week"),
            "readings",
            "avg_hr",
            "min_spo2",
            "avg_sbp",
        )
    )


def latest_per_patient(vitals: DataFrame, columns: list[str]) -> DataFrame:
    """The newest reading of each patient, by partial aggregation rather than a sort."""
    return (
        vitals.groupBy("patient_id")
        .agg(newest(columns).alias("_row"))
        .select("patient_id", "_row.*")
    )


def latest_per_bucket(vitals: DataFrame, width: str = "1 minute") -> DataFrame:
    """The newest reading of each patient in each ``width`` bucket."""
    return (
        vitals.groupBy("patient_id", bucketed("event_time", width).alias("bucket_ts"))
        .agg(newest(["heart_rate", "event_time"]).alias("_row"))
        .select(
            "patient_id",
            "bucket_ts",
            F.col("_row.heart_rate").alias("last_hr"),
            F.col("_row.event_time").alias("event_time"),
        )
    )


def lag_lead(
    vitals: DataFrame, min_swing: float = 5.0, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Previous and next heart rate per device, keeping swings of at least ``min_swing``."""
    columns = vitals.select("patient_id", "device_id", "heart_rate", *ORDER)
    sliced = with_slices(columns, "device_id", "event_time", hot_rows)
    ordered = slice_window("device_id", ORDER)
    seen = own_rows(
        with_neighbours(sliced, "device_id", ORDER, before=1, after=1).withColumns(
            {
                "_previous": F.lag("heart_rate").over(ordered),
                "_next": F.lead("heart_rate").over(ordered),
            }
        )
    )
    change = F.col("heart_rate") - F.col("_previous")
    return seen.select(
        "patient_id",
        "device_id",
        truncated(vitals, "event_time", "second").alias("at_ts"),
        rounded("heart_rate", 0).alias("hr_now"),
        rounded("_previous", 0).alias("hr_prev"),
        rounded("_next", 0).alias("hr_next"),
        rounded(change, 1).alias("delta"),
        rounded(change * 100.0 / F.greatest(F.col("_previous"), F.lit(1e-9)), 2).alias(
            "pct_change"
        ),
        *ORDER,
    ).where(F.abs("delta") >= min_swing)


def moving_average(vitals: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Trailing three-reading and centred five-reading averages per patient."""
    columns = vitals.select("patient_id", "device_id", "heart_rate", "spo2", *ORDER)
    sliced = with_slices(columns, "patient_id", "event_time", hot_rows)
    ordered = slice_window("patient_id", ORDER)
    trailing, centred = ordered.rowsBetween(-2, 0), ordered.rowsBetween(-2, 2)
    averaged = own_rows(
        with_neighbours(sliced, "patient_id", ORDER, before=2, after=2).withColumns(
            {
                "hr_ma3_trailing": rounded(F.avg("heart_rate").over(trailing), 1),
                "hr_ma5_centred": rounded(F.avg("heart_rate").over(centred), 1),
                "spo2_trailing_min": rounded(F.min("spo2").over(trailing), 1),
            }
        )
    )
    return averaged.select(
        "patient_id",
        "device_id",
        truncated(vitals, "event_time", "second").alias("at_ts"),
        rounded("heart_rate", 0).alias("hr"),
        "hr_ma3_trailing",
        "hr_ma5_centred",
        "spo2_trailing_min",
        *ORDER,
    )


def running_totals(vitals: DataFrame) -> DataFrame:
    """Cumulative readings per patient-minute and their share of the patient's total.

    The windows run on minute counts, so a patient contributes at most one row per minute
    of the observed time, however many readings there are.
    """
    minutes = vitals.groupBy(
        "patient_id", truncated(vitals, "event_time", "minute").alias("bucket_ts")
    ).agg(F.count("*").alias("readings"))
    patient = Window.partitionBy("patient_id")
    so_far = patient.orderBy("bucket_ts").rowsBetween(Window.unboundedPreceding, 0)
    cumulative = F.sum("readings").over(so_far)
    share = 100.0 * cumulative.cast("double") / F.sum("readings").over(patient)
    return minutes.select(
        "patient_id",
        "bucket_ts",
        "readings",
        cumulative.alias("cumulative"),
        rounded(share, 1).alias("pct_of_session"),
    )


def data_gaps(
    vitals: DataFrame, threshold_seconds: float, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Silences longer than the threshold between consecutive readings of a patient."""
    columns = vitals.select("patient_id", *ORDER)
    sliced = with_slices(columns, "patient_id", "event_time", hot_rows)
    previous = F.lag("event_time").over(slice_window("patient_id", ORDER))
    seen = own_rows(
        with_neighbours(sliced, "patient_id", ORDER, before=1).withColumn("gap_start", previous)
    )
    return seen.select(
        "patient_id",
        "gap_start",
        F.col("event_time").alias("gap_end"),
        seconds_between("gap_start", "event_time").alias("gap_seconds"),
    ).where(F.col("gap_seconds") > threshold_seconds)


def _trailing(
    vitals: DataFrame, seconds: int, sums: dict[str, Column], hot_rows: int
) -> DataFrame:
    """Sums over each reading's trailing ``[t - seconds, t]`` range, peers included.

    A reading enters the range at its own time and leaves just after ``time + seconds``:
    two signed rows and one running sum, so the work per reading does not depend on how
    many readings a range holds. The sums must be exact types, as they are differences.
    """
    kept = ["patient_id", *ORDER, *[c for c in vitals.columns if c.startswith("_at_")]]
    entering = vitals.select(
        "patient_id",
        F.col("event_time").alias("_time"),
        F.lit(0).alias("_leaves"),
        F.struct(*kept[1:], *_payload(vitals, kept)).alias("_row"),
        *[col.alias(name) for name, col in sums.items()],
    )
    leaving = entering.withColumns(
        {
            "_time": F.col("_time") + F.make_dt_interval(secs=F.lit(seconds)),
            "_leaves": F.lit(1),
            "_row": F.lit(None).cast(entering.schema["_row"].dataType),
            **{name: -F.col(name) for name in sums},
        }
    )
    both = with_slices(entering.unionByName(leaving), "patient_id", "_time", hot_rows)
    totals = running(
        both,
        "patient_id",
        ("_time", "_leaves"),
        {f"_in_{name}": ("sum", F.col(name)) for name in sums},
        peers=True,
    )
    return totals.where("_leaves = 0").select(
        "patient_id", "_row.*", *[f"_in_{name}" for name in sums]
    )


def _payload(vitals: DataFrame, kept: list[str]) -> list[str]:
    return [c for c in vitals.columns if c not in kept]


def rolling_average(
    vitals: DataFrame, seconds: int = 3600, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Average heart rate over each reading's trailing hour.

    Summed as decimals of ``AVERAGE_DECIMALS`` places, which a double below 1000 does not exceed
    in precision; a value that no such decimal can hold counts as unknown.
    """
    columns = vitals.select("patient_id", *ORDER, "heart_rate")
    exact = F.col("heart_rate").try_cast(AVERAGE_DECIMALS)
    known = F.when(exact.isNotNull(), 1).otherwise(0).cast("bigint")
    totals = _trailing(columns, seconds, {"hr": exact, "n": known}, hot_rows)
    return totals.select(
        "patient_id",
        "event_time",
        "trace_id",
        "heart_rate",
        (F.col("_in_hr").cast("double") / F.nullif(F.col("_in_n"), F.lit(0))).alias("rolling_avg_hr"),
    )


def rolling_slope(vitals: DataFrame, seconds: int = 900, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Least-squares heart-rate slope (bpm per minute) over each reading's trailing range.

    Moments are summed as decimals of microseconds since 2020 and of millionths of a beat, and
    moved to the reading's own time before the division, which keeps the double arithmetic
    small. Digits of a heart rate after the sixth are rounded; a value too large for the
    decimal counts as unknown.
    """
    columns = vitals.select("patient_id", *ORDER, "heart_rate").where(
        F.col("heart_rate").try_cast(SLOPE_DECIMALS).isNotNull()
    )
    x = (micros("event_time") - F.lit(ORIGIN_MICROS)).cast("decimal(19,0)")
    y = F.col("heart_rate").cast(SLOPE_DECIMALS)
    sums = {
        "n": F.lit(1).cast("bigint"),
        "x": x,
        "y": y,
        "xy": (x * y).cast("decimal(31,6)"),
        "xx": (x * x).cast("decimal(38,0)"),
    }
    totals = _trailing(columns, seconds, sums, hot_rows)
    return totals.select(
        "patient_id",
        "event_time",
        "trace_id",
        "heart_rate",
        recentred_slope(micros("event_time") - F.lit(ORIGIN_MICROS)).alias("slope"),
    )


ORIGIN_MICROS = 1_577_836_800_000_000
AVERAGE_DECIMALS = "decimal(22,12)"
SLOPE_DECIMALS = "decimal(12,6)"
_MICROS_PER_MINUTE = 60_000_000.0


def recentred_slope(centre: Column) -> Column:
    """Slope per minute from the ``_in_*`` moments, with x measured from ``centre``.

    Numerator and denominator are exact; NULL when all readings share one instant.
    """

    def exact(col: Column, scale: int = 0) -> Column:
        return col.cast(f"decimal(38,{scale})")

    n, sx, sy = exact(F.col("_in_n")), F.col("_in_x"), F.col("_in_y")
    c = centre.cast("decimal(19,0)")
    x = exact(sx - exact(n * c))
    xy = exact(F.col("_in_xy") - exact(sy * c, 6), 6)
    xx = exact(F.col("_in_xx") - exact(sx * c * 2) + exact(n * exact(c * c)))
    spread = exact(n * xx) - exact(x * x)
    rise = exact(n * xy, 6) - exact(x * sy, 6)
    return F.when(
        spread != 0, rise.cast("double") / spread.cast("double") * _MICROS_PER_MINUTE
    )
