"""The feature table for model training: windows, labels and the split by patient."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bedside_spark.functions.timekit import micros
from bedside_spark.operators.patients import age_years
from bedside_spark.operators.timeseries import (
    AVERAGE_DECIMALS,
    ORIGIN_MICROS,
    SLOPE_DECIMALS,
    recentred_slope,
)

# Split shares and the seed that orders the patients.
TRAIN_SHARE, VAL_SHARE = 0.7, 0.15
SPLIT_SEED = "42"
Z_LIMIT = 3.0
_BUCKET_DIGITS = 3


def split_by_patient(ids: DataFrame, seed: str = SPLIT_SEED) -> DataFrame:
    """(patient_id, split): the first 70 % by seeded hash train, the next 15 % validate.

    The exact position needs a global order. The leading hash digits cut the ids into 4096
    even groups; group sizes give each group its offset, and ids are ordered within a
    group only. The offsets (4096 rows at most) are all that is broadcast.
    """
    hashed = (
        ids.select("patient_id")
        .where("patient_id is not null")
        .distinct()
        .withColumn("_hash", F.md5(F.concat(F.lit(f"{seed}:"), F.col("patient_id"))))
        .withColumn("_group", F.substring("_hash", 1, _BUCKET_DIGITS))
    )
    sizes = hashed.groupBy(F.col("_group").alias("_sized")).agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_sized").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_sized").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = sizes.select(
        "_sized",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_size").over(everything).alias("_total"),
    )
    within = F.row_number().over(Window.partitionBy("_group").orderBy("_hash", "patient_id"))
    index = F.col("_offset") + F.col("_within") - 1
    train = F.floor(F.col("_total") * F.lit(TRAIN_SHARE))
    val = train + F.floor(F.col("_total") * F.lit(VAL_SHARE))
    return (
        hashed.withColumn("_within", within)
        .join(F.broadcast(offsets), F.col("_group") == F.col("_sized"))
        .select(
            "patient_id",
            F.when(index < train, "train").when(index < val, "val").otherwise("test").alias(
                "split"
            ),
        )
    )


def split_counts(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count("*").alias("patients"))


def _outlier(value: Column, mean: Column, spread: Column) -> Column:
    z = F.abs(value - mean) / F.when(spread > 0, spread)
    return F.coalesce(z > Z_LIMIT, F.lit(False))


def anomaly_labels(vitals: DataFrame) -> DataFrame:
    """Per reading: a fired rule, or a heart rate beyond 3 standard deviations of the patient's own.

    The statistics are one row per patient; the join back is left to the runtime planner,
    which broadcasts by measured size or splits the partitions of a hot patient.
    """
    stats = vitals.groupBy("patient_id").agg(
        F.avg("heart_rate").alias("_mean"), F.stddev_samp("heart_rate").alias("_spread")
    )
    outlier = _outlier(F.col("heart_rate"), F.col("_mean"), F.col("_spread"))
    return vitals.join(stats, "patient_id").select(
        "patient_id",
        "event_time",
        "heart_rate",
        F.col("is_abnormal").alias("rule_flag"),
        outlier.alias("outlier"),
        (F.col("is_abnormal") | outlier).alias("is_anomaly"),
    )


def _window_moments(vitals: DataFrame, size: str) -> DataFrame:
    """One row per patient and window with everything later steps need, in one shuffle."""
    hr, known = F.col("heart_rate"), F.col("heart_rate").isNotNull()
    x = F.when(known, micros("event_time") - F.lit(ORIGIN_MICROS)).cast("decimal(19,0)")
    y, exact = hr.try_cast(SLOPE_DECIMALS), hr.try_cast(AVERAGE_DECIMALS)
    return (
        vitals.groupBy("patient_id", F.window("event_time", size).alias("_span"))
        .agg(
            F.max("heart_rate").alias("max_hr"),
            F.min("heart_rate").alias("_min_hr"),
            F.percentile("heart_rate", 0.95).alias("hr_p95"),
            F.stddev_samp("heart_rate").alias("hr_std"),
            F.avg("spo2").alias("avg_spo2"),
            F.min("spo2").alias("min_spo2"),
            F.bool_or("is_abnormal").alias("_flagged"),
            F.count("heart_rate").alias("_n"),
            F.sum(x).alias("_x"),
            F.sum(y).alias("_y"),
            F.sum((x * y).cast("decimal(31,6)")).alias("_xy"),
            F.sum((x * x).cast("decimal(38,0)")).alias("_xx"),
            F.sum(exact).alias("_total"),
        )
        .withColumns(
            {
                "window_start": F.col("_span.start"),
                "window_end": F.col("_span.end"),
                "avg_hr": F.col("_total").cast("double") / F.nullif(F.col("_n"), F.lit(0)),
            }
        )
        .drop("_span")
    )


def vitals_features(
    vitals: DataFrame,
    patients: DataFrame,
    split: DataFrame,
    size: str = "1 minute",
    slope_seconds: int = 900,
    average_seconds: int = 3600,
) -> DataFrame:
    """One row per patient and window.

    Trailing features look back from the window's end over whole windows, so they sum the
    windows' moments instead of touching readings again. ``slope_seconds`` and
    ``average_seconds`` must be multiples of the window size.
    """
    moments = _window_moments(vitals, size)
    at = micros("window_end")
    by_end = Window.partitionBy("patient_id").orderBy(at)

    def trailing(seconds: int):
        return by_end.rangeBetween(-(seconds * 1_000_000) + 1, Window.currentRow)

    slope, hour = trailing(slope_seconds), trailing(average_seconds)
    whole = Window.partitionBy("patient_id")
    n = F.sum("_n").over(whole)
    mean = F.sum("_total").over(whole).cast("double") / F.nullif(n, F.lit(0))
    # Squared deviations inside the windows, and of their averages from the patient's.
    inside = F.coalesce(F.col("hr_std"), F.lit(0.0)) ** 2 * (F.col("_n") - 1)
    between = F.col("_n") * (F.col("avg_hr") - F.col("_mean")) ** 2
    variance = F.sum(F.when(F.col("_n") > 0, inside + between)).over(whole) / F.when(n > 1, n - 1)
    seen = moments.withColumn("_mean", mean).withColumns(
        {
            **{f"_in_{m}": F.sum(f"_{m}").over(slope) for m in ("n", "x", "y", "xy", "xx")},
            "rolling_avg_hr_1h": F.sum("_total").over(hour).cast("double")
            / F.nullif(F.sum("_n").over(hour), F.lit(0)),
            "_spread": F.sqrt(variance),
        }
    ).withColumn("slope_hr_15m", recentred_slope(micros("window_end") - F.lit(ORIGIN_MICROS)))
    outlier = _outlier(F.col("max_hr"), F.col("_mean"), F.col("_spread")) | _outlier(
        F.col("_min_hr"), F.col("_mean"), F.col("_spread")
    )
    who = patients.select("patient_id", "birth_date", "gender")
    return (
        seen.join(who, "patient_id", "left")
        .join(split, "patient_id")
        .select(
            "patient_id",
            "window_start",
            "window_end",
            age_years("birth_date", F.to_date("window_start")).cast("int").alias("age_years"),
            "gender",
            "avg_hr",
            "max_hr",
            "hr_p95",
            "hr_std",
            "avg_spo2",
            "min_spo2",
            "slope_hr_15m",
            "rolling_avg_hr_1h",
            (F.col("_flagged") | outlier).alias("is_anomaly"),
            "split",
        )
    )
