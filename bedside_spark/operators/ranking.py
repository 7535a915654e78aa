"""Rankings of readings within a patient and of patients against each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bedside_spark.functions.numbers import rounded
from bedside_spark.functions.timekit import truncated
from bedside_spark.operators.ordered import distinct_ranks

_SALTS = 32


def top_heart_rates(vitals: DataFrame, depth: int = 3) -> DataFrame:
    """Readings whose RANK by heart rate is at most ``depth``; ties all survive.

    A first rank per (patient, salt) drops everything that cannot qualify, with many equal
    values of one patient spread over the salts. The rank itself then follows from the
    patient's ``depth`` greatest values, so no task sees all readings of a patient.
    """
    salted = vitals.select(
        "patient_id",
        "heart_rate",
        "event_time",
        F.pmod(F.xxhash64("trace_id", "event_time"), F.lit(_SALTS)).alias("_salt"),
    ).where("heart_rate is not null")
    downward = F.col("heart_rate").desc()
    candidates = (
        salted.withColumn(
            "_rank", F.rank().over(Window.partitionBy("patient_id", "_salt").orderBy(downward))
        )
        .where(F.col("_rank") <= depth)
        .drop("_rank", "_salt")
    )
    greatest = (
        salted.select("patient_id", "heart_rate")
        .withColumn("_n", F.row_number().over(Window.partitionBy("patient_id").orderBy(downward)))
        .where(F.col("_n") <= depth)
        .groupBy(F.col("patient_id").alias("_patient"))
        .agg(F.collect_list("heart_rate").alias("_greatest"))
    )
    above = F.size(F.filter("_greatest", lambda x: x > F.col("heart_rate")))
    return (
        candidates.join(greatest, F.col("patient_id") == F.col("_patient"))
        .where(F.col("heart_rate") >= F.array_min("_greatest"))
        .select(
            "patient_id",
            F.col("heart_rate").alias("hr"),
            "event_time",
            (above + 1).cast("bigint").alias("rk"),
        )
    )


def heart_rate_ntiles(vitals: DataFrame, buckets: int = 10) -> DataFrame:
    """NTILE of every reading among its patient's by heart rate, unknown rates last.

    Readings of one rate and day are numbered by time and trace id; the number within the patient
    adds the counts of earlier days with that rate and of lower rates. So a task orders the
    readings of one patient, rate and day, never all of a patient or of a rate.
    """
    rate, day = F.col("heart_rate"), F.to_date("event_time")
    below = distinct_ranks(vitals, "heart_rate", by=["patient_id"], descending=False).select(
        F.col("patient_id").alias("_patient"), rate.alias("_value"), F.col("_rank")
    )
    sizes = vitals.groupBy(F.col("patient_id").alias("_owner")).agg(F.count("*").alias("_n"))
    daily = vitals.groupBy("patient_id", "heart_rate", day.alias("_day")).agg(F.count("*").alias("_same"))
    before = Window.partitionBy("patient_id", "heart_rate").orderBy("_day")
    earlier = F.sum("_same").over(before.rowsBetween(Window.unboundedPreceding, -1))
    daily = (
        daily.withColumn("_earlier", F.coalesce(earlier, F.lit(0)))
        .join(below, (F.col("patient_id") == F.col("_patient")) & rate.eqNullSafe(F.col("_value")))
        .join(sizes, F.col("patient_id") == F.col("_owner"))
        .select("_patient", "_value", F.col("_day").alias("_on"), "_earlier", "_rank", "_n")
    )
    tie = Window.partitionBy("patient_id", "heart_rate", "_day").orderBy("event_time", "trace_id")
    numbered = (
        vitals.select("patient_id", "event_time", "trace_id", "heart_rate", day.alias("_day"))
        .withColumn("_tie", F.row_number().over(tie))
        .join(
            daily,
            (F.col("patient_id") == F.col("_patient"))
            & rate.eqNullSafe(F.col("_value"))
            & F.col("_day").eqNullSafe(F.col("_on")),
        )
        .withColumn("_tie", F.col("_tie") + F.col("_earlier"))
        .withColumn("_row", F.col("_rank") + F.col("_tie") - 1)
        .withColumn("_small", F.floor(F.col("_n") / F.lit(buckets)))
        .withColumn("_long", F.col("_n") % buckets)
    )
    # The first ``_long`` buckets hold one row more than the others.
    in_long = F.col("_long") * (F.col("_small") + 1)
    number = F.when(
        F.col("_row") <= in_long, F.ceil(F.col("_row") / (F.col("_small") + 1))
    ).otherwise(F.col("_long") + F.ceil((F.col("_row") - in_long) / F.col("_small")))
    return numbered.select(
        "patient_id", "event_time", "trace_id", "heart_rate", number.cast("bigint").alias("hr_decile")
    )


def heart_rate_deciles(vitals: DataFrame, buckets: int = 10) -> DataFrame:
    """Peak heart rate of each patient and the greatest NTILE of its readings."""
    return (
        heart_rate_ntiles(vitals, buckets)
        .groupBy("patient_id")
        .agg(F.max("heart_rate").alias("peak_hr"), F.max("hr_decile").alias("peak_decile"))
    )


def dense_rank_heart_rates(vitals: DataFrame) -> DataFrame:
    """RANK and DENSE_RANK of every reading by heart rate, greatest first.

    Ranks are computed per distinct (patient, heart rate) from counts and joined back.
    """
    ranks = distinct_ranks(vitals, "heart_rate", by=["patient_id"]).select(
        F.col("patient_id").alias("_patient"),
        F.col("heart_rate").alias("_value"),
        F.col("_rank").alias("rk"),
        F.col("_dense_rank").alias("dense_rk"),
    )
    return vitals.join(
        ranks, (F.col("patient_id") == F.col("_patient")) & F.col("heart_rate").eqNullSafe(F.col("_value"))
    ).select("patient_id", "event_time", F.col("heart_rate").alias("hr"), "rk", "dense_rk")


def exploded_flags(vitals: DataFrame) -> DataFrame:
    """One row per fired rule; readings without flags vanish."""
    return vitals.select("patient_id", "event_time", F.explode("abnormal_flags").alias("flag"))


def flagged_minutes(vitals: DataFrame) -> DataFrame:
    """Fired rules per patient-minute. Counting the array size needs no exploded rows."""
    return (
        vitals.where(F.size("abnormal_flags") > 0)
        .groupBy("patient_id", truncated(vitals, "event_time", "minute").alias("bucket_ts"))
        .agg(F.sum(F.size("abnormal_flags")).alias("flagged_readings"))
    )


def patient_abnormal(vitals: DataFrame) -> DataFrame:
    """Flagged minutes and flags per patient.

    The share compares flagged minutes with distinct flagged minutes, so it is always 100;
    :func:`patient_abnormal_share` has the share of all observed minutes.
    """
    minutes = flagged_minutes(vitals)
    return minutes.groupBy("patient_id").agg(
        F.count("flagged_readings").alias("abnormal_minutes"),
        rounded(
            100.0 * F.count("flagged_readings").cast("double") / F.countDistinct("bucket_ts"), 1
        ).alias("abnormal_share_pct"),
        F.sum("flagged_readings").alias("abnormal_readings"),
    )


def patient_abnormal_share(vitals: DataFrame) -> DataFrame:
    """Flagged minutes as a share of the patient's observed minutes."""
    minutes = vitals.groupBy(
        "patient_id", truncated(vitals, "event_time", "minute").alias("bucket_ts")
    ).agg(F.sum(F.size("abnormal_flags")).alias("_flags"))
    flagged = F.count_if(F.col("_flags") > 0)
    return minutes.groupBy("patient_id").agg(
        flagged.alias("abnormal_minutes"),
        rounded(100.0 * flagged.cast("double") / F.count("*"), 1).alias("abnormal_share_pct"),
        F.sum("_flags").alias("abnormal_readings"),
    )


def ranked_patients(per_patient: DataFrame) -> DataFrame:
    """Global DENSE_RANK by share and RANK by volume.

    Only distinct values are ordered globally: at most 1 001 shares with one decimal, and
    at most sqrt(2 x flags) volumes, because distinct volumes add up to the flag count. The
    shares are few enough to broadcast, which also spreads patients that share one.
    """
    shares = distinct_ranks(per_patient, "abnormal_share_pct").select(
        F.col("abnormal_share_pct").alias("_share"), F.col("_dense_rank").alias("rank_by_share")
    )
    volumes = distinct_ranks(per_patient, "abnormal_readings").select(
        F.col("abnormal_readings").alias("_volume"), F.col("_rank").alias("rank_by_volume")
    )
    return (
        per_patient.join(F.broadcast(shares), F.col("abnormal_share_pct") == F.col("_share"))
        .join(volumes, F.col("abnormal_readings") == F.col("_volume"))
        .select(
            "patient_id",
            "abnormal_minutes",
            "abnormal_readings",
            "abnormal_share_pct",
            "rank_by_share",
            "rank_by_volume",
        )
    )


def named_ranking(ranked: DataFrame, patients: DataFrame) -> DataFrame:
    """Ranking rows of known patients with their full name, in the order of the share."""
    names = patients.select(
        F.col("patient_id"),
        F.concat("first_name", F.lit(" "), "last_name").alias("patient_name"),
    )
    named = ranked.join(names, "patient_id").select(
        "patient_id", "patient_name", *[c for c in ranked.columns if c != "patient_id"]
    )
    return named.orderBy("rank_by_share")
