"""Queries that bring readings and the patient dimension together."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedside_spark.functions.numbers import rounded

_MONTH_DAY = "MMdd"


def age_years(birth: Column | str, on: Column | date) -> Column:
    """Completed years of life on a day."""
    birth = F.col(birth) if isinstance(birth, str) else birth
    on = on if isinstance(on, Column) else F.lit(on)
    early = F.date_format(on, _MONTH_DAY) < F.date_format(birth, _MONTH_DAY)
    return F.year(on) - F.year(birth) - early.cast("int")


def age_band(age: Column) -> Column:
    return (
        F.when(age < 18, "0-17")
        .when(age < 40, "18-39")
        .when(age < 65, "40-64")
        .when(age >= 65, "65+")
    )


def heart_rate_by_age(vitals: DataFrame, patients: DataFrame, on: Column | date) -> DataFrame:
    """Heart rate per age band. Readings are reduced to one row per patient before the join."""
    per_patient = vitals.groupBy("patient_id").agg(
        F.count("heart_rate").alias("_n"),
        F.sum(F.col("heart_rate").try_cast("decimal(22,12)")).alias("_sum"),
        F.max("heart_rate").alias("_max"),
    )
    banded = per_patient.join(patients.select("patient_id", "birth_date"), "patient_id")
    return banded.groupBy(age_band(age_years("birth_date", on)).alias("age_band")).agg(
        F.count("*").alias("patients"),
        F.sum("_n").alias("readings"),
        rounded(F.sum("_sum").cast("double") / F.sum("_n"), 4).alias("avg_hr"),
        F.max("_max").alias("max_hr"),
    )


def unmatched_patients(vitals: DataFrame, patients: DataFrame) -> DataFrame:
    """Streamed ids that the dimension does not know; distinct before the anti join."""
    return vitals.select("patient_id").distinct().join(patients, "patient_id", "left_anti")
