"""Alert thresholds and physiological bounds, as column expressions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rule(NamedTuple):
    name: str
    measure: str
    comparison: str
    threshold: float
    severity: str
    description: str


# Rule names, thresholds and order.
RULES = (
    Rule("HR_HIGH", "heart_rate", ">=", 120.0, "HIGH", "heart rate >= 120"),
    Rule("CRITICAL_HR", "heart_rate", ">=", 180.0, "CRITICAL", "heart rate >= 180"),
    Rule("SPO2_LOW", "spo2", "<", 92.0, "HIGH", "SpO2 < 92"),
    Rule("BP_HIGH", "systolic_bp", ">=", 140.0, "HIGH", "systolic BP >= 140"),
)
SUSTAINED_RULE = Rule(
    "HR_SUSTAINED_HIGH", "heart_rate", ">=", 120.0, "HIGH", "HR >= 120 for >= 30 s"
)
SUSTAINED_SECONDS = 30

# Physiological bounds per measure.
BOUNDS = {
    "heart_rate": (30.0, 220.0),
    "systolic_bp": (60.0, 240.0),
    "diastolic_bp": (40.0, 160.0),
    "spo2": (70.0, 100.0),
    "temperature": (32.0, 42.0),
    "resp_rate": (6.0, 60.0),
}
MEASURES = tuple(BOUNDS)


def fires(rule: Rule) -> Column:
    value = F.col(rule.measure)
    return value >= rule.threshold if rule.comparison == ">=" else value < rule.threshold


def abnormal_flags() -> Column:
    """Names of the rules that fire, in rule order; a NULL measure fires nothing."""
    return F.array_compact(F.array(*[F.when(fires(r), F.lit(r.name)) for r in RULES]))


def with_flags(df: DataFrame) -> DataFrame:
    return df.withColumn("abnormal_flags", abnormal_flags()).withColumn(
        "is_abnormal", F.size("abnormal_flags") > 0
    )


def clipped(measure: str) -> Column:
    low, high = BOUNDS[measure]
    value = F.col(measure)
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def out_of_range(measure: str) -> Column:
    low, high = BOUNDS[measure]
    return F.coalesce(~F.col(measure).between(low, high), F.lit(False))
