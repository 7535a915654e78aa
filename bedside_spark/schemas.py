"""Declared schemas of every table the engine reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

from bedside_spark.functions.rules import MEASURES


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


S, D, L, B, TS = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType(), T.TimestampType()
_MEASURES = {name: D for name in MEASURES}

READING = _struct(
    patient_id=S, device_id=S, event_time=TS, ingestion_time=TS, **_MEASURES, trace_id=S
)
VITALS = T.StructType(
    READING.fields
    + [
        T.StructField("abnormal_flags", T.ArrayType(S, False)),
        T.StructField("is_abnormal", B),
    ]
)
VITALS_HOP_1M = _struct(
    window_start=TS, window_end=TS, patient_id=S,
    avg_heart_rate=D, max_heart_rate=D, min_spo2=D, reading_count=L,
)
VITALS_1M = _struct(
    window_start=TS, window_end=TS, patient_id=S,
    avg_heart_rate=D, max_heart_rate=D, min_spo2=D, max_systolic_bp=D, reading_count=L,
)
PATIENTS = _struct(
    patient_id=S, first_name=S, last_name=S, gender=S, birth_date=T.DateType(),
    race=S, ethnicity=S, city=S, state=S, county=S,
)
ALERTS = _struct(
    patient_id=S, alert_id=S, rule=S, description=S, severity=S, value=D, threshold=D,
    event_ts=TS, resolved=B, sent=B, created_at=TS, delivery_ts=TS, expires_at=L,
)
LATEST_VITALS = _struct(patient_id=S, **_MEASURES, event_time=TS, is_abnormal=B, expires_at=L)
VITALS_FEATURES = _struct(
    patient_id=S, window_start=TS, window_end=TS, age_years=T.IntegerType(), gender=S,
    avg_hr=D, max_hr=D, hr_p95=D, hr_std=D, avg_spo2=D, min_spo2=D,
    slope_hr_15m=D, rolling_avg_hr_1h=D, is_anomaly=B, split=S,
)
ENCOUNTERS = _struct(
    encounter_id=S, patient_id=S, encounter_class=S, start_time=TS, stop_time=TS, organization=S
)
CONDITIONS = _struct(
    condition_id=S, patient_id=S, code=S, description=S, onset=TS, recorded=TS, encounter_id=S
)
MEDICATIONS = _struct(
    medication_id=S, patient_id=S, code=S, description=S, start_time=TS, stop_time=TS,
    encounter_id=S,
)
