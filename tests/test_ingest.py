from __future__ import annotations

import base64
import json

import pytest
from pyspark.sql import functions as F

from bedside_spark.functions.rules import with_flags
from bedside_spark.operators import ingest
from bedside_spark.sources import derived
from tests.conftest import SMALL, START, rows

GOOD = {
    "patient_id": "P0001", "device_id": "bed-001", "event_time": "2026-09-15T12:00:00.000+00:00",
    "heart_rate": 130.0005, "systolic_bp": 120, "diastolic_bp": 80, "spo2": 91.5,
    "temperature": 37.0, "resp_rate": 16, "trace_id": "t-1",
}


def without(*names, **changes):
    return {k: v for k, v in {**GOOD, **changes}.items() if k not in names}


def packed(payload, raw=False):
    text = payload if raw else json.dumps(payload)
    return base64.b64encode(text.encode()).decode()


def routed(spark, *data):
    records = spark.createDataFrame([(f"r{i}", d) for i, d in enumerate(data)], "recordId string, data string")
    return records, ingest.route_records(records, START)


ACCEPTED = {
    "plain": GOOD,
    "optional absent": without("diastolic_bp", "temperature", "resp_rate", "trace_id"),
    "boolean measure": without(heart_rate=True),
    "null id": without(patient_id=None),
    "bad time text": without(event_time="yesterday"),
    "nested extra": without(extra={"heart_rate": "98"}),
}
DROPPED = {
    "missing field": without("spo2"),
    "text measure": without(heart_rate="fast"),
    "numeric text": without(spo2="98"),
    "null measure": without(heart_rate=None),
    "null optional": without(temperature=None),
    "list measure": without(heart_rate=[1]),
    "other object": {"not_vitals": True},
    "array": [1],
    "string": "patient_id",
    "number": 5,
}


@pytest.mark.parametrize("name", ACCEPTED)
def test_accepted(spark, name):
    _, out = routed(spark, packed(ACCEPTED[name]))
    row = out.first()
    assert row.result == "Ok" and row.problem is None
    body = json.loads(base64.b64decode(row.data))
    assert body["is_abnormal"] == bool(body["abnormal_flags"])


@pytest.mark.parametrize("name", DROPPED)
def test_dropped(spark, name):
    _, out = routed(spark, packed(DROPPED[name]))
    row = out.first()
    assert (row.result, row.data) == ("Dropped", "") and row.problem


@pytest.mark.parametrize("text", ["####not-json####", "", "{", "nan", '{"heart_rate": 1e400}'])
def test_unreadable_text(spark, text):
    _, out = routed(spark, packed(text, raw=True))
    assert out.first().result == "Dropped"


def test_damaged_base64_drops_one_record_only(spark):
    good = packed(GOOD)
    wrapped = "\n".join(good[i : i + 60] for i in range(0, len(good), 60))
    _, out = routed(spark, good, good[1:], "*" + good, wrapped, None)
    assert [r[1] for r in rows(out, "recordId", "result")] == [
        "Ok", "Dropped", "Ok", "Ok", "Dropped",
    ]


def test_one_answer_per_record_in_one_stage(spark):
    records, out = routed(spark, packed(GOOD), packed("broken", raw=True), packed(GOOD))
    assert [r[1] for r in rows(out, "recordId", "result")] == ["Ok", "Dropped", "Ok"]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_normalized_values(spark):
    data = (packed(GOOD), packed(ACCEPTED["optional absent"]), packed(ACCEPTED["null id"]))
    records = spark.createDataFrame([(str(i), d) for i, d in enumerate(data)], "recordId string, data string")
    checked = ingest.validate_reading(ingest.decode_payload(records))
    first, second, third = ingest.normalize_reading(checked, START).orderBy("recordId").collect()
    assert first.heart_rate == round(130.0005, 3)
    assert first.abnormal_flags == ["HR_HIGH", "SPO2_LOW"] and first.is_abnormal
    assert first.ingestion_time == "2026-09-15T12:00:00.000000Z"
    assert (second.diastolic_bp, second.temperature, second.resp_rate) == (0.0, 0.0, 0.0)
    assert second.trace_id == "" and third.patient_id == "None"


@pytest.mark.parametrize(
    ("heart_rate", "spo2", "systolic", "flags"),
    [
        (119.9, 92.0, 139.9, []),
        (120.0, 91.999, 140.0, ["HR_HIGH", "SPO2_LOW", "BP_HIGH"]),
        (180.0, 98.0, 100.0, ["HR_HIGH", "CRITICAL_HR"]),
        (None, 80.0, None, ["SPO2_LOW"]),
        (None, None, None, []),
    ],
)
def test_flags(spark, heart_rate, spo2, systolic, flags):
    df = spark.createDataFrame(
        [(heart_rate, spo2, systolic)], "heart_rate double, spo2 double, systolic_bp double"
    )
    row = with_flags(df).first()
    assert row.abnormal_flags == flags and row.is_abnormal is bool(flags)


def test_of_a_repeated_key_the_last_value_counts(spark):
    text = json.dumps(GOOD)[:-1] + ', "heart_rate": 61.5, "device_id": "bed-002"}'
    _, out = routed(spark, packed(text, raw=True))
    row = out.first()
    body = json.loads(base64.b64decode(row.data))
    assert row.result == "Ok" and (body["heart_rate"], body["device_id"]) == (61.5, "bed-002")


def test_plain_base64_is_read_as_spark_reads_it(spark):
    texts = ["", "QQ==", "QUI=", "QUJD", "QR==", "Q===", "====", "QQ=Q", "QUJDQ", "QUJD\n", "QUJ*", "+/+/", "Zé=="]
    given = spark.createDataFrame([(t,) for t in texts], "data string").select(
        ingest._decoded(F.col("data")).alias("now"),
        F.when(F.length("data") % 4 == 0, F.try_to_binary("data", F.lit("base64"))).alias("spark"),
    )
    assert given.where(~F.col("now").eqNullSafe(F.col("spark"))).count() == 0


def test_archive_records_are_dealt_to_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    records = derived.raw_payloads(spark, SMALL)
    tasks = records.select(F.spark_partition_id().alias("p"), "recordId").groupBy("p").count()
    assert tasks.count() > cores and tasks.agg(F.sum("count")).first()[0] == records.count()
