from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from bedside_spark.functions.timekit import seconds_between
from bedside_spark.operators import alerts
from tests.conftest import at, rows


@pytest.mark.parametrize(
    ("text", "limit"),
    [
        ("5", 5), ("1000", 100), ("abc", 10), (None, 10), ("0", 1), ("-3", 1), (" 7 ", 7),
        ("5.0", 10), ("", 10), ("9" * 60, 100), ("-" + "9" * 60, 1),
    ],
)
def test_limit(spark, text, limit):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(alerts.clamped_limit(F.col("t"))).first()[0] == limit


@pytest.mark.parametrize(
    ("key", "valid"),
    [
        ("P0001", True), ("a.b_c-d", True), ("bad id!", False), ("", False), ("-x", False),
        ("P1\n", False), ("x" * 64, True), ("x" * 65, False), (None, False),
    ],
)
def test_key(spark, key, valid):
    df = spark.createDataFrame([(key,)], "k string")
    assert df.select(alerts.valid_key("k")).first()[0] is valid


def change(op, sent=None, value="128.5", alert="A-1", patient="P1"):
    image = {
        "patient_id": {"S": patient}, "alert_id": {"S": alert}, "rule": {"S": "HR_HIGH"},
        "severity": {"S": "HIGH"}, "value": {"N": value}, "threshold": {"N": "120"},
        "event_ts": {"S": "2026-09-15T12:00:00Z"},
    }
    if sent is not None:
        image["sent"] = sent
    return (op, json.dumps(image))


def feed(spark, *changes):
    df = spark.createDataFrame(list(changes), "op string, image string")
    return df.withColumn("image", F.parse_json("image"))


def test_pending(spark):
    decoded = alerts.decode_change_image(
        feed(
            spark,
            change("INSERT", alert="absent"),
            change("MODIFY", {"BOOL": False}, alert="false"),
            change("INSERT", {"S": "False"}, alert="text"),
            change("INSERT", {"BOOL": True}, alert="true"),
            change("REMOVE", alert="removed"),
        )
    )
    kept = [r[0] for r in rows(alerts.pending_alerts(decoded), "alert_id")]
    assert kept == ["absent", "false", "text"]


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [("128", "int", 128.0), ("128.0", "float", 128.0), ("1E2", "float", 100.0)],
)
def test_number_kind(spark, text, kind, value):
    row = alerts.decode_change_image(feed(spark, change("INSERT", value=text))).first()
    assert (row.value_kind, row.value) == (kind, value)


def test_repeated_feed_sends_once(spark):
    decoded = alerts.decode_change_image(
        feed(spark, change("INSERT"), change("MODIFY"), change("INSERT", alert="A-2"))
    )
    sent = spark.createDataFrame([("P1", "A-2")], "patient_id string, alert_id string")
    messages = alerts.alert_messages(alerts.pending_alerts(decoded), sent).collect()
    assert len(messages) == 1 and messages[0].subject == "Vitals alert: HR_HIGH"
    body = json.loads(messages[0].body)
    assert set(body) == set(alerts.MESSAGE_FIELDS) and body["value"] == 128.5


def stored(spark, *sent):
    return spark.createDataFrame(
        [("P1", f"A-{i}", s, at(i)) for i, s in enumerate(sent)],
        "patient_id string, alert_id string, sent boolean, event_ts timestamp",
    )


def test_mark_sent_is_idempotent(spark):
    table = stored(spark, None, False, True, False)
    delivered = table.where("alert_id <> 'A-3'").unionByName(table.where("alert_id = 'A-0'"))
    once = alerts.mark_sent(table, delivered, at(100))
    twice = alerts.mark_sent(once, delivered, at(200))
    assert rows(twice) == rows(once)
    marks = {r.alert_id: (r.sent, r.delivery_ts is not None) for r in once.collect()}
    assert marks == {
        "A-0": (True, True), "A-1": (True, True), "A-2": (True, False), "A-3": (False, False),
    }


def test_expiry(spark):
    df = spark.createDataFrame(
        [("past", int(at(0).timestamp())), ("edge", int(at(10).timestamp())), ("later", int(at(11).timestamp())), ("none", None)],
        "k string, expires_at bigint",
    )
    assert [r[0] for r in rows(alerts.not_expired(df, at(10)), "k")] == ["later", "none"]


def readings(spark, *values):
    data = [("P1", float(hr), at(s), f"{i:03}") for i, (s, hr) in enumerate(values)]
    return spark.createDataFrame(
        data, "patient_id string, heart_rate double, event_time timestamp, trace_id string"
    )


@pytest.mark.parametrize(
    ("values", "found"),
    [
        ([(0, 120), (29, 130)], []),
        ([(0, 120), (30, 130), (40, 140)], [(130.0, 0)]),
        ([(0, 125), (10, 119), (40, 130), (70, 131)], [(131.0, 40)]),
        ([(0, 125), (61, 126), (90, 127), (95, 128)], [(128.0, 61)]),
        ([(0, 125), (61, 126), (91, 127)], [(127.0, 61)]),
        ([(0, 125), (31, 126), (40, 100), (50, 125), (90, 126)], [(126.0, 0), (126.0, 50)]),
    ],
)
def test_sustained(spark, values, found):
    since = seconds_between(F.lit(at(0)), "run_start")
    got = alerts.sustained_alerts(readings(spark, *values)).select("value", since)
    assert rows(got) == [(v, float(s)) for v, s in found]


def test_lookup_statuses(spark):
    asked = spark.createDataFrame([("P1",), ("P999999",), ("bad id!",)], "patient_id string")
    latest = spark.createDataFrame([("P1", 80.0)], "patient_id string, heart_rate double")
    got = {r.patient_id: (r.status, r.heart_rate) for r in alerts.latest_lookup(asked, latest).collect()}
    assert got == {"P1": (200, 80.0), "P999999": (404, None), "bad id!": (400, None)}
