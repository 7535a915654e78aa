from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bedside_spark.functions.numbers import round_exact, rounded
from bedside_spark.operators import timeseries
from bedside_spark.sources import derived
from tests.conftest import at


def test_round_exact_is_python_round(spark):
    rng = random.Random(5)
    values = [2.6755, 2.675, 0.0625, 0.1875, -0.0625, 1.0005, 97.3125, 220.0, 0.0, 1e15, 36.6, -2.5]
    values += [rng.uniform(-300, 300) for _ in range(2000)]
    values += [rng.randrange(0, 4_000_000) / 16000 for _ in range(2000)]
    values += [rng.randrange(0, 400_000) / 2000 for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select("v", round_exact(F.col("v")).alias("r")).collect()
    assert [(r.v, r.r) for r in got if r.r != round(r.v, 3)] == []


def test_rounded_scales_half_away(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (51.349999999999994,), (None,)], "v double")
    assert [r[0] for r in df.select(rounded("v", 0)).collect()] == [3.0, -3.0, 51.0, None]
    assert [r[0] for r in df.select(rounded("v", 1)).collect()] == [2.5, -2.5, 51.4, None]


def test_long_ids_stay_whole(spark):
    given = spark.createDataFrame([(7,), (123456,), (1234567,), (12345678901,)], "n long")
    got = [r[0] for r in given.select(derived.padded_id("P", "n")).collect()]
    assert got == ["P000007", "P123456", "P1234567", "P12345678901"]


def test_slopes_and_averages_keep_six_decimals(spark):
    rates = [60.0004, 60.0008, 60.000401, 60.000812, 60.000333]
    given = [("P1", at(60 * i), f"t{i}", r) for i, r in enumerate(rates)]
    vitals = spark.createDataFrame(
        given, "patient_id string, event_time timestamp, trace_id string, heart_rate double"
    )
    slopes = {r.trace_id: r.slope for r in timeseries.rolling_slope(vitals, 3600).collect()}
    means = {r.trace_id: r.rolling_avg_hr for r in timeseries.rolling_average(vitals).collect()}
    for n in range(2, 6):
        x, y = np.arange(n), np.array(rates[:n])
        expected = np.polyfit(x, y, 1)[0]
        assert slopes[f"t{n - 1}"] == pytest.approx(expected, abs=1e-9)
        assert means[f"t{n - 1}"] == pytest.approx(y.mean(), abs=1e-11)


def test_a_rate_no_decimal_can_hold_does_not_stop_the_job(spark):
    given = [("P1", at(0), "a", 60.0), ("P1", at(1), "b", 1e300), ("P1", at(2), "c", 62.0)]
    vitals = spark.createDataFrame(
        given, "patient_id string, event_time timestamp, trace_id string, heart_rate double"
    )
    means = {r.trace_id: r.rolling_avg_hr for r in timeseries.rolling_average(vitals).collect()}
    assert means == {"a": 60.0, "b": 60.0, "c": 61.0}
    assert timeseries.rolling_slope(vitals, 60).count() == 2
