"""Operators that cut hot keys into slices give the results of the plain window."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bedside_spark.operators import alerts, ranking, timeseries, upkeep
from bedside_spark.operators.ordered import SLICE, with_slices
from tests.conftest import rows

HOT = 20


def test_slices(skewed):
    sliced = with_slices(skewed, "patient_id", "event_time", HOT)
    sizes = sliced.groupBy("patient_id", SLICE).count().collect()
    hot = [r for r in sizes if r[SLICE] is not None]
    assert len({r["patient_id"] for r in hot}) > 1
    assert len([r for r in hot if r["patient_id"] == "P000007"]) > 5
    assert max(r["count"] for r in hot) < 3 * HOT
    assert sliced.count() == skewed.count()


OPERATORS = {
    "lag_lead": lambda df, n: timeseries.lag_lead(df, hot_rows=n),
    "moving_average": lambda df, n: timeseries.moving_average(df, hot_rows=n),
    "data_gaps": lambda df, n: timeseries.data_gaps(df, 3600.0, hot_rows=n),
    "rolling_average": lambda df, n: timeseries.rolling_average(df, 86_400, hot_rows=n),
    "rolling_slope": lambda df, n: timeseries.rolling_slope(df, 86_400, hot_rows=n),
    "sustained": lambda df, n: alerts.sustained_alerts(df, 86_400.0, 3600.0, hot_rows=n),
    "late": lambda df, n: upkeep.late_readings(df, span_seconds=min(n, 86_400)),
}


@pytest.mark.parametrize("hot_rows", [3, HOT])
@pytest.mark.parametrize("name", OPERATORS)
def test_sliced_equals_plain(skewed, name, hot_rows):
    plain, sliced = OPERATORS[name](skewed, 10**9), OPERATORS[name](skewed, hot_rows)
    expected = rows(plain)
    assert expected and rows(sliced) == expected


def test_exact_duplicates_survive(skewed):
    twice = skewed.unionByName(skewed)
    plain = timeseries.moving_average(twice, hot_rows=10**9)
    assert rows(timeseries.moving_average(twice, hot_rows=HOT)) == rows(plain)
    assert plain.count() == 2 * skewed.count()


def test_sparse_slices(spark):
    """A hot key whose slices hold one row or none still sees two rows on each side."""
    data = [("P1", "bed", 60.0 + i, 95.0, float(i**3), f"{i:04}") for i in range(40)]
    df = spark.createDataFrame(
        data, "patient_id string, device_id string, heart_rate double, spo2 double, "
        "s double, trace_id string",
    ).withColumn("event_time", F.timestamp_seconds("s"))
    got = timeseries.moving_average(df, hot_rows=1)
    assert rows(got) == rows(timeseries.moving_average(df, hot_rows=1000))


def test_top_ranks_with_ties(skewed):
    window = Window.partitionBy("patient_id").orderBy(F.desc("heart_rate"))
    literal = skewed.withColumn("rk", F.rank().over(window).cast("bigint")).where("rk <= 3")
    expected = rows(literal, "patient_id", "heart_rate", "event_time", "rk")
    assert rows(ranking.top_heart_rates(skewed)) == expected


def test_deciles_match_ntile(skewed):
    window = Window.partitionBy("patient_id").orderBy("heart_rate", "event_time", "trace_id")
    literal = (
        skewed.withColumn("d", F.ntile(10).over(window).cast("bigint"))
        .groupBy("patient_id")
        .agg(F.max("heart_rate"), F.max("d"))
    )
    assert rows(ranking.heart_rate_deciles(skewed)) == rows(literal)


def test_dense_rank_matches_window(skewed):
    window = Window.partitionBy("patient_id").orderBy(F.desc("heart_rate"))
    literal = skewed.select(
        "patient_id",
        "event_time",
        "heart_rate",
        F.rank().over(window).cast("bigint"),
        F.dense_rank().over(window).cast("bigint"),
    )
    assert rows(ranking.dense_rank_heart_rates(skewed)) == rows(literal)


def test_late_readings_join_no_constant(skewed):
    plan = upkeep.late_readings(skewed)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_ranks_of_many_values_in_one_key(spark):
    """Ranks from bins equal the plain window for values of all sizes, ties and unknown ones."""
    import random

    from pyspark.sql import Window

    from bedside_spark.operators.ordered import distinct_ranks

    rng = random.Random(2)
    values = [rng.gauss(80, 20) for _ in range(2000)] + [float(rng.randrange(60, 70)) for _ in range(1000)]
    values += [rng.choice((-1, 1)) * 10 ** rng.uniform(-320, 308) for _ in range(500)]
    values += [0.0, -0.0, None, None, float("nan"), float("inf"), float("-inf"), 5e-324, -5e-324, 1.7e308]
    keys = [rng.choice(("hot", "hot", "a", None)) for _ in values]
    df = spark.createDataFrame(list(zip(keys, values)), "k string, v double")
    for descending in (True, False):
        order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last()
        plain = Window.partitionBy("k").orderBy(order)
        expected = df.select("k", "v", F.rank().over(plain).alias("r"), F.dense_rank().over(plain).alias("d"))
        got = distinct_ranks(df, "v", by=["k"], descending=descending)
        assert list(map(repr, rows(got))) == list(map(repr, rows(expected.distinct())))


def test_no_task_orders_a_patient(spark):
    import re

    from bedside_spark.operators import ranking
    from bedside_spark.sources import derived

    vitals = derived.readings(spark, "/root/testdata/sf0.001")
    for frame in (ranking.heart_rate_ntiles(vitals), ranking.dense_rank_heart_rates(vitals)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        # Windows by patient alone run over bins, and those by patient and rate over days.
        for line in (x for x in plan.splitlines() if re.search(r"\+- Window|^Window", x)):
            by = re.findall(r"\[([^\[\]]*)\], \[[^\[\]]*\]$", line)[0]
            if "_bin" not in by and "_day" not in by:
                assert "_bin_rows" in line or "_same" in line, line
