from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bedside_spark.operators import features
from bedside_spark.plans import data
from bedside_spark.sources import derived
from tests.conftest import SMALL, rows


def ids(spark, count, reverse=False):
    numbers = range(count - 1, -1, -1) if reverse else range(count)
    return spark.createDataFrame([(f"P{i:04}",) for i in numbers], "patient_id string")


@pytest.mark.parametrize(
    ("count", "sizes"),
    [(1000, (700, 150, 150)), (100, (70, 15, 15)), (50, (35, 7, 8)), (1, (0, 0, 1)), (0, (0, 0, 0))],
)
def test_sizes(spark, count, sizes):
    got = dict(rows(features.split_counts(features.split_by_patient(ids(spark, count)))))
    assert tuple(got.get(n, 0) for n in ("train", "val", "test")) == sizes


def test_order_and_repeats_do_not_matter(spark):
    first = rows(features.split_by_patient(ids(spark, 50)))
    assert rows(features.split_by_patient(ids(spark, 50, reverse=True))) == first
    twice = ids(spark, 50).unionByName(ids(spark, 50))
    assert rows(features.split_by_patient(twice)) == first


def test_seed_changes_members_only(spark):
    one, two = (rows(features.split_by_patient(ids(spark, 200), seed=s)) for s in ("42", "43"))
    assert one != two and len(one) == len(two)


def test_no_patient_in_two_splits(spark):
    vitals = data.vitals(spark, SMALL)
    split = features.split_by_patient(vitals)
    table = features.vitals_features(vitals, derived.patients(spark, SMALL), split)
    splits = table.groupBy("patient_id").agg(F.countDistinct("split").alias("n"))
    assert splits.where("n > 1").count() == 0
    assert table.count() == data.vitals_1m(spark, SMALL).count()
    assert [f.name for f in table.schema] == [
        "patient_id", "window_start", "window_end", "age_years", "gender", "avg_hr", "max_hr",
        "hr_p95", "hr_std", "avg_spo2", "min_spo2", "slope_hr_15m", "rolling_avg_hr_1h",
        "is_anomaly", "split",
    ]


def test_age_on_birthday(spark):
    from bedside_spark.operators.patients import age_years

    df = spark.sql("select date '2000-02-29' b, d from values (date '2026-02-28'), (date '2026-03-01'), (date '2028-02-29') t(d)")
    got = df.orderBy("d").select(age_years("b", F.col("d"))).collect()
    assert [r[0] for r in got] == [25, 26, 28]
