from __future__ import annotations

import json
from datetime import UTC, date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from bedside_spark.operators import features, windows
from bedside_spark.plans import data
from bedside_spark.sinks import tables
from bedside_spark.sources import derived, readings
from bedside_spark.session import work_folder
from tests.conftest import SMALL, rows


@pytest.mark.parametrize(
    ("text", "ids"),
    [
        ("patient_id,name\nP1,a\n P2 ,b\n,c\n", ["P1", "P2"]),
        ("Id,Name\nP3,a\nP4,b\n", ["P3", "P4"]),
        ("name,patient_id\na,P5\n", ["P5"]),
        ("patient_id,name\n   ,a\n\tP6\t,b\n", ["P6"]),
    ],
)
def test_cohort(spark, tmp_path, text, ids):
    path = tmp_path / "cohort.csv"
    path.write_text(text)
    assert [r[0] for r in rows(readings.load_cohort(spark, str(path)))] == ids


def test_bootstrap_twice(spark, tmp_path):
    people = derived.patients(spark, SMALL)
    for _ in range(2):
        out = readings.bootstrap_patients(spark, people, str(tmp_path / "p"))
    assert rows(out) == rows(people, *out.columns)


def test_manifest(spark, tmp_path):
    path = str(tmp_path / "m")
    split = features.split_by_patient(derived.readings(spark, SMALL))
    for _ in range(2):
        tables.write_manifest(spark, tables.manifest(split, "2026-09-15"), path)
    (part,) = Path(path).glob("part-*.json")
    body = json.loads(part.read_text())
    assert body["counts"] == {"train": 10, "val": 2, "test": 3} and body["split_by"] == "patient"
    assert body["feature_count"] == 15 and not Path(f"{path}.tmp").exists()


@pytest.mark.parametrize("given", ["2026-09-15", "run_date=2026-09-15"])
def test_run_date(given):
    assert tables.run_date_text(given) == "2026-09-15"


def test_run_date_defaults_to_today():
    before = f"{datetime.now(UTC):%Y-%m-%d}"
    assert before <= tables.run_date_text() <= f"{datetime.now(UTC):%Y-%m-%d}"


def test_export_rerun_is_identical(spark, tmp_path):
    vitals, people = data.vitals(spark, SMALL), derived.patients(spark, SMALL)
    root, seen = str(tmp_path / "x"), []
    for day in ("2026-09-14", "2026-09-15", "run_date=2026-09-15"):
        tables.run_export(spark, vitals, people, root, day)
        table = spark.read.parquet(f"{root}/exports/vitals_features")
        seen.append(rows(table.where("run_date = '2026-09-15'")))
    assert seen[1] and seen[1] == seen[2]
    assert rows(table.groupBy("run_date").count())[0][1] == len(seen[1])


def test_compaction_keeps_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    before = derived.readings(spark, SMALL)
    for n in range(3):
        part = before.where(F.pmod(F.xxhash64("trace_id"), F.lit(3)) == n)
        tables.write_days(part.repartition(4), "event_time", path, "overwrite", n)
    many = len(list(Path(path).rglob("part-*")))
    stored = spark.read.parquet(path).count()
    last = before.agg(F.max(F.to_date("event_time"))).first()[0]
    done = tables.compact_table(spark, path, last)
    assert f"day={last}" not in done
    for _ in range(2):
        tables.compact_table(spark, path)
    assert spark.read.parquet(path).count() == stored
    days = before.select(F.to_date("event_time")).distinct().count()
    assert len(list(Path(path).rglob("part-*"))) == days < many


def test_old_days_are_dropped(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_days(derived.readings(spark, SMALL), "event_time", path)
    gone = tables.drop_old_days(spark, path, date(2024, 1, 30), 14)
    assert len(gone) == 15
    left = spark.read.parquet(path)
    assert left.agg(F.min("day")).first()[0] == date(2024, 1, 16)


def test_replay_replaces_only_its_days(spark, tmp_path):
    vitals, summary = str(tmp_path / "v"), str(tmp_path / "s")
    source = derived.readings(spark, SMALL)
    tables.write_days(source, "event_time", vitals)
    for _ in range(2):
        tables.replay_windows(spark, vitals, summary, date(2024, 1, 3), date(2024, 1, 5))
    expected = windows.tumble(source.where(F.to_date("event_time").between("2024-01-03", "2024-01-05")))
    got = spark.read.parquet(summary)
    assert rows(got, *expected.columns) == rows(expected)
    # Days whose readings are gone lose their summaries.
    tables.drop_old_days(spark, vitals, date(2024, 1, 4), 0)
    tables.replay_windows(spark, vitals, summary, date(2024, 1, 3), date(2024, 1, 4))
    left = expected.where("window_start >= '2024-01-04'")
    assert rows(spark.read.parquet(summary), *expected.columns) == rows(left)


def test_hop_counts_every_reading_twice(spark):
    single = data.vitals_1m(spark, SMALL).agg(F.sum("reading_count")).first()[0]
    assert data.vitals_hop_1m(spark, SMALL).agg(F.sum("reading_count")).first()[0] == 2 * single


def test_work_folder_follows_the_session(spark):
    assert work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_time_range_prunes_days(spark, tmp_path):
    path = str(tmp_path / "t")
    source = derived.readings(spark, SMALL)
    tables.write_days(source, "event_time", path)
    first, last = datetime(2024, 1, 10, 6), datetime(2024, 1, 12)
    got = readings.read_between(spark, path, "event_time", first, last)
    within = (F.col("event_time") >= F.lit(first)) & (F.col("event_time") < F.lit(last))
    assert rows(got, *source.columns) == rows(source.where(within))
    assert len(got.inputFiles()) > 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: [IsNotNull(event_time" in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = (
        derived.readings(spark, SMALL)
        .where("heart_rate >= 120")
        .select("patient_id")
        ._jdf.queryExecution().executedPlan().toString()
    )
    assert "ReadSchema: struct<user_id:bigint,value:double>" in plan


def test_newest_reading_needs_no_sort(spark):
    from bedside_spark.plans.catalog import QUERIES

    plan = QUERIES["latest_vitals"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.count("Exchange") == 1
