"""Batch writers: exports, manifest, replay, compaction, retention."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bedside_spark.functions.numbers import rounded
from bedside_spark.operators import features, windows
from bedside_spark.sinks import files
from bedside_spark.sinks import manifest as manifest_files


#: Batch number of rows that no stream wrote.
REWRITTEN = -1


def write_days(
    df: DataFrame, time: str, path: str, mode: str = "append", batch_id: int = REWRITTEN
) -> None:
    """Write a table with one folder per day and one per batch in it.

    ``overwrite`` replaces only this batch's folders of the days written. The rebalance hint
    gives each day files of the advisory size and splits a large day over several tasks.
    """
    (
        df.withColumn("day", F.to_date(time))
        .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .hint("rebalance", "day")
        .write.option("partitionOverwriteMode", "dynamic")
        .mode(mode)
        .partitionBy("day", "batch_id")
        .parquet(path)
    )


def read_days(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A table of :func:`write_days` without its folder columns, whole during changes too."""
    return manifest_files.view(spark, path, schema).drop("day", "batch_id")


def table_roundtrip(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write a table, read it back, and aggregate what was read."""
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path).agg(
        F.count("*").alias("rows"), rounded(F.avg("heart_rate"), 6).alias("avg_hr")
    )


def replay_windows(
    spark: SparkSession, vitals_path: str, summary_path: str, first: date, last: date
) -> None:
    """Recompute the one-minute summaries of a day range and replace those days.

    Minute windows never cross midnight, so the days of the windows are the days read. Days of
    the range that have no readings any more lose their summaries. All days change at once, for
    readers of :func:`read_days` and after a crash too (``sinks.manifest``).
    """
    files.create(spark, summary_path)
    manifest_files.settle(spark, summary_path)
    days = F.col("day").between(F.lit(first), F.lit(last))
    readings = manifest_files.view(spark, vitals_path).where(days)
    fresh = manifest_files.stage(summary_path)
    old = [n for n in _days(spark, summary_path) if first <= date.fromisoformat(n[4:]) <= last]
    parts = {n: _batches(spark, f"{summary_path}/{n}") for n in old}
    # A number that no folder of these days has, as old and new ones are there for a while.
    number = min([REWRITTEN, *(int(p.split("=")[1]) for ps in parts.values() for p in ps)]) - 1
    write_days(windows.tumble(readings), "window_start", fresh, batch_id=number)
    made = {f"{n}/batch_id={number}": f"{fresh}/{n}/batch_id={number}" for n in _days(spark, fresh)}
    gone = [f"{n}/{p}" for n in old for p in parts[n]]
    manifest_files.exchange(spark, summary_path, gone, made)


def _batches(spark: SparkSession, day: str) -> list[str]:
    return [n for n in files.folders(spark, day) if n.startswith("batch_id=")]


def _days(spark: SparkSession, path: str) -> list[str]:
    if not files.exists(spark, path):
        return []
    return [n for n in files.folders(spark, path) if n.startswith("day=")]


def export_features(df: DataFrame, path: str, run_date: str) -> None:
    """Feature export under ``run_date=``; a rerun replaces exactly that folder."""
    (
        df.withColumn("run_date", F.lit(run_date))
        .write.option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy("run_date")
        .parquet(path)
    )


def manifest(split: DataFrame, run_date: str, created: datetime | None = None) -> DataFrame:
    """One row: run date, creation time, feature count, split key and patients per split."""
    created = created or datetime.now(UTC)

    def patients(name: str):
        return F.count_if(F.col("split") == name).alias(name)

    return split.agg(
        F.count("*").alias("feature_count"), *[patients(n) for n in ("train", "val", "test")]
    ).select(
        F.lit(run_date).alias("run_date"),
        F.lit(created.isoformat(timespec="seconds")).alias("created_at"),
        "feature_count",
        F.lit("patient").alias("split_by"),
        F.struct("train", "val", "test").alias("counts"),
    )


def write_manifest(spark: SparkSession, row: DataFrame, path: str) -> None:
    """Write the manifest beside its final place, then rename it."""
    pending = f"{path}.tmp"
    row.coalesce(1).write.mode("overwrite").json(pending)
    files.replace(spark, pending, path)


def run_date_text(given: str | None = None) -> str:
    """``run_date=2026-09-15`` or ``2026-09-15`` as a date; today (UTC) when not given."""
    return given.split("=")[-1] if given else f"{datetime.now(UTC):%Y-%m-%d}"


def run_export(
    spark: SparkSession,
    vitals: DataFrame,
    patients: DataFrame,
    root: str,
    run_date: str | None = None,
    window: str = "1 minute",
) -> str:
    """Export features, split and manifest of one run date; a rerun gives the same result."""
    day = run_date_text(run_date)
    split_path = f"{root}/splits/run_date={day}"
    features.split_by_patient(vitals).write.mode("overwrite").parquet(split_path)
    split = spark.read.parquet(split_path)
    table = features.vitals_features(vitals, patients, split, window)
    export_features(table, f"{root}/exports/vitals_features", day)
    write_manifest(spark, manifest(split, day), f"{root}/manifests/vitals_features.{day}")
    return day


def compact_table(spark: SparkSession, path: str, before: date | None = None) -> list[str]:
    """Rewrite each day of a table into files of the advisory size; its rows stay the same.

    Days from ``before`` on are left alone: a stream may still try one of their batches again.
    Only the batch folders that were read go, so batches that arrive meanwhile stay. A day's
    folders change at once, for readers of :func:`read_days` and after a crash too
    (``sinks.manifest``). Returns the days rewritten.
    """
    manifest_files.settle(spark, path)
    done = []
    for name in sorted(_days(spark, path)):
        if before is not None and date.fromisoformat(name[4:]) >= before:
            continue
        day = f"{path}/{name}"
        parts = _batches(spark, day)
        if not parts:
            continue
        # A number no stream and no earlier run has used in this day.
        number = min(REWRITTEN, *(int(n.split("=")[1]) for n in parts)) - 1
        final, staged = f"{name}/batch_id={number}", manifest_files.stage(path)
        rows = spark.read.parquet(*[f"{day}/{n}" for n in parts])
        rows.hint("rebalance").write.mode("overwrite").parquet(f"{staged}/{final}")
        gone = [f"{name}/{n}" for n in parts]
        manifest_files.exchange(spark, path, gone, {final: f"{staged}/{final}"})
        done.append(name)
    return done


def drop_old_days(spark: SparkSession, path: str, as_of: date, keep_days: int) -> list[str]:
    """Remove the day folders that are older than ``keep_days``; returns their names."""
    manifest_files.settle(spark, path)
    first = as_of - timedelta(days=keep_days)
    old = [n for n in _days(spark, path) if date.fromisoformat(n[4:]) < first]
    if old:
        manifest_files.exchange(spark, path, old, {})
    return old
