from __future__ import annotations

import sys
from datetime import UTC, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from bedside_spark.session import build_session  # noqa: E402
from bedside_spark.sources import derived  # noqa: E402

SMALL = "/root/testdata/sf0.001"
START = datetime(2026, 9, 15, 12, 0, tzinfo=UTC)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def skewed(spark):
    """Readings of which one patient has a third, with two stray timestamps."""
    events = derived.table(spark, SMALL, "events")
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(7)).otherwise(F.col("user_id"))
    stray = (
        F.when(F.col("event_id") == 3, F.expr("timestamp_ntz '1970-01-01 00:00:00'"))
        .when(F.col("event_id") == 6, F.expr("timestamp_ntz '2031-01-01 00:00:00'"))
        .otherwise(F.col("ts"))
    )
    moved = events.withColumn("user_id", hot).withColumn("ts", stray)
    return derived.readings_from(moved)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
