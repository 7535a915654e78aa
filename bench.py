"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Every query runs to a no-op sink, so all of its rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import time

from bedside_spark.plans.catalog import QUERIES
from bedside_spark.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "latest_vitals", "abnormal_flags", "flag_explode", "flag_distribution", "flagged_with_patients",
    "tumble_1m", "hop_1m", "time_bucketing", "windowing_summary", "lag_lead", "moving_average",
    "running_totals", "top3_hr", "hr_deciles", "latest_per_bucket", "dense_rank_hr", "rolling_1h",
    "slope_15m", "route_ok_dropped", "threshold_alerts", "sustained_alerts", "data_gaps",
    "late_readings", "latest_lookup", "patient_alerts", "chart_hr_trend", "vitals_features",
    "split_by_patient", "hr_by_age_cohort", "stream_tumble",
)


def main() -> None:
    spark = build_session(
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    run("latest_vitals")  # starts the JVM's code paths; not counted
    seconds = {name: run(name) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": FOLDER.rstrip("/").rpartition("sf")[2],
            }
        )
    )


if __name__ == "__main__":
    main()
