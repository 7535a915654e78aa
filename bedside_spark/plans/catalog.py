"""Every registered query: ``name -> callable(spark, sf_dir)``.

All of them read the given tables. Times that a user would pass in (``as_of``) are scalar
subqueries over the same tables, so building a query starts no job. The exceptions are the
sink and stream queries, which have to write before they can show what was written.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bedside_spark.functions.numbers import rounded
from bedside_spark.functions.rules import MEASURES, clipped, out_of_range
from bedside_spark.operators import (
    alerts,
    features,
    ingest,
    patients,
    ranking,
    summaries,
    timeseries,
    upkeep,
    windows,
)
from bedside_spark.plans import data
from bedside_spark.schemas import READING
from bedside_spark.session import work_folder
from bedside_spark.sinks import streams, tables
from bedside_spark.sources import derived, readings
from bedside_spark.streaming import jobs, keyed

DAY = 86_400
EXPORT_DATE = "2024-02-01"
WRONG_ROWS = 1000

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def top(df: DataFrame, count: int, *order: str) -> DataFrame:
    """Global sort and limit with an explicit tie-breaker: one take-ordered step."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(count)


def joined_flags(df: DataFrame) -> DataFrame:
    return df.withColumn("abnormal_flags", F.array_join("abnormal_flags", ","))


def dates_as_text(df: DataFrame) -> DataFrame:
    """ISO text for DATE columns, whose client type differs between the two engines."""
    dates = {f.name for f in df.schema if f.dataType.typeName() == "date"}
    return df.select(*[F.col(c).cast("string") if c in dates else c for c in df.columns])


def untimed(df: DataFrame) -> DataFrame:
    """Zoned timestamps of stream outputs as the unzoned ones of the source tables."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if f.dataType.typeName() == "timestamp"
            else F.col(f.name)
            for f in df.schema
        ]
    )


# --- projections and ingest ----------------------------------------------------------


@query
def abnormal_flags(spark: SparkSession, sf: str) -> DataFrame:
    return joined_flags(data.vitals(spark, sf)).select(
        "patient_id", "event_time", "abnormal_flags", "is_abnormal"
    )


@query
def range_check(spark: SparkSession, sf: str) -> DataFrame:
    beyond = sum((out_of_range(m).cast("bigint") for m in MEASURES), F.lit(0).cast("bigint"))
    return derived.readings(spark, sf).select(
        "patient_id",
        "event_time",
        *[clipped(m).alias(m) for m in MEASURES],
        beyond.alias("measures_out_of_range"),
    )


@query
def decode_payload(spark: SparkSession, sf: str) -> DataFrame:
    decoded = ingest.decode_payload(derived.raw_payloads(spark, sf))
    kind = F.regexp_extract(F.schema_of_variant("_json"), "^[A-Z]+", 0)
    return decoded.select(
        "recordId",
        F.col("payload").isNotNull().alias("readable"),
        kind.alias("json_type"),
        F.try_variant_get("_json", "$.trace_id", "string").alias("trace_id"),
    )


@query
def validate_reading(spark: SparkSession, sf: str) -> DataFrame:
    decoded = ingest.decode_payload(derived.raw_payloads(spark, sf))
    return ingest.validate_reading(decoded).select("recordId", "problem")


@query
def normalize_reading(spark: SparkSession, sf: str) -> DataFrame:
    decoded = ingest.decode_payload(derived.raw_payloads(spark, sf))
    return joined_flags(ingest.normalize_reading(ingest.validate_reading(decoded)))


@query
def route_ok_dropped(spark: SparkSession, sf: str) -> DataFrame:
    routed = ingest.route_records(derived.raw_payloads(spark, sf))
    return routed.select("recordId", "result", (F.length("data") > 0).alias("has_data"))


@query
def encode_payload(spark: SparkSession, sf: str) -> DataFrame:
    """Encoded payloads decoded again, so that the fields can be compared."""
    routed = ingest.route_records(derived.raw_payloads(spark, sf)).where("result = 'Ok'")
    again = ingest.decode_payload(routed.select("recordId", "data"))

    def field(name: str, kind: str):
        return F.try_variant_get("_json", f"$.{name}", kind).alias(name)

    return again.select(
        "recordId",
        *[field(f, "string") for f in ("patient_id", "device_id", "event_time", "trace_id")],
        *[field(m, "double") for m in MEASURES],
        field("is_abnormal", "boolean"),
    )


# --- filters -------------------------------------------------------------------------


@query
def recent_1m(spark: SparkSession, sf: str) -> DataFrame:
    recent = summaries.recent_windows(data.vitals_1m(spark, sf), data.as_of(spark, sf))
    return recent.withColumn("avg_heart_rate", rounded("avg_heart_rate", 6))


@query
def alert_history(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.alert_history(data.stored_alerts(spark, sf), data.as_of(spark, sf))


@query
def decode_change_image(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.decode_change_image(data.change_feed(spark, sf))


@query
def pending_alerts(spark: SparkSession, sf: str) -> DataFrame:
    decoded = alerts.decode_change_image(data.change_feed(spark, sf))
    return alerts.pending_alerts(decoded).select("op", "patient_id", "alert_id", "sent")


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    """Every patient's id, and for every seventh patient a malformed one."""
    ids = derived.table(spark, sf, "customer").select(
        "c_custkey", derived.padded_id("P", "c_custkey").alias("patient_id")
    )
    malformed = ids.where("c_custkey % 7 = 0").withColumn(
        "patient_id", F.concat("patient_id", F.lit(" !"))
    )
    return ids.unionByName(malformed)


@query
def key_validation(spark: SparkSession, sf: str) -> DataFrame:
    return _requests(spark, sf).select("patient_id", alerts.valid_key("patient_id").alias("valid"))


@query
def not_expired(spark: SparkSession, sf: str) -> DataFrame:
    stored = alerts.with_expiry(alerts.latest_state(data.vitals(spark, sf)), "event_time", 2)
    return alerts.not_expired(stored, data.as_of(spark, sf)).select(
        "patient_id", "event_time", "expires_at"
    )


# --- joins ---------------------------------------------------------------------------


@query
def flagged_with_patients(spark: SparkSession, sf: str) -> DataFrame:
    ranked = ranking.ranked_patients(ranking.patient_abnormal(data.vitals(spark, sf)))
    return ranking.named_ranking(ranked, derived.patients(spark, sf))


@query
def flag_explode(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.exploded_flags(data.vitals(spark, sf))


@query
def overlap_factor(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.overlap_factor(data.vitals_1m(spark, sf), data.vitals_hop_1m(spark, sf))


@query
def latest_lookup(spark: SparkSession, sf: str) -> DataFrame:
    state = alerts.latest_state(data.vitals(spark, sf)).drop("trace_id")
    return alerts.latest_lookup(_requests(spark, sf).select("patient_id"), state)


@query
def mark_sent(spark: SparkSession, sf: str) -> DataFrame:
    stored = data.stored_alerts(spark, sf)
    delivered = stored.where("event_id % 2 = 0")
    return alerts.mark_sent(stored, delivered, data.as_of(spark, sf)).select(
        "patient_id", "alert_id", "sent", "delivery_ts"
    )


@query
def hr_by_age_cohort(spark: SparkSession, sf: str) -> DataFrame:
    on = F.to_date(data.as_of(spark, sf))
    return patients.heart_rate_by_age(data.vitals(spark, sf), derived.patients(spark, sf), on)


@query
def unmatched_patients(spark: SparkSession, sf: str) -> DataFrame:
    return patients.unmatched_patients(
        data.vitals(spark, sf), derived.listed_patients(spark, sf)
    )


# --- aggregations --------------------------------------------------------------------


def _rounded(summary: DataFrame) -> DataFrame:
    return summary.withColumn("avg_heart_rate", rounded("avg_heart_rate", 6))


@query
def tumble_1m(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(data.vitals_1m(spark, sf))


@query
def tumble_1h(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(windows.tumble(derived.readings(spark, sf), "1 hour"))


@query
def hop_1m(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(data.vitals_hop_1m(spark, sf))


@query
def hop_1h(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(windows.hop(derived.readings(spark, sf), "1 hour", "30 minutes"))


@query
def time_bucketing(spark: SparkSession, sf: str) -> DataFrame:
    buckets = timeseries.time_bucketing(derived.readings(spark, sf))
    return top(buckets, 20, "patient_id", "bucket_ts")


@query
def flag_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.flag_distribution(data.vitals(spark, sf), data.as_of(spark, sf))


@query
def flagged_minutes(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.flagged_minutes(data.vitals(spark, sf))


@query
def patient_abnormal(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.patient_abnormal(data.vitals(spark, sf))


@query
def patient_abnormal_share(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.patient_abnormal_share(data.vitals(spark, sf))


@query
def windowing_summary(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.windowing_summary(data.vitals_1m(spark, sf), data.vitals_hop_1m(spark, sf))


@query
def window_edge_compare(spark: SparkSession, sf: str) -> DataFrame:
    minute = F.date_trunc("minute", data.as_of(spark, sf)).cast("timestamp_ntz")
    return summaries.window_edge_compare(
        data.vitals_1m(spark, sf), data.vitals_hop_1m(spark, sf), minute
    )


@query
def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.table_counts(
        patients=derived.patients(spark, sf),
        vitals=derived.readings(spark, sf),
        vitals_1m=data.vitals_1m(spark, sf),
        vitals_hop_1m=data.vitals_hop_1m(spark, sf),
    )


@query
def avg_max_hr(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.average_peak(data.vitals_1m(spark, sf))


@query
def readings_per_patient(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.readings_per_patient(derived.readings(spark, sf))


@query
def window_totals(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.window_totals(data.vitals_1m(spark, sf))


@query
def chart_hr_trend(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.chart_heart_rate(data.vitals_1m(spark, sf))


@query
def chart_min_spo2(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.chart_min_spo2(data.vitals_1m(spark, sf))


@query
def chart_readings(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.chart_readings(data.vitals_1m(spark, sf))


@query
def vitals_features(spark: SparkSession, sf: str) -> DataFrame:
    vitals = data.vitals(spark, sf)
    table = features.vitals_features(
        vitals,
        derived.patients(spark, sf),
        features.split_by_patient(vitals),
        size="1 hour",
        slope_seconds=DAY,
        average_seconds=DAY,
    )
    return _measured(table)


def _measured(table: DataFrame) -> DataFrame:
    measured = ("avg_hr", "hr_p95", "hr_std", "avg_spo2", "rolling_avg_hr_1h")
    return table.withColumns(
        {**{c: rounded(c, 4) for c in measured}, "slope_hr_15m": rounded("slope_hr_15m", 6)}
    )


@query
def vitals_features_1m(spark: SparkSession, sf: str) -> DataFrame:
    """The features as specified: minute windows, slope of 15 minutes, average of one hour."""
    vitals = data.vitals(spark, sf)
    people, split = derived.patients(spark, sf), features.split_by_patient(vitals)
    return _measured(features.vitals_features(vitals, people, split))


@query
def ops_daily_rollup(spark: SparkSession, sf: str) -> DataFrame:
    records = derived.raw_payloads(spark, sf, "ingestion_time")
    routed = ingest.route_records(records.withColumn("day", F.to_date("ingestion_time")))
    daily = summaries.daily_operations(
        derived.readings(spark, sf), data.stored_alerts(spark, sf), routed.select("day", "result")
    )
    return dates_as_text(daily)


@query
def ingest_latency(spark: SparkSession, sf: str) -> DataFrame:
    return dates_as_text(summaries.ingest_latency(derived.readings(spark, sf)))


# --- analytic windows ----------------------------------------------------------------


@query
def latest_vitals(spark: SparkSession, sf: str) -> DataFrame:
    return timeseries.latest_per_patient(
        derived.readings(spark, sf), ["event_time", "heart_rate", "spo2", "systolic_bp"]
    )


@query
def lag_lead(spark: SparkSession, sf: str) -> DataFrame:
    swings = timeseries.lag_lead(derived.readings(spark, sf))
    ordered = top(swings, 30, "patient_id", "device_id", "event_time", "trace_id")
    return ordered.drop("event_time", "trace_id")


@query
def lag_lead_all(spark: SparkSession, sf: str) -> DataFrame:
    return timeseries.lag_lead(derived.readings(spark, sf))


@query
def moving_average(spark: SparkSession, sf: str) -> DataFrame:
    smoothed = timeseries.moving_average(derived.readings(spark, sf))
    ordered = top(smoothed, 25, "patient_id", "device_id", "event_time", "trace_id")
    return ordered.drop("event_time", "trace_id")


@query
def moving_average_all(spark: SparkSession, sf: str) -> DataFrame:
    return timeseries.moving_average(derived.readings(spark, sf))


@query
def running_totals(spark: SparkSession, sf: str) -> DataFrame:
    totals = timeseries.running_totals(derived.readings(spark, sf))
    return top(totals, 25, "patient_id", "bucket_ts")


@query
def running_totals_all(spark: SparkSession, sf: str) -> DataFrame:
    return timeseries.running_totals(derived.readings(spark, sf))


@query
def top3_hr(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.top_heart_rates(derived.readings(spark, sf)).orderBy("patient_id", "rk")


@query
def hr_deciles(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.heart_rate_deciles(derived.readings(spark, sf)).orderBy("patient_id")


@query
def hr_ntiles(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.heart_rate_ntiles(derived.readings(spark, sf))


@query
def latest_per_bucket(spark: SparkSession, sf: str) -> DataFrame:
    newest = timeseries.latest_per_bucket(derived.readings(spark, sf))
    return top(newest, 15, "patient_id", "bucket_ts")


@query
def latest_per_5m_bucket(spark: SparkSession, sf: str) -> DataFrame:
    return timeseries.latest_per_bucket(derived.readings(spark, sf), "5 minutes")


@query
def abnormal_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.ranked_patients(ranking.patient_abnormal(data.vitals(spark, sf)))


@query
def abnormal_ranking_by_share(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.ranked_patients(ranking.patient_abnormal_share(data.vitals(spark, sf)))


@query
def dense_rank_hr(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.dense_rank_heart_rates(derived.readings(spark, sf))


@query
def rolling_1h(spark: SparkSession, sf: str) -> DataFrame:
    rolled = timeseries.rolling_average(derived.readings(spark, sf))
    return rolled.withColumn("rolling_avg_hr", rounded("rolling_avg_hr", 6))


@query
def rolling_24h(spark: SparkSession, sf: str) -> DataFrame:
    rolled = timeseries.rolling_average(derived.readings(spark, sf), DAY)
    return rolled.withColumn("rolling_avg_hr", rounded("rolling_avg_hr", 6))


@query
def slope_15m(spark: SparkSession, sf: str) -> DataFrame:
    slopes = timeseries.rolling_slope(derived.readings(spark, sf))
    return slopes.withColumn("slope", rounded("slope", 6))


@query
def slope_24h(spark: SparkSession, sf: str) -> DataFrame:
    slopes = timeseries.rolling_slope(derived.readings(spark, sf), DAY)
    return slopes.withColumn("slope", rounded("slope", 6))


# --- top-k ---------------------------------------------------------------------------


@query
def patient_alerts(spark: SparkSession, sf: str) -> DataFrame:
    kinds = ("5", "1000", "abc", None, "0", " 7 ")
    texts = F.array(*[F.lit(k) for k in kinds])
    asked = derived.table(spark, sf, "customer").select(
        derived.padded_id("P", "c_custkey").alias("patient_id"),
        F.element_at(texts, (F.col("c_custkey") % 6 + 1).cast("int")).alias("limit_text"),
    )
    return alerts.patient_alerts(asked, data.stored_alerts(spark, sf)).select(
        "patient_id", "limit_text", "position", "alert_id", "rule", "value"
    )


@query
def first_windows(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(summaries.first_windows(data.vitals_1m(spark, sf)))


# --- alerts and data quality ---------------------------------------------------------


def _repeated(spark: SparkSession, sf: str) -> DataFrame:
    """Readings with every fiftieth delivered a second time, later."""
    first = derived.readings(spark, sf, "event_id")
    again = first.where("event_id % 50 = 0").withColumn(
        "ingestion_time", F.col("ingestion_time") + F.expr("interval 5 seconds")
    )
    return first.unionByName(again).drop("event_id")


@query
def dedup_events(spark: SparkSession, sf: str) -> DataFrame:
    return upkeep.dedup_readings(_repeated(spark, sf))


@query
def late_readings(spark: SparkSession, sf: str) -> DataFrame:
    return upkeep.late_readings(derived.readings(spark, sf))


@query
def threshold_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.threshold_alerts(data.vitals(spark, sf))


@query
def sustained_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.sustained_alerts(derived.readings(spark, sf), max_gap_seconds=DAY)


@query
def data_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return timeseries.data_gaps(derived.readings(spark, sf), threshold_seconds=DAY)


@query
def deliver_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of the pending alerts, with keys the ledger already holds left out."""
    feed = data.change_feed(spark, sf)
    twice = feed.unionByName(feed)
    pending = alerts.pending_alerts(alerts.decode_change_image(twice))
    ledger = data.stored_alerts(spark, sf).where("event_id % 7 = 0")
    return alerts.alert_messages(pending, ledger).drop("body")


# --- features and split --------------------------------------------------------------


@query
def split_by_patient(spark: SparkSession, sf: str) -> DataFrame:
    return features.split_by_patient(derived.readings(spark, sf))


@query
def split_counts(spark: SparkSession, sf: str) -> DataFrame:
    return features.split_counts(features.split_by_patient(derived.readings(spark, sf)))


@query
def anomaly_label(spark: SparkSession, sf: str) -> DataFrame:
    return features.anomaly_labels(data.vitals(spark, sf))


@query
def split_join(spark: SparkSession, sf: str) -> DataFrame:
    labelled = features.anomaly_labels(data.vitals(spark, sf))
    split = features.split_by_patient(derived.readings(spark, sf))
    return labelled.join(split, "patient_id").groupBy("patient_id", "split").agg(
        F.count("*").alias("readings"), F.count_if("is_anomaly").alias("anomalies")
    )


# --- tables written and read back ----------------------------------------------------


@query
def patients_bootstrap(spark: SparkSession, sf: str) -> DataFrame:
    dimension = derived.patients(spark, sf)
    folder = work_folder(spark, "patients")
    return dates_as_text(readings.bootstrap_patients(spark, dimension, folder))


@query
def cohort_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Patient list written as CSV with padded ids, read back trimmed."""
    folder = work_folder(spark, "cohort")
    derived.patients(spark, sf).select(
        F.col("patient_id").alias("Id"), F.col("first_name").alias("Name")
    ).write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(folder)
    return readings.load_cohort(spark, folder)


@query
def table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    rows = derived.readings(spark, sf).select("patient_id", "heart_rate", "event_time")
    return tables.table_roundtrip(spark, rows, work_folder(spark, "roundtrip"))


@query
def split_manifest(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "manifest")
    split = features.split_by_patient(derived.readings(spark, sf))
    tables.write_manifest(spark, tables.manifest(split, EXPORT_DATE), folder)
    schema = (
        "run_date string, created_at string, feature_count bigint, split_by string, "
        "counts struct<train: bigint, val: bigint, test: bigint>"
    )
    return spark.read.schema(schema).json(folder).select(
        "run_date", "feature_count", "split_by", "counts.*"
    )


@query
def feature_export(spark: SparkSession, sf: str) -> DataFrame:
    """The export of one run date, written twice; the second run replaces the first."""
    folder = work_folder(spark, "export")
    vitals, people = data.vitals(spark, sf), derived.patients(spark, sf)
    split = features.split_by_patient(vitals)
    table = features.vitals_features(vitals, people, split, "1 hour", DAY, DAY)
    for _ in range(2):
        tables.export_features(table, folder, EXPORT_DATE)
    return spark.read.parquet(folder).groupBy(
        F.col("run_date").cast("string").alias("run_date"), "patient_id", "split"
    ).agg(F.count("*").alias("feature_rows"), F.max("max_hr").alias("max_hr"))


@query
def run_export(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "run-export")
    day = tables.run_export(
        spark,
        data.vitals(spark, sf),
        derived.patients(spark, sf),
        folder,
        f"run_date={EXPORT_DATE}",
        window="1 minute",
    )
    exported = spark.read.parquet(f"{folder}/exports/vitals_features")
    return exported.groupBy("split").agg(
        F.lit(day).alias("run_date"),
        F.countDistinct("patient_id").alias("patients"),
        F.count("*").alias("feature_rows"),
    )


@query
def replay_window(spark: SparkSession, sf: str) -> DataFrame:
    """Ten days replayed over a summary table whose counts are all wrong."""
    folder = work_folder(spark, "replay")
    tables.write_days(derived.readings(spark, sf), "event_time", f"{folder}/vitals")
    wrong = data.vitals_1m(spark, sf).withColumn(
        "reading_count", F.col("reading_count") + WRONG_ROWS
    )
    tables.write_days(wrong, "window_start", f"{folder}/vitals_1m")
    tables.replay_windows(
        spark, f"{folder}/vitals", f"{folder}/vitals_1m", date(2024, 1, 5), date(2024, 1, 14)
    )
    per_day = spark.read.parquet(f"{folder}/vitals_1m").groupBy("day").agg(
        F.count("*").alias("windows"),
        F.sum("reading_count").alias("readings"),
        F.max("max_heart_rate").alias("max_hr"),
    )
    return dates_as_text(per_day)


@query
def compact_table(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "compact")
    stream = jobs.stream_events(_live(spark, sf))
    streams.append_days(stream, "event_time", folder, f"{folder}.c", None).awaitTermination()
    tables.compact_table(spark, folder)
    exact = F.col("heart_rate").cast("decimal(12,3)")
    per_day = spark.read.parquet(folder).groupBy("day").agg(
        F.count("*").alias("readings"), F.sum(exact).cast("double").alias("hr_sum")
    )
    return dates_as_text(per_day)


@query
def apply_retention(spark: SparkSession, sf: str) -> DataFrame:
    rows = derived.readings(spark, sf)
    return upkeep.apply_retention(rows, "event_time", data.as_of(spark, sf), days=14).select(
        "patient_id", "event_time", "trace_id"
    )


# --- streams -------------------------------------------------------------------------


def _live(spark: SparkSession, sf: str) -> DataFrame:
    derived.prepare(spark)
    return derived.readings_from(readings.stream_table(spark, f"{sf}/events.parquet"))


def _stored(spark: SparkSession, stream: DataFrame, time: str, name: str) -> DataFrame:
    folder = work_folder(spark, name)
    streams.append_days(stream, time, f"{folder}/t", f"{folder}/c", None).awaitTermination()
    return untimed(tables.read_days(spark, f"{folder}/t", stream.schema))


@query
def vitals_stream_source(spark: SparkSession, sf: str) -> DataFrame:
    """Readings written as JSON lines and read as a live source."""
    folder = work_folder(spark, "source")
    derived.readings(spark, sf).write.option(
        "timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    ).json(folder)
    stream = readings.read_vitals_stream(spark, folder)
    return _stored(spark, stream, "event_time", "source-out")


@query
def vitals_sink(spark: SparkSession, sf: str) -> DataFrame:
    stream = jobs.stream_events(_live(spark, sf))
    return joined_flags(_stored(spark, stream, "event_time", "vitals"))


@query
def stream_events(spark: SparkSession, sf: str) -> DataFrame:
    stream = jobs.stream_events(_live(spark, sf)).select(
        "patient_id", "event_time", "is_abnormal"
    )
    return _stored(spark, stream, "event_time", "events")


@query
def vitals_1m_sink(spark: SparkSession, sf: str) -> DataFrame:
    stream = jobs.stream_tumble(_live(spark, sf))
    return _rounded(_stored(spark, stream, "window_start", "vitals-1m"))


@query
def vitals_hop_1m_sink(spark: SparkSession, sf: str) -> DataFrame:
    stream = jobs.stream_hop(_live(spark, sf))
    return _rounded(_stored(spark, stream, "window_start", "vitals-hop-1m"))


@query
def stream_tumble(spark: SparkSession, sf: str) -> DataFrame:
    stream = jobs.stream_tumble(_live(spark, sf), "1 hour")
    return _rounded(_stored(spark, stream, "window_start", "tumble"))


@query
def stream_hop(spark: SparkSession, sf: str) -> DataFrame:
    stream = jobs.stream_hop(_live(spark, sf), "1 hour", "30 minutes")
    return _rounded(_stored(spark, stream, "window_start", "hop"))


@query
def multi_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Rows written by the three queries of the live job."""
    folder = work_folder(spark, "job")
    for running in jobs.start_vitals_job(_live(spark, sf), folder, every=None):
        running.awaitTermination()
    names = ("vitals", "vitals_1m", "vitals_hop_1m")
    return summaries.table_counts(**{n: spark.read.parquet(f"{folder}/{n}") for n in names})


@query
def stream_late_readings(spark: SparkSession, sf: str) -> DataFrame:
    """The side output of late readings of a stream that is stopped and goes on twice."""
    folder = work_folder(spark, "late")
    source = derived.declared(READING, derived.readings(spark, sf))
    day = F.to_date("ingestion_time")
    first, last = source.agg(F.min(day), F.max(day)).first()
    third = (last - first) / 3
    early, late_from = F.lit(first + third), F.lit(first + 2 * third)
    for n, part in enumerate((day < early, (day >= early) & (day < late_from), day >= late_from)):
        source.where(part).write.parquet(f"{folder}/in/n={n}")
        stream = spark.readStream.schema(READING).parquet(f"{folder}/in/n=*")
        streams.split_late(
            stream, f"{folder}/t", f"{folder}/late", f"{folder}/marks", f"{folder}/c", every=None
        ).awaitTermination()
    late = spark.read.parquet(f"{folder}/late").drop("batch_id")
    return untimed(late.select("patient_id", "event_time", "ingestion_time", "trace_id", "seconds_late"))


@query
def stream_enrich(spark: SparkSession, sf: str) -> DataFrame:
    people = derived.patients(spark, sf).select("patient_id", "gender", "state")
    live = _live(spark, sf).select("patient_id", "event_time", "trace_id", "heart_rate")
    return _stored(spark, jobs.stream_enrich(live, people), "event_time", "enrich")


@query
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    stream = jobs.stream_dedup(_live(spark, sf)).select("patient_id", "device_id", "event_time")
    return _stored(spark, stream, "event_time", "dedup")


@query
def stream_threshold_alerts(spark: SparkSession, sf: str) -> DataFrame:
    stream = jobs.stream_threshold_alerts(_live(spark, sf)).drop("trace_id")
    return _stored(spark, stream, "event_ts", "alerts")


@query
def latest_state(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "latest")
    stream = jobs.stream_events(_live(spark, sf))
    streams.keep_latest(stream, f"{folder}/t", f"{folder}/c", None).awaitTermination()
    return streams.latest_table(spark, f"{folder}/t").drop("trace_id")


@query
def stream_sustained_alerts(spark: SparkSession, sf: str) -> DataFrame:
    stream = keyed.stream_sustained_alerts(_live(spark, sf), max_gap_seconds=DAY)
    return _stored(spark, stream, "event_ts", "sustained")


@query
def stream_data_gaps(spark: SparkSession, sf: str) -> DataFrame:
    stream = keyed.stream_data_gaps(_live(spark, sf), threshold_seconds=DAY)
    return _stored(spark, stream, "gap_start", "gaps")


_PAYLOAD = (
    "patient_id string, device_id string, event_time string, ingestion_time string, "
    "heart_rate double, systolic_bp double, diastolic_bp double, spo2 double, "
    "temperature double, resp_rate double, trace_id string"
)


def _routed(spark: SparkSession, sf: str, result: str) -> DataFrame:
    """Archive records of a stream as they were stored, with the folders they are in.

    Records are taken to arrive in three deliveries a day.
    """
    folder = work_folder(spark, "archive")
    given = derived.raw_payloads(spark, sf, "ingestion_time")
    eighth = F.floor(F.hour("ingestion_time") / 8).cast("int") * 8
    arrived = F.date_trunc("day", "ingestion_time") + F.make_dt_interval(hours=eighth)
    given.select("recordId", "data", arrived.alias("arrived_at")).write.parquet(f"{folder}/in")
    records = readings.stream_table(spark, f"{folder}/in")
    streams.route_stream(
        records, f"{folder}/t", f"{folder}/c", None, "arrived_at"
    ).awaitTermination()
    schema = "recordId string, data string, problem string, payload string"
    folders = "result string, year string, month string, day string, hour string, batch_id bigint"
    stored = spark.read.schema(f"{schema}, {folders}").json(f"{folder}/t")
    return stored.where(F.col("result") == result)


@query
def raw_archive(spark: SparkSession, sf: str) -> DataFrame:
    """Every field of the archived payloads, by the hour folder they were written to."""
    body = F.from_json(F.unbase64("data").cast("string"), _PAYLOAD)
    return _routed(spark, sf, "Ok").select(
        "year", "month", "day", "hour", "recordId", body.alias("_row")
    ).select("year", "month", "day", "hour", "recordId", "_row.*")


@query
def dead_letter(spark: SparkSession, sf: str) -> DataFrame:
    """Rejected archive records of a stream, with the reason."""
    return _routed(spark, sf, "Dropped").select("recordId", "problem")


@query
def live_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """A live source in which every tenth line is no JSON and every other tenth is mistyped."""
    folder = work_folder(spark, "live")
    source = derived.readings(spark, sf, "event_id")
    whole = F.to_json(F.struct(*[c for c in source.columns if c != "event_id"]))
    tenth = F.col("event_id") % 10
    mistyped = F.regexp_replace(whole, '"heart_rate":[^,}]*', '"heart_rate":"fast"')
    line = F.when(tenth == 0, "####not-json####").when(tenth == 1, mistyped).otherwise(whole)
    source.select(line).write.text(f"{folder}/in")
    streams.append_checked(
        readings.read_vitals_lines(spark, f"{folder}/in"), "event_time",
        f"{folder}/t", f"{folder}/failed", f"{folder}/c", None,
    ).awaitTermination()
    sound = tables.read_days(spark, f"{folder}/t").select(
        "trace_id", "heart_rate", F.lit(None).cast("string").alias("problem")
    )
    failed = spark.read.schema("problem string, payload string").json(f"{folder}/failed")
    return sound.unionByName(
        failed.select(
            F.get_json_object("payload", "$.trace_id").alias("trace_id"),
            F.lit(None).cast("double").alias("heart_rate"),
            "problem",
        )
    )


def _refuse_one_patient(message: dict) -> None:
    if message["patient_id"] == "P000007":
        raise ValueError("refused")


@query
def delivery_loop(spark: SparkSession, sf: str) -> DataFrame:
    """The alerts table after two batches of its change feed; one patient's messages fail."""
    folder = work_folder(spark, "delivery")
    feed, table = data.change_feed(spark, sf), data.stored_alerts(spark, sf)
    feed.withColumn("image", F.to_json("image")).write.parquet(f"{folder}/in/n=0")
    spark.read.parquet(f"{folder}/in/n=0").write.parquet(f"{folder}/in/n=1")
    changes = spark.readStream.schema("op string, image string").parquet(f"{folder}/in/n=*")
    streams.deliver_alerts(
        changes.withColumn("image", F.parse_json("image")), _refuse_one_patient,
        f"{folder}/ledger", f"{folder}/c", None,
    ).awaitTermination()
    marked = streams.with_deliveries(table, streams.read_ledger(spark, f"{folder}/ledger"))
    return marked.select(
        "patient_id", "alert_id", "sent", F.col("delivery_ts").isNotNull().alias("delivered")
    )
