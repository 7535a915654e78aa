"""Alerts: threshold and sustained rules, change feed, delivery, lookups."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bedside_spark.functions.rules import (
    MEASURES,
    RULES,
    SUSTAINED_RULE,
    SUSTAINED_SECONDS,
    Rule,
    fires,
)
from bedside_spark.functions.timekit import ISO_MICROS, micros, moment, seconds_between
from bedside_spark.operators.ordered import (
    HOT_ROWS,
    own_rows,
    running,
    slice_window,
    with_neighbours,
    with_slices,
)
from bedside_spark.operators.timeseries import ORDER

KEY = ("patient_id", "alert_id")
# Fields of a notification, its subject, and the lookup key pattern.
MESSAGE_FIELDS = ("patient_id", "alert_id", "rule", "severity", "value", "threshold", "event_ts")
SUBJECT = "Vitals alert: "
PATIENT_KEY = r"^[A-Za-z0-9][A-Za-z0-9_.-]{0,63}\z"
DEFAULT_LIMIT, MAX_LIMIT = 10, 100


def alert_id(event_time: Column, rule: Column) -> Column:
    return F.concat(F.lit("A-"), F.date_format(event_time, ISO_MICROS), F.lit("-"), rule)


def _fired(rule: Rule) -> Column:
    return F.struct(
        F.lit(rule.name).alias("rule"),
        F.lit(rule.description).alias("description"),
        F.lit(rule.severity).alias("severity"),
        F.col(rule.measure).alias("value"),
        F.lit(rule.threshold).alias("threshold"),
    )


_ALERT_COLUMNS = (
    "patient_id", "alert_id", "rule", "description", "severity", "value", "threshold",
    "event_ts", "resolved", "sent", "created_at",
)


def threshold_alert_rows(vitals: DataFrame, *extra: str) -> DataFrame:
    """One row per reading and fired rule, before duplicates are removed."""
    fired = F.array_compact(F.array(*[F.when(fires(r), _fired(r)) for r in RULES]))
    return (
        vitals.withColumn("_fired", F.explode(fired))
        .withColumn("event_ts", F.col("event_time"))
        .select(
            "patient_id",
            alert_id(F.col("event_time"), F.col("_fired.rule")).alias("alert_id"),
            "_fired.*",
            "event_ts",
            F.lit(False).alias("resolved"),
            F.lit(False).alias("sent"),
            F.col("event_time").alias("created_at"),
            "trace_id",
            *extra,
        )
    )


def threshold_alerts(vitals: DataFrame, *extra: str) -> DataFrame:
    """Threshold alerts, unique by (patient_id, alert_id); the smallest trace id survives."""
    rows = threshold_alert_rows(vitals, *extra)
    kept = [c for c in (*_ALERT_COLUMNS, *extra) if c not in KEY]
    return (
        rows.groupBy(*KEY)
        .agg(F.min_by(F.struct(*kept), "trace_id").alias("_row"))
        .select(*KEY, "_row.*")
    )


def sustained_alerts(
    vitals: DataFrame,
    max_gap_seconds: float = 60.0,
    hold_seconds: float = SUSTAINED_SECONDS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """One alert per run of high heart rate that lasts at least ``hold_seconds``.

    A run is a stretch of consecutive readings at or above the threshold whose gaps stay
    within ``max_gap_seconds``. The alert is its first reading that is late enough.
    """
    threshold = SUSTAINED_RULE.threshold
    columns = vitals.select("patient_id", "heart_rate", *ORDER)
    sliced = with_slices(columns, "patient_id", "event_time", hot_rows)
    ordered = slice_window("patient_id", ORDER)
    high = F.coalesce(F.col("heart_rate") >= threshold, F.lit(False))
    marked = with_neighbours(
        sliced.withColumn("_high", high), "patient_id", ORDER, before=1
    ).withColumns(
        {
            "_after_high": F.lag("_high").over(ordered),
            "_after": F.lag("event_time").over(ordered),
        }
    )
    continues = F.col("_after_high") & (
        seconds_between("_after", "event_time") <= max_gap_seconds
    )
    starts = F.col("_high") & ~F.coalesce(continues, F.lit(False))
    marked = own_rows(marked).withColumn("_starts", starts)
    in_run = running(
        marked,
        "patient_id",
        ORDER,
        {"_run_start": ("max", F.when(F.col("_starts"), F.col("event_time")))},
    )
    lasting = in_run.where(
        F.col("_high") & (seconds_between("_run_start", "event_time") >= hold_seconds)
    )
    first = F.min_by(F.struct("event_time", "heart_rate"), F.struct(*ORDER))
    return (
        lasting.groupBy("patient_id", F.col("_run_start").alias("run_start"))
        .agg(first.alias("_first"))
        .select(
            "patient_id",
            alert_id(F.col("_first.event_time"), F.lit(SUSTAINED_RULE.name)).alias("alert_id"),
            F.lit(SUSTAINED_RULE.name).alias("rule"),
            F.lit(SUSTAINED_RULE.description).alias("description"),
            F.lit(SUSTAINED_RULE.severity).alias("severity"),
            F.col("_first.heart_rate").alias("value"),
            F.lit(threshold).alias("threshold"),
            F.col("_first.event_time").alias("event_ts"),
            "run_start",
        )
    )


def alert_history(
    alerts: DataFrame, as_of: datetime | Column, days: int = 7, count: int = 50
) -> DataFrame:
    """The newest sent alerts of the last ``days``."""
    since = moment(as_of) - F.make_dt_interval(days=F.lit(days))
    return (
        alerts.where(F.col("sent") & (F.col("event_ts") >= since))
        .orderBy(F.col("event_ts").desc(), "patient_id", "rule")
        .select("patient_id", "rule", "severity", "value", "threshold", "event_ts")
        .limit(count)
    )


# --- change feed ---------------------------------------------------------------------


def _tagged(field: str, tag: str, kind: str) -> Column:
    return F.try_variant_get("image", f"$.{field}.{tag}", kind)


def decode_change_image(changes: DataFrame) -> DataFrame:
    """Tagged new images as typed columns.

    A number is an integer unless its text has a point or an exponent; ``value_kind`` says
    which, and the column itself is a double.
    """
    number = _tagged("value", "N", "string")
    return changes.select(
        "op",
        _tagged("patient_id", "S", "string").alias("patient_id"),
        _tagged("alert_id", "S", "string").alias("alert_id"),
        _tagged("rule", "S", "string").alias("rule"),
        _tagged("severity", "S", "string").alias("severity"),
        number.try_cast("double").alias("value"),
        F.when(number.rlike("[.Ee]"), "float").when(number.isNotNull(), "int").alias("value_kind"),
        _tagged("threshold", "N", "string").try_cast("double").alias("threshold"),
        _tagged("event_ts", "S", "string").alias("event_ts"),
        F.coalesce(
            *[_tagged("sent", tag, "string") for tag in ("BOOL", "S", "N")]
        ).alias("sent"),
    )


def pending_alerts(decoded: DataFrame) -> DataFrame:
    """Inserted or modified rows that still need a notification."""
    unsent = F.coalesce(F.lower(F.col("sent").cast("string")), F.lit("false")) == "false"
    return decoded.where(F.col("op").isin("INSERT", "MODIFY") & unsent)


def alert_messages(pending: DataFrame, already_sent: DataFrame | None = None) -> DataFrame:
    """Notification rows, one per alert however often the feed repeats it.

    ``already_sent`` holds keys delivered before; they are dropped before anything is sent.
    """
    rest = [c for c in MESSAGE_FIELDS if c not in KEY]
    once = (
        pending.groupBy(*KEY)
        .agg(F.min(F.struct(*rest)).alias("_row"))
        .select(*KEY, "_row.*")
    )
    if already_sent is not None:
        once = once.join(already_sent.select(*KEY), list(KEY), "left_anti")
    return once.select(
        *MESSAGE_FIELDS,
        F.concat(F.lit(SUBJECT), F.col("rule")).alias("subject"),
        F.to_json(F.struct(*MESSAGE_FIELDS)).alias("body"),
    )


def mark_sent(alerts: DataFrame, delivered: DataFrame, at: datetime | Column) -> DataFrame:
    """Set ``sent`` and ``delivery_ts`` on delivered alerts that were not marked before.

    ``at`` may be a column of ``delivered`` whose name starts with an underscore.
    """
    extra = [c for c in delivered.columns if c.startswith("_")]
    keys = delivered.select(*KEY, *extra).dropDuplicates(list(KEY))
    keys = keys.withColumn("_delivered", F.lit(True))
    due = F.col("_delivered") & ~F.coalesce(F.col("sent"), F.lit(False))
    kind = alerts.schema["event_ts"].dataType
    before = (
        F.col("delivery_ts") if "delivery_ts" in alerts.columns else F.lit(None).cast(kind)
    )
    return (
        alerts.join(keys, list(KEY), "left")
        .withColumn("delivery_ts", F.when(due, moment(at).cast(kind)).otherwise(before))
        .withColumn("sent", F.when(due, True).otherwise(F.col("sent")))
        .drop("_delivered")
        .select(*dict.fromkeys((*alerts.columns, "delivery_ts")))
    )


# --- read models ---------------------------------------------------------------------


def latest_state(vitals: DataFrame) -> DataFrame:
    """Newest reading per patient, last write wins by event time."""
    kept = [*MEASURES, "event_time", "is_abnormal", "trace_id"]
    newest = F.max_by(F.struct(*kept), F.struct(*ORDER))
    return vitals.groupBy("patient_id").agg(newest.alias("_row")).select("patient_id", "_row.*")


def merge_latest(current: DataFrame, arrived: DataFrame) -> DataFrame:
    """Upsert: the newer of the stored and the arrived reading of each patient."""
    return latest_state(current.unionByName(arrived.select(*current.columns)))


def with_expiry(df: DataFrame, time: str, days: int) -> DataFrame:
    """Add the epoch second after which a row is invisible."""
    epoch = F.floor(micros(time) / 1_000_000) + days * 86_400
    return df.withColumn("expires_at", epoch.cast("bigint"))


def not_expired(df: DataFrame, as_of: datetime | Column) -> DataFrame:
    now = F.floor(micros(moment(as_of)) / 1_000_000)
    return df.where(F.col("expires_at").isNull() | (F.col("expires_at") > now))


def valid_key(column: str) -> Column:
    return F.coalesce(F.col(column).rlike(PATIENT_KEY), F.lit(False))


def latest_lookup(requests: DataFrame, latest: DataFrame) -> DataFrame:
    """Status 200, 404 or 400 per requested key, with the latest reading where there is one."""
    found = latest.withColumn("_found", F.lit(True))
    status = F.when(~valid_key("patient_id"), 400).when(F.col("_found"), 200).otherwise(404)
    return (
        requests.join(found, "patient_id", "left")
        .withColumn("status", status.cast("bigint"))
        .drop("_found")
    )


def clamped_limit(text: Column) -> Column:
    """Limit parameter: 10 unless it is an integer, then held within 1..100."""
    trimmed = F.trim(text)
    number = F.when(trimmed.rlike(r"^[+-]?[0-9]+\z"), trimmed.try_cast("decimal(38,0)"))
    beyond = trimmed.rlike(r"^[+-]?[0-9]{39,}\z")
    huge = F.when(trimmed.startswith("-"), 1).otherwise(MAX_LIMIT)
    held = F.greatest(F.lit(1), F.least(F.lit(MAX_LIMIT), number)).cast("int")
    return F.coalesce(F.when(beyond, huge), F.when(number.isNotNull(), held), F.lit(DEFAULT_LIMIT))


def newest_alerts(alerts: DataFrame, count: int = MAX_LIMIT) -> DataFrame:
    """Per patient, the first ``count`` alerts by descending alert id."""
    ordered = Window.partitionBy("patient_id").orderBy(F.col("alert_id").desc())
    return alerts.withColumn("position", F.row_number().over(ordered).cast("bigint")).where(
        F.col("position") <= count
    )


def patient_alerts(requests: DataFrame, alerts: DataFrame) -> DataFrame:
    """Alert lists for (patient_id, limit_text) requests.

    Alerts are cut to the largest allowed limit per patient before they meet the requests.
    """
    asked = requests.withColumn("_limit", clamped_limit(F.col("limit_text")))
    return (
        asked.join(newest_alerts(alerts), "patient_id")
        .where(F.col("position") <= F.col("_limit"))
        .drop("_limit")
    )
