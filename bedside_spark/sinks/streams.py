"""Streaming writers. Every query has its own checkpoint and commits per trigger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from bedside_spark.functions.timekit import micros
from bedside_spark.operators import alerts, ingest, upkeep
from bedside_spark.sinks import files, manifest, outbox, tables

COMMIT_EVERY = "10 seconds"
ARCHIVE_EVERY = "60 seconds"
BUCKETS = 64


def triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """``every`` is the commit cadence; None takes what is there and stops."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def append_days(
    stream: DataFrame, time: str, path: str, checkpoint: str, every: str | None = COMMIT_EVERY
) -> StreamingQuery:
    """Append rows to a table with one folder per day and, in it, one per batch.

    A batch that is tried again replaces its own folders. There is no other record of what
    belongs to the table, so replay, compaction and retention may change it meanwhile.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        tables.write_days(batch, time, path, "overwrite", batch_id)

    files.create(stream.sparkSession, path)
    writer = stream.writeStream.outputMode("append").foreachBatch(write)
    return triggered(writer.option("checkpointLocation", checkpoint), every).start()


def route_stream(
    records: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = ARCHIVE_EVERY,
    arrived: str | None = None,
) -> StreamingQuery:
    """Gzip JSON archive of normalised payloads and, beside them, of rejected records.

    Both go out in one write, to ``result=Ok`` and ``result=Dropped``, each with year, month,
    day and hour folders of the arrival: column ``arrived``, or now. Folders end with the batch
    id, so a batch that is tried again replaces its own files.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        at = F.col(arrived) if arrived else F.current_timestamp()
        parts = {
            "year": F.date_format(at, "yyyy"),
            "month": F.date_format(at, "MM"),
            "day": F.date_format(at, "dd"),
            "hour": F.date_format(at, "HH"),
            "batch_id": F.lit(batch_id).cast("bigint"),
        }
        routed = ingest.route_records(batch).withColumns(parts)
        (
            routed.select("recordId", "data", "problem", "payload", "result", *parts)
            .hint("rebalance", "result", *parts)
            .write.option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .option("compression", "gzip")
            .partitionBy("result", *parts)
            .json(path)
        )

    files.create(records.sparkSession, path)
    writer = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return triggered(writer, every).start()


def append_checked(
    lines: DataFrame,
    time: str,
    path: str,
    rejected: str,
    checkpoint: str,
    every: str | None = COMMIT_EVERY,
) -> StreamingQuery:
    """Append the sound readings of a live source to a day table and the others to ``rejected``.

    ``lines`` comes from :func:`sources.readings.read_vitals_lines`.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        sound = batch.where("problem is null").drop("problem", "payload")
        tables.write_days(sound, time, path, "overwrite", batch_id)
        batch.where("problem is not null").select("problem", "payload").write.mode(
            "overwrite"
        ).option("compression", "gzip").json(f"{rejected}/batch_id={batch_id}")

    for folder in (path, rejected):
        files.create(lines.sparkSession, folder)
    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return triggered(writer, every).start()


def latest_table(spark: SparkSession, root: str) -> DataFrame:
    """The latest-state table as the newest manifest names it."""
    _, folders = manifest.newest(spark, root)
    return spark.read.parquet(*(f"{root}/{f}" for f in folders.values()))


def keep_latest(
    vitals: DataFrame,
    root: str,
    checkpoint: str,
    every: str | None = COMMIT_EVERY,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Upsert each batch into a latest-state table of ``buckets`` by the patient's hash.

    A batch rewrites the buckets of its patients, to folders of its own, and manifest ``n`` names
    each bucket's folder after batch ``n``. It is made from the newest manifest before ``n``, so a
    repeated batch does the same again, and readers see the table before or after a batch. Folders
    that neither the last two manifests name are removed. The number of buckets stays as it was
    when the table was made.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _, before = manifest.newest(spark, root, below=batch_id)
        bucket = F.pmod(F.xxhash64("patient_id"), F.lit(buckets)).cast("int")
        arrived = alerts.latest_state(batch)
        touched = [r[0] for r in batch.select(bucket).distinct().collect()]
        if not touched:
            return
        stored = [f"{root}/{before[str(b)]}" for b in touched if str(b) in before]
        if stored:
            arrived = alerts.merge_latest(spark.read.parquet(*stored), arrived)
        (
            arrived.withColumn("bucket", bucket)
            .repartition("bucket")
            .write.mode("overwrite")
            .partitionBy("bucket")
            .parquet(f"{root}/batch={batch_id}")
        )
        after = before | {str(b): f"batch={batch_id}/bucket={b}" for b in touched}
        manifest.put(spark, root, batch_id, after)
        named = set(after.values()) | set(before.values())
        for folder in [n for n in files.folders(spark, root) if n.startswith("batch=")]:
            for own in files.folders(spark, f"{root}/{folder}"):
                if int(folder[6:]) < batch_id and f"{folder}/{own}" not in named:
                    files.delete(spark, f"{root}/{folder}/{own}")

    files.create(vitals.sparkSession, root)
    writer = vitals.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return triggered(writer, every).start()


def split_late(
    vitals: DataFrame,
    path: str,
    late_path: str,
    marks: str,
    checkpoint: str,
    window_seconds: int = 60,
    delay_seconds: int = 10,
    every: str | None = COMMIT_EVERY,
) -> StreamingQuery:
    """Append readings that came in time to a day table, and late ones to a side output.

    Each reading is judged by the newest event time of all that arrived before it: in its own
    batch by order of arrival, and in earlier batches, of which each leaves its newest event time
    in ``marks``. Batches must follow the order of arrival. All three outputs are keyed by batch
    id, so a batch that is tried again replaces its own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = spark.read.schema("newest bigint, batch_id bigint").parquet(marks)
        before = earlier.where(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
        judged = upkeep.with_lateness(batch, window_seconds, delay_seconds, before=before)
        in_time = judged.where("seconds_late is null").drop("seconds_late")
        tables.write_days(in_time, "event_time", path, "overwrite", batch_id)
        late = judged.where("seconds_late is not null")
        late.write.mode("overwrite").parquet(f"{late_path}/batch_id={batch_id}")
        batch.agg(F.max(micros("event_time")).alias("newest")).write.mode("overwrite").parquet(
            f"{marks}/batch_id={batch_id}"
        )

    for folder in (path, late_path, marks):
        files.create(vitals.sparkSession, folder)
    writer = vitals.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return triggered(writer, every).start()


def report_late(
    vitals: DataFrame,
    path: str,
    marks: str,
    checkpoint: str,
    window_seconds: int = 60,
    delay_seconds: int = 10,
    every: str | None = COMMIT_EVERY,
) -> StreamingQuery:
    """Report readings whose window had closed by the end of the batches before.

    Each batch leaves one row with its newest event time in ``marks``; both outputs are
    keyed by batch id. The greatest earlier mark, less the delay, is the watermark.
    """
    width = window_seconds * 1_000_000

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if files.exists(spark, marks):
            earlier = spark.read.schema("newest bigint, batch_id bigint").parquet(marks)
            newest = earlier.where(F.col("batch_id") < batch_id).agg(F.max("newest")).scalar()
            closes = (F.floor(micros("event_time") / width) + 1) * width
            batch.where(closes <= newest - delay_seconds * 1_000_000).write.mode(
                "overwrite"
            ).parquet(f"{path}/batch_id={batch_id}")
        batch.agg(F.max(micros("event_time")).alias("newest")).write.mode("overwrite").parquet(
            f"{marks}/batch_id={batch_id}"
        )

    writer = vitals.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return triggered(writer, every).start()


_OUTCOME = "patient_id string, alert_id string, delivered boolean, error string"


def send_messages(
    messages: DataFrame, send: Callable[[dict], None], claims: outbox.Claims
) -> DataFrame:
    """Hand every message to ``send`` on the executors, once; one outcome row per message.

    ``claims`` decides who sends: a task that runs again finds what its first run claimed.
    """
    return messages.select("patient_id", "alert_id", "subject", "body").mapInPandas(
        outbox.sender(send, claims), _OUTCOME
    )


_LEDGER = f"{_OUTCOME}, delivered_at timestamp, day date, batch_id bigint"


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """Outcomes of all deliveries, by the day of the alert's event."""
    return spark.read.schema(_LEDGER).parquet(ledger)


def with_deliveries(table: DataFrame, ledger: DataFrame) -> DataFrame:
    """The alerts table with ``sent`` and ``delivery_ts`` as the deliveries left them."""
    done = ledger.where("delivered").groupBy("patient_id", "alert_id")
    return alerts.mark_sent(table, done.agg(F.min("delivered_at").alias("_at")), F.col("_at"))


def deliver_alerts(
    changes: DataFrame,
    send: Callable[[dict], None],
    ledger: str,
    checkpoint: str,
    every: str | None = "1 second",
    claims: outbox.Claims | None = None,
) -> StreamingQuery:
    """Send pending alerts of a change feed and record each outcome.

    Every message is claimed before it is sent (``sinks.outbox``), in a folder beside the ledger
    unless other ``claims`` are given, so tasks and batches that run again send nothing twice. That
    folder needs file locks that hold between the executors.

    The ledger has a folder per day of the alerts' events and per batch. Keys delivered in
    earlier batches are left out before sending, for which only the ledger's days between the
    batch's first and last alert are read; failed ones stay eligible and are retried when the
    feed shows them again. :func:`with_deliveries` marks the alerts table by it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        pending = alerts.pending_alerts(alerts.decode_change_image(batch))
        day = F.coalesce(F.to_date(F.substring("event_ts", 1, 10)), F.lit("1970-01-01").cast("date"))
        first, last = pending.agg(F.min(day), F.max(day)).first()
        if first is None:
            return
        past = read_ledger(spark, ledger).where(F.col("day").between(F.lit(first), F.lit(last)))
        sent = past.where((F.col("batch_id") < batch_id) & F.col("delivered"))
        messages = alerts.alert_messages(pending, sent)
        days = messages.select("patient_id", "alert_id", day.alias("day")).dropDuplicates(
            ["patient_id", "alert_id"]
        )
        (
            send_messages(messages, send, own_claims)
            .withColumn("delivered_at", F.when(F.col("delivered"), F.current_timestamp()))
            .join(days, ["patient_id", "alert_id"])
            .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.option("partitionOverwriteMode", "dynamic")
            .mode("overwrite")
            .partitionBy("day", "batch_id")
            .parquet(ledger)
        )

    own_claims = claims or outbox.PackedClaims(f"{ledger.rstrip('/')}.claims")
    files.create(changes.sparkSession, ledger)
    writer = changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return triggered(writer, every).start()
