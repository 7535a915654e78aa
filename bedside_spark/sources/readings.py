"""Readers for live readings, cohort lists and the patient dimension."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from bedside_spark.schemas import READING
from bedside_spark.sinks import files


def _is_folder(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.getFileStatus(where).isDirectory()


#: Files a micro-batch takes, so that a backlog does not come as one batch.
FILES_PER_BATCH = 1000


def stream_table(
    spark: SparkSession, path: str, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """A Parquet table as a stream, whether it is a folder or a single file."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if _is_folder(spark, path):
        return reader.parquet(path)
    folder, _, name = path.rstrip("/").rpartition("/")
    return reader.option("pathGlobFilter", name).parquet(folder)


def first_start(spark: SparkSession, mark: str) -> datetime:
    """The instant noted at ``mark``, which is now if nothing was noted yet."""
    if not files.exists(spark, f"{mark}/_SUCCESS"):
        now = spark.createDataFrame([(datetime.now(UTC).isoformat(),)], "opened string")
        now.coalesce(1).write.mode("overwrite").json(mark)
    noted = spark.read.schema("opened string").json(mark).first()
    return datetime.fromisoformat(noted.opened)


_REJECTED = "_rejected"


def read_vitals_lines(
    spark: SparkSession,
    location: str,
    *,
    connector: str = "json",
    start: str | datetime = "earliest",
    options: dict[str, str] | None = None,
    mark: str | None = None,
) -> DataFrame:
    """Live records with the declared schema, ``problem`` and, where there is one, ``payload``.

    ``connector`` "json" reads ISO-8601 JSON lines from a folder. Any other connector
    ("kafka", …) is loaded by name with ``options``; its ``value`` column holds the JSON.
    ``start`` is "earliest", "latest" or an instant. A folder has no offsets: "latest" keeps
    the files written from the first start on, and an instant filters by event time. The first
    start is noted at ``mark``, a path beside the query's checkpoint, so that a restart does
    not skip what arrived while the job was down.

    A line that is no JSON object, has a field of another type than declared, or lacks the
    patient or the event time has a problem; blank lines are left out.
    """
    extra = dict(options or {})
    if connector == "json":
        extra.setdefault("maxFilesPerTrigger", str(FILES_PER_BATCH))
        stream = spark.readStream.options(**extra).text(location)
        if start == "latest":
            if mark is None:
                raise ValueError('start="latest" needs a mark that outlives the query')
            opened = first_start(spark, mark)
            stream = stream.where(F.col("_metadata.file_modification_time") >= F.lit(opened))
    else:
        if isinstance(start, datetime):
            extra.setdefault("startingTimestamp", str(int(start.timestamp() * 1000)))
        else:
            extra.setdefault("startingOffsets", start)
        stream = spark.readStream.format(connector).options(**extra).load()
    text = F.col("value").cast("string")
    schema = StructType([*READING.fields, StructField(_REJECTED, StringType())])
    parsed = F.from_json(text, schema, {"columnNameOfCorruptRecord": _REJECTED})
    rows = stream.select(text.alias("payload"), parsed.alias("_row")).where("trim(payload) <> ''")
    problem = (
        F.when(F.col("_row").isNull() | F.col(f"_row.{_REJECTED}").isNotNull(), "not a reading")
        .when(F.col("_row.patient_id").isNull(), "missing patient_id")
        .when(F.col("_row.event_time").isNull(), "missing event_time")
    )
    rows = rows.withColumn("problem", problem).select(
        *[F.col(f"_row.{f.name}") for f in READING.fields],
        "problem",
        F.when(F.col("problem").isNotNull(), F.col("payload")).alias("payload"),
    )
    if isinstance(start, datetime):
        rows = rows.where(F.col("problem").isNotNull() | (F.col("event_time") >= F.lit(start)))
    arrival = F.coalesce("ingestion_time", F.current_timestamp())
    return rows.withColumn("ingestion_time", arrival)


def read_vitals_stream(spark: SparkSession, location: str, **settings) -> DataFrame:
    """The sound readings of :func:`read_vitals_lines`, whose settings it takes.

    ``sinks.streams.append_checked`` keeps the others as well.
    """
    lines = read_vitals_lines(spark, location, **settings)
    return lines.where("problem is null").drop("problem", "payload")


def read_between(
    spark: SparkSession, path: str, time: str, first: datetime, last: datetime
) -> DataFrame:
    """Rows of a day-partitioned table within ``[first, last)``.

    The day filter follows from the time range; it is stated because plain Parquet prunes
    folders by their partition column only.
    """
    table = spark.read.parquet(path)
    days = F.col("day").between(F.lit(first.date()), F.lit(last.date()))
    return table.where(days & (F.col(time) >= F.lit(first)) & (F.col(time) < F.lit(last)))


def load_cohort(spark: SparkSession, path: str) -> DataFrame:
    """Patient ids of a CSV: column ``patient_id``, else the first column; blanks dropped."""
    table = spark.read.csv(path, header=True)
    column = "patient_id" if "patient_id" in table.columns else table.columns[0]
    # White space at either end, tabs included, is no part of an id.
    named = F.regexp_replace(F.col(f"`{column}`"), r"^\s+|\s+$", "")
    return table.select(named.alias("patient_id")).where("patient_id <> ''")


def bootstrap_patients(spark: SparkSession, patients: DataFrame, path: str) -> DataFrame:
    """(Re)create the dimension at ``path`` and read it back; running it again changes nothing."""
    patients.write.mode("overwrite").parquet(path)
    return (
        spark.read.parquet(path)
        .select("patient_id", "first_name", "gender", "birth_date", "state")
        .orderBy("patient_id")
    )
