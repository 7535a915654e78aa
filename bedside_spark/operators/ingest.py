"""Archive records: decode, validate, normalise, and answer one row per input record.

Everything is one stage of column expressions. The JSON is held as VARIANT because the
rules depend on the difference between an absent field and an explicit null, and on the
JSON type of a value.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedside_spark.functions.numbers import round_exact
from bedside_spark.functions.rules import MEASURES, with_flags
from bedside_spark.functions.timekit import ISO_MICROS

# Fields a reading must have, and measures that default to 0.0 when absent.
REQUIRED = ("patient_id", "device_id", "event_time", "heart_rate", "spo2", "systolic_bp")
DEFAULTED = ("diastolic_bp", "temperature", "resp_rate")
TEXT_FIELDS = ("patient_id", "device_id", "event_time")

_NUMERIC = ("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN")


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns by a one-row generator.

    Filters are pushed through projections but not through generators, so a later
    ``where`` cannot repeat the parsing in its condition.
    """
    row = F.struct(*[col.alias(name) for name, col in columns.items()])
    return df.select("*", F.inline(F.array(row)))


# Groups of four are sound base64 if they also match this, which costs less than Spark's own check.
_PLAIN = r"^[A-Za-z0-9+/]+={0,2}\z"


def _decoded(text: Column, usable: Column | bool = True) -> Column:
    whole = F.length(text) % 4 == 0
    read = F.when(text.rlike(_PLAIN), F.unbase64(text)).otherwise(
        F.try_to_binary(text, F.lit("base64"))
    )
    return F.when(whole & usable, read)


def decode_payload(records: DataFrame) -> DataFrame:
    """(recordId, data) plus the payload text and its parsed form, NULL when unreadable.

    Characters outside the base64 alphabet are skipped and invalid UTF-8 is replaced.
    """
    given = F.coalesce("data", F.lit(""))
    spaced = given.contains(" ") | given.contains("\n") | given.contains("\r")
    letters = F.regexp_replace(given, "[^A-Za-z0-9+/=]", "")
    binary = F.coalesce(_decoded(given, ~(spaced | given.contains("\t"))), _decoded(letters))
    text = F.make_valid_utf8(binary.cast("string"))
    return records.withColumn("payload", text).withColumn("_json", F.try_parse_json("payload"))


_OPTIONAL_TEXT = ("ingestion_time", "trace_id")


def _part(field: str, kind: str) -> Column:
    return F.try_variant_get("_json", f"$.{field}", kind)


def _kind(field: str) -> Column:
    """JSON type of a field: NULL when it is absent, VOID for an explicit null."""
    return F.schema_of_variant(_part(field, "variant"))


def _with_fields(decoded: DataFrame) -> DataFrame:
    """Texts, numbers and the types of numbers as columns, so that each is extracted once.

    The type of a text field matters for unusual values only and is looked up there.
    """
    return _once(
        decoded,
        _is_object=F.try_variant_get("_json", "$", "struct<patient_id: variant>").isNotNull(),
        **{f"_text_{f}": _part(f, "string") for f in (*TEXT_FIELDS, *_OPTIONAL_TEXT)},
        **{f"_type_{m}": _kind(m) for m in MEASURES},
        **{f"_number_{m}": _part(m, "double") for m in MEASURES},
    )


def _absent(field: str) -> Column:
    if field in MEASURES:
        return F.col(f"_type_{field}").isNull()
    return F.col(f"_text_{field}").isNull() & _kind(field).isNull()


def _defects() -> dict[str, Column]:
    found = {f"missing {f}": _absent(f) for f in REQUIRED}
    for measure in MEASURES:
        finite = F.abs(F.col(f"_number_{measure}")) < float("inf")
        kind = F.col(f"_type_{measure}")
        numeric = kind.isin(*_NUMERIC) | kind.startswith("DECIMAL")
        sound = numeric & F.coalesce(finite, F.lit(False))
        found[f"not a number: {measure}"] = ~_absent(measure) & ~sound
    return found


def validate_reading(decoded: DataFrame) -> DataFrame:
    """Add ``problem``: NULL for a sound reading, else the first reason to drop it.

    Numeric text and explicit nulls are rejected; JSON booleans count as 0 and 1.
    """
    problem = F.when(~F.col("_is_object"), "not a JSON object")
    for reason, condition in _defects().items():
        problem = problem.when(condition, reason)
    return _with_fields(decoded).withColumn("problem", problem)


def _text(field: str) -> Column:
    value, kind = F.col(f"_text_{field}"), _kind(field)
    return (
        F.when(value.isNull(), F.when(kind == "VOID", "None").otherwise(F.to_json(_part(field, "variant"))))
        .when(value.isin("true", "false") & (kind == "BOOLEAN"), F.initcap(value))
        .otherwise(value)
    )


def _measure(field: str) -> Column:
    value = round_exact(F.col(f"_number_{field}"))
    return F.when(_absent(field), 0.0).otherwise(value) if field in DEFAULTED else value


def _typed(validated: DataFrame, arrived: datetime | Column | None) -> DataFrame:
    stamp = F.current_timestamp() if arrived is None else arrived
    stamp = stamp if isinstance(stamp, Column) else F.lit(stamp)
    columns = {
        **{field: _text(field) for field in TEXT_FIELDS},
        "ingestion_time": F.when(
            _absent("ingestion_time"), F.date_format(stamp, ISO_MICROS)
        ).otherwise(F.col("_text_ingestion_time")),
        **{measure: _measure(measure) for measure in MEASURES},
        "trace_id": F.when(_absent("trace_id"), "").otherwise(_text("trace_id")),
    }
    return with_flags(
        validated.select("*", *[col.alias(name) for name, col in columns.items()])
    )


NORMALIZED = (
    *TEXT_FIELDS, "ingestion_time", *MEASURES, "trace_id", "abnormal_flags", "is_abnormal",
)


def normalize_reading(
    validated: DataFrame, arrived: datetime | Column | None = None
) -> DataFrame:
    """Sound readings as typed rows with flags; ``arrived`` stamps those without ingestion time."""
    return _typed(validated, arrived).where("problem is null").select("recordId", *NORMALIZED)


def encode_text(text: Column) -> Column:
    """Base64 on one line; Spark may break it into lines of 76 characters."""
    return F.replace(F.base64(F.encode(text, "UTF-8")), F.lit("\r\n"), F.lit(""))


def encode_payload(columns: tuple[str, ...]) -> Column:
    return encode_text(F.to_json(F.struct(*columns)))


def route_records(
    records: DataFrame, arrived: datetime | Column | None = None
) -> DataFrame:
    """One row per input record: ``result``, new ``data``, ``problem`` and the record's own columns.

    No row is filtered or multiplied, and nothing is shuffled.
    """
    passed = [c for c in records.columns if c not in ("data", *NORMALIZED)]
    decoded = decode_payload(records.select(*passed, "data"))
    typed = _typed(validate_reading(decoded), arrived)
    sound = F.col("problem").isNull()
    return typed.select(
        *passed,
        F.when(sound, "Ok").otherwise("Dropped").alias("result"),
        F.when(sound, encode_payload(NORMALIZED)).otherwise("").alias("data"),
        "problem",
        "payload",
    )
