"""Time helpers that keep the input's timestamp type (zoned or not)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def type_of(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def truncated(df: DataFrame, name: str, unit: str) -> Column:
    """``date_trunc`` cast back, since it always answers with a zoned timestamp."""
    return F.date_trunc(unit, F.col(name)).cast(type_of(df, name))


def bucketed(name: str, width: str) -> Column:
    """Start of the ``width`` bucket ("5 minutes") that holds the timestamp."""
    return F.window(F.col(name), width)["start"]


def micros(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(col.cast("timestamp"))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return (micros(end) - micros(start)) / F.lit(1e6)


def moment(value: datetime | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def latest(df: DataFrame, name: str) -> Column:
    """Newest value of ``name`` as a scalar subquery: one partial aggregate, no job here."""
    return df.agg(F.max(name)).scalar()
