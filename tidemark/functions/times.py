"""Time helpers. Parquet may hold TIMESTAMP or TIMESTAMP_NTZ; both are kept as found."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def moment(as_of: str | datetime | Column, type_name: str) -> Column:
    """A moment as a constant of the given timestamp type, so filters on it push down."""
    if isinstance(as_of, Column):
        return as_of.cast(type_name)
    text = as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else as_of
    return F.lit(text).cast(type_name)


def hours_before(as_of: str | datetime | Column, hours: int, type_name: str) -> Column:
    return moment(as_of, type_name) - F.make_dt_interval(F.lit(0), F.lit(hours))


def hour_start(ts: Column, type_name: str) -> Column:
    """Start of the hour, in the type of the input (date_trunc alone widens NTZ)."""
    return F.date_trunc("hour", ts).cast(type_name)


def iso_text(ts: Column) -> Column:
    """ISO 8601 text with microseconds, as message producers write it."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def latest_time(df: DataFrame, name: str) -> str:
    """Newest value of a time column as text; the usual ``as_of`` of a replay."""
    return df.agg(F.max(name).cast("string")).first()[0]


def epoch_micros(ts: Column) -> Column:
    """Whole microseconds since the epoch, for exact arithmetic on times."""
    return F.unix_micros(ts.cast("timestamp"))
