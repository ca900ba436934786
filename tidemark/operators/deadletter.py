"""Rejected messages: dead-letter records, redelivery, retention."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import column_type, hours_before, iso_text, moment
from tidemark.sources.envelope import REFUSED

# Deliveries before a message is dead, and bounds of the wait in seconds.
MAX_ATTEMPTS = 3
MIN_BACKOFF = 10
MAX_BACKOFF = 600


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) by the ``error`` column."""
    error = F.col("error")
    return df.filter(error.isNull()).drop("error"), df.filter(error.isNotNull())


def handle(
    df: DataFrame, handler: Callable[[DataFrame], Column]
) -> tuple[DataFrame, DataFrame]:
    """Split by a handler's verdict: a boolean column expression over the rows.

    False and null are refusals.
    """
    judged = df.withColumn("_ok", F.coalesce(handler(df), F.lit(False)))
    refused = judged.filter(~F.col("_ok")).withColumn("error", F.lit(REFUSED))
    return judged.filter("_ok").drop("_ok"), refused.drop("_ok")


def to_dead_letter(
    rejects: DataFrame,
    original: str,
    topic: str | Column,
    as_of: str | datetime | Column,
) -> DataFrame:
    """Rejected rows as dead-letter records.

    Text is kept as it is; bytes that are no UTF-8 are kept as base64, so a
    message that could not be read can still be replayed.
    """
    message = F.col(original)
    if column_type(rejects, original) == "binary":
        message = F.coalesce(
            F.try_validate_utf8(message.cast("string")), F.base64(message)
        )
    name = F.lit(topic) if isinstance(topic, str) else topic
    return rejects.select(
        message.alias("original_message"),
        "error",
        iso_text(moment(as_of, "timestamp_ntz")).alias("timestamp"),
        name.alias("topic"),
    )


def route_failures(
    failures: DataFrame, as_of: str | datetime, max_attempts: int = MAX_ATTEMPTS
) -> tuple[DataFrame, DataFrame]:
    """(retry, dead): messages below the limit wait and come back, others are dead.

    The wait doubles with each attempt within its bounds.
    """
    attempt = F.col("attempt")
    type_name = "timestamp_ntz"
    seconds = F.least(
        F.lit(MAX_BACKOFF), (MIN_BACKOFF * F.pow(F.lit(2), attempt - 1)).cast("int")
    )
    wait = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    retry = failures.filter(attempt < max_attempts).withColumns(
        {
            "attempt": attempt + 1,
            "next_try": moment(as_of, type_name) + wait,
        }
    )
    return retry, failures.filter(attempt >= max_attempts)


def expire(
    df: DataFrame, time_col: str, as_of: str | datetime, hours: int
) -> DataFrame:
    """Rows still within the retention time."""
    return df.filter(F.col(time_col) >= hours_before(as_of, hours, column_type(df, time_col)))
