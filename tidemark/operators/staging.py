"""Bronze to staging and silver: lookback, typed payload fields, malformed rows out."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import safe_double
from tidemark.functions.payload import extract_scalars, scalar_only
from tidemark.functions.times import column_type, hours_before, moment

# Payload fields read by staging and the default lookback.
TEXT_FIELDS = ["symbol", "news_headline"]
NUMBER_FIELDS = ["price_usd", "volume_24h", "market_cap", "percent_change_24h"]
LOOKBACK_HOURS = 24

SILVER_COLUMNS = [
    "id",
    "symbol",
    "price_usd",
    "volume_24h",
    "market_cap",
    "percent_change_24h",
    "sentiment_score",
    "sentiment_reasoning",
    "ingested_at",
    "processed_at",
]


def lookback(
    df: DataFrame,
    as_of: str | datetime,
    hours: int | None = LOOKBACK_HOURS,
    time_col: str = "ingested_at",
) -> DataFrame:
    """Rows not older than ``hours`` before ``as_of``; None keeps all history."""
    if hours is None:
        return df
    bound = hours_before(as_of, hours, column_type(df, time_col))
    return df.filter(F.col(time_col) >= bound)


def stage_market_data(
    bronze: DataFrame,
    as_of: str | datetime,
    hours: int | None = LOOKBACK_HOURS,
    with_event_time: bool = False,
) -> DataFrame:
    """Typed view of bronze. Rows whose payload names no symbol are left out.

    Narrow: one scan, one JSON parse per row, no shuffle. The time bound sits
    below the parse, so it reaches the file scan. ``with_event_time`` adds the
    message's own timestamp as ``event_time``, for rollups by event time
    instead of by arrival.
    """
    recent = lookback(bronze, as_of, hours)
    wanted = TEXT_FIELDS + NUMBER_FIELDS + (["timestamp"] if with_event_time else [])
    fields = extract_scalars(recent, "raw_payload", wanted)
    type_name = column_type(bronze, "ingested_at")
    event_time = F.col("timestamp").try_cast(type_name).alias("event_time")
    version = F.get_json_object("processing_metadata", "$.function_version")
    return fields.filter(F.col("symbol").isNotNull()).select(
        "id",
        "symbol",
        *[safe_double(F.col(name)).alias(name) for name in NUMBER_FIELDS],
        "news_headline",
        "sentiment_score",
        "sentiment_reasoning",
        "source",
        "ingested_at",
        moment(as_of, type_name).alias("processed_at"),
        scalar_only(
            F.col("processing_metadata"), "function_version", version
        ).alias("function_version"),
        *([event_time] if with_event_time else []),
    )


def silver_market_data(staged: DataFrame) -> DataFrame:
    """The declared silver columns of the staged rows."""
    return staged.select(*SILVER_COLUMNS)
